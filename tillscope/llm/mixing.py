"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is the expected number of copies of each of its documents. The whole
part is given to every document for certain; the rest is the inclusion probability of a sample. The
documents of a source are ranked by random odds over inclusion odds, and taken in that order until the
source's words are met as nearly as whole documents allow: a sample of fixed size in words.

The place where a source's order is cut is found without sorting the source: word sums of 4096 rank
ranges, of 4096 ranges inside the one that is cut, and the exact order of the few documents left. The
result is one small row per source; whether a document is taken then follows from its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.llm.common import materialize, prepare

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
RANGES = 4096
SEED = "mix"


def words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """Place of each source by code point, null last, from ordered ranges: no task sees all sources."""
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = materialize(sources.repartitionByRange(parts, F.col("_source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()))
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(F.col("_part"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("_part").orderBy(F.col("_source").asc_nulls_last())
    return ordered.withColumn("_at", F.row_number().over(inner)).join(F.broadcast(before), "_part").withColumn("_at", F.col("_at") + F.col("_before") - 1).drop("_part", "_before")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source its size and target; ``sized`` holds _source and _size.

    Targets follow the weights and stop at ``most`` times the source's size; the excess goes to the
    others by weight until none is above. Every round is one aggregate over the sources.
    """
    sums = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_at"), F.lit(len(weights))) + 1).cast("int"))
    table = materialize(_numbered(sums).withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * most))
    total, spread = table.agg(F.sum("source_size"), F.sum("_weight")).first()
    goal = share * float(total or 0)
    level, capped = goal / float(spread or 1), 0
    while True:
        above = F.col("_weight") * F.lit(level) > F.col("_cap")
        n, held, free = table.agg(F.sum(above.cast("long")), F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_weight")))).first()
        if not n or n == capped or not free:
            break
        capped, level = n, (goal - float(held)) / float(free)
    return table.select("_source", "source_size", F.when(above, F.col("_cap").cast("double")).otherwise(F.col("_weight") * F.lit(level)).alias("target"))


def _rank(identity: Column, inclusion: Column, seed: str) -> Column:
    """Random odds over inclusion odds; null where nothing is drawn. Depends on the id alone, so reruns agree."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))).cast("binary"))
    uniform = (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return F.when(inclusion > 0, (uniform / (1 - uniform)) / (inclusion / (1 - inclusion)))


def _crossing(rows: DataFrame, bucket: str) -> DataFrame:
    """Per source the range in which the running word sum passes ``_need``, and the words before it."""
    sums = rows.groupBy("_source", "_need", bucket).agg(F.sum("_size").alias("_n"))
    running = F.sum("_n").over(Window.partitionBy("_source").orderBy(bucket))
    placed = sums.withColumn("_after", running).withColumn("_before", F.col("_after") - F.col("_n"))
    return placed.where("_before <= _need AND _need < _after").select(F.col("_source").alias("_s"), F.col(bucket).alias("_cut"), F.col("_before"))


def plan(sized: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """One row per source: sizes, target, whole copies, inclusion, and the last (rank, id) that is taken.

    ``sized`` holds _id, _source and _size.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    table = targets(sized, **shares).withColumn("_whole", F.floor(rate)).withColumn("_inclusion", rate - F.floor(rate))
    table = materialize(table.withColumn("_need", F.col("target") - F.col("_whole") * F.col("source_size")))
    keyed = table.withColumnRenamed("_source", "_s")
    ranked = sized.join(keyed, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_rank", _rank(F.col("_id"), F.col("_inclusion"), seed)).where("_rank IS NOT NULL AND _size > 0")
    position = F.col("_rank") / (1 + F.col("_rank")) * RANGES
    ranked = ranked.select("_id", "_source", "_size", "_need", "_rank", F.floor(position).alias("_r1"), F.floor((position - F.floor(position)) * RANGES).alias("_r2"))
    first = _crossing(ranked, "_r1")
    inside = materialize(
        ranked.join(first, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_r1") == F.col("_cut"))).withColumn("_need", F.col("_need") - F.col("_before")).drop("_s", "_cut", "_before")
    )
    second = _crossing(inside, "_r2")
    left = inside.join(second, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_r2") == F.col("_cut"))).withColumn("_need", F.col("_need") - F.col("_before"))
    # the documents at the cut itself; rows that repeat an id are one unit
    units = left.groupBy("_source", "_need", "_rank", "_id").agg(F.sum("_size").alias("_size"))
    running = F.sum("_size").over(Window.partitionBy("_source").orderBy("_rank", "_id").rowsBetween(Window.unboundedPreceding, 0))
    taken = units.withColumn("_after", running).where(F.col("_after") - F.col("_size") / 2 <= F.col("_need"))
    last = taken.groupBy("_source").agg(F.max(F.struct("_rank", "_id")).alias("_last")).withColumnRenamed("_source", "_s3")
    cut = first.select("_s", F.col("_cut").alias("_cut1")).join(second.select(F.col("_s").alias("_s2"), F.col("_cut").alias("_cut2")), F.col("_s").eqNullSafe(F.col("_s2")), "left")
    cut = cut.join(last, F.col("_s").eqNullSafe(F.col("_s3")), "left").drop("_s2", "_s3")
    return materialize(table.join(cut, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s"))


def copies(rows: DataFrame, table: DataFrame, seed: str = SEED) -> DataFrame:
    """Add source_size, target and _copies to rows with _id, _source and _size."""
    rank = _rank(F.col("_id"), F.col("_inclusion"), seed)
    position = rank / (1 + rank) * RANGES
    one, two = F.floor(position), F.floor((position - F.floor(position)) * RANGES)
    last = (rank < F.col("_last._rank")) | ((rank == F.col("_last._rank")) & ((F.col("_id") <= F.col("_last._id")) | F.col("_id").isNull()))
    in_cut = F.when(two < F.col("_cut2"), True).when(two > F.col("_cut2"), False).otherwise(last)
    drawn = F.when(one < F.col("_cut1"), True).when(one > F.col("_cut1"), False).otherwise(in_cut)
    joined = rows.join(table.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
    return joined.withColumn("_copies", F.col("_whole") + F.coalesce(drawn & (F.col("_size") > 0), F.lit(False)).cast("long")).drop("_s", "_whole", "_inclusion", "_need", "_cut1", "_cut2", "_last")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **shares) -> DataFrame:
    """One row per input row: id, size, source_size, target (its source's), taken (words, repeats counted).

    A null text has size 0 and empty documents are never drawn. Sources are ordered by code point,
    the null source last; it is a source like any other. Rows that repeat an id share its draw and
    are taken or left together. No row is taken more than twice (``most``). An empty table gives no
    rows. Only the three named columns are read.
    """
    prepare(docs.sparkSession)
    sized = materialize(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), words(text_col).alias("_size")))
    out = copies(sized, plan(sized, seed, **shares), seed)
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **shares) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it."""
    prepare(docs.sparkSession)
    boxed = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), words(text_col).alias("_size"), F.struct("*").alias("_row"))
    sized = materialize(boxed.drop("_row"))
    out = copies(boxed, plan(sized, seed, **shares), seed).where("_copies > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
