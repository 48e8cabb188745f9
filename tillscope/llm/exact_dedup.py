"""Exact dedup by skew-safe combining, in DataFrame operations only.

1. Texts whose 64-bit hash is met once have no equal; they never leave their task. The hashes met
   more than once go into a bitmap of fixed size, the only thing that is broadcast; a false hit
   costs a shuffle of one text and changes nothing.
2. The other texts are combined locally (map-side aggregation on digest and whole text), then by
   (digest, text) inside a salt taken from the input task, then over the salts.
3. Rows find the winner of their group by digest and whole text, so a digest that two texts share
   is harmless at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillscope.llm.common import bitmap, fan, materialize, with_hit

BITMAP_BITS = 1 << 26  # 8 MB whatever the input; when full, more texts are shuffled and the result is the same


def _possible(rows: DataFrame, bits: int) -> DataFrame:
    """The bitmap of text hashes that occur more than once."""
    repeated = rows.groupBy(F.xxhash64("_text").alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return bitmap(repeated, "_h", bits)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITMAP_BITS, salts: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (and the columns of ``carry`` as ``carried``).

    Texts are equal when identical unchanged; null counts as empty, and empty texts are equal to each
    other. Of equal texts the row with the largest id stays (a null id is the smallest). Rows that
    repeat both id and text are told apart by their place in the input: exactly one of a group is
    kept. An empty table gives no rows; other columns of ``docs`` are never read, whatever their name,
    unless they are in ``carry``.
    """
    spark = docs.sparkSession
    salts = salts or fan(spark)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("string").alias("carried"),
    )
    marked = with_hit(rows, F.xxhash64("_text"), _possible(rows, bits), bits).withColumn("_digest", F.sha2("_text", 256))

    alone = marked.where(~F.col("_hit")).select(
        F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("_digest").alias("text_sha256"), "carried"
    )
    # written once, so that a row's place is the same wherever it is read again
    shared = materialize(marked.where("_hit").drop("_hit").withColumn("_place", F.monotonically_increasing_id()).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))))
    salted = shared.groupBy("_salt", "_digest", "_text").agg(F.max(F.struct("_id", "_place")).alias("_best"), F.count(F.lit(1)).alias("_n"))
    groups = salted.groupBy("_digest", "_text").agg(F.max("_best").alias("_best"), F.sum("_n").alias("_size"))
    placed = shared.join(groups, ["_digest", "_text"]).select(
        F.col("_id").alias(id_col),
        F.col("_best._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_place") == F.col("_best._place")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
        "carried",
    )
    out = alone.unionByName(placed)
    return out if carry else out.drop("carried")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    boxed = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_body"), F.struct("*").alias("row"))
    kept = exact_dedup(boxed, "_key", "_body", carry=("row",)).where("kept")
    return kept.select("carried.row.*")
