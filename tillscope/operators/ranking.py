"""Exact ranks, quantiles and running orders without a one-task window.

Every global (or hot-key) order is split in value ranges. The range edges come from
``approxQuantile``; they only decide how evenly the work is spread, never the result: equal
values always share a range, positions inside a range come from a window over that range and the
range offsets (at most one row per range and group) are added afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tillscope.functions.columns import clean_double
from tillscope.session import bucket_count

HOT_KEY_ROWS = 1_000_000
CELLS = 2048
LOG_MOST = 710.0  # logarithm of the largest double, rounded up


def range_edges(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> dict[str, list[float]]:
    """Inner range edges per column (with repeats where one value is heavy), from one sketch pass."""
    buckets = buckets or bucket_count(df.sparkSession)
    doubles = df.select(*[clean_double(c).alias(c) for c in columns])
    probabilities = [i / buckets for i in range(1, buckets)]
    found = doubles.approxQuantile(list(columns), probabilities, 1.0 / (2 * buckets))
    return {c: [float(v) for v in values] for c, values in zip(columns, found)}


def assign_ranges(df: DataFrame, edges: dict[str, list[float]], outputs: dict[str, str]) -> DataFrame:
    """Add an integer range number per column; nulls get a range of their own at the end."""
    inner = {c: sorted(set(e for e in edges.get(c, []) if math.isfinite(e))) for c in outputs}
    cut = [c for c in outputs if inner[c]]
    fixed = {outputs[c]: F.lit(0) for c in outputs if not inner[c]}
    if fixed:
        df = df.withColumns(fixed)
    if not cut:
        return df
    raw = {c: f"_in_{outputs[c]}" for c in cut}
    bucketizer = Bucketizer(
        splitsArray=[[-math.inf, *inner[c], math.inf] for c in cut], inputCols=[raw[c] for c in cut], outputCols=[outputs[c] for c in cut], handleInvalid="keep"
    )
    tagged = bucketizer.transform(df.withColumns({raw[c]: clean_double(c) for c in cut}))
    return tagged.withColumns({outputs[c]: F.col(outputs[c]).cast("int") for c in cut}).drop(*raw.values())


def count_below(df: DataFrame, column: str, edges: Sequence[float], output: str, strict: bool = True) -> DataFrame:
    """Add how many edges lie below the value (``edge < x``, or ``edge <= x`` when not strict)."""
    edges = [e + 0.0 for e in edges]
    distinct = sorted(set(edges))
    weight = [sum(1 for e in edges if e == d) for d in distinct]
    running = [0]
    for w in weight:
        running.append(running[-1] + w)
    if strict:
        # ranges are closed on the left, so the strict form works on negated values
        negated = df.withColumn("_side", F.lit(0.0) - F.col(column).cast("double"))
        splits = [-math.inf, *[0.0 - d for d in reversed(distinct)], math.inf]
        tagged = Bucketizer(splits=splits, inputCol="_side", outputCol="_edge", handleInvalid="keep").transform(negated)
        index = F.lit(len(distinct)) - F.col("_edge").cast("int")
    else:
        splits = [-math.inf, *distinct, math.inf]
        base = df.withColumn("_side", F.col(column).cast("double") + F.lit(0.0))
        tagged = Bucketizer(splits=splits, inputCol="_side", outputCol="_edge", handleInvalid="keep").transform(base)
        index = F.col("_edge").cast("int")
    lookup = F.array(*[F.lit(r) for r in running])
    value = F.when(F.col(column).isNotNull(), F.try_element_at(lookup, index + 1))
    return tagged.withColumn(output, value.cast("long")).drop("_side", "_edge")


def distribution(
    df: DataFrame,
    value: str,
    groups: Sequence[str] = (),
    bucket: str | None = None,
    weights: dict[str, Column] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Distinct values per group with counts and cumulative counts.

    Columns: groups, ``value``, ``n`` (rows), ``before`` (rows of the group with a smaller value),
    ``total`` and, per extra weight ``w``: ``w``, ``w_before``, ``w_total`` (sums of that weight).
    """
    weights = weights or {}
    rows = df.where(clean_double(value).isNotNull())
    if bucket is None:
        rows = assign_ranges(rows, range_edges(rows, [value], buckets), {value: "_range"})
        bucket = "_range"
    sums = {"n": F.count(F.lit(1)), **{w: F.sum(c) for w, c in weights.items()}}
    counts = rows.groupBy(*groups, bucket, value).agg(*[c.alias(n) for n, c in sums.items()])
    inside = Window.partitionBy(*groups, bucket).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    counts_in = counts.select(
        "*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"_{n}_in") for n in sums]
    )
    per_range = counts.groupBy(*groups, bucket).agg(*[F.sum(n).alias(f"_{n}_r") for n in sums])
    ordered = Window.partitionBy(*groups).orderBy(bucket)
    offsets = per_range.select(
        *groups,
        bucket,
        *[F.coalesce(F.sum(f"_{n}_r").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_{n}_off") for n in sums],
        *[F.sum(f"_{n}_r").over(Window.partitionBy(*groups)).alias("total" if n == "n" else f"{n}_total") for n in sums],
    )
    if not groups:
        offsets = F.broadcast(offsets)  # at most one row per range
    joined = counts_in.join(offsets, [*groups, bucket], "inner")
    named = {"n": "before"}
    return joined.select(
        *groups,
        value,
        *sums,
        *[(F.col(f"_{n}_in") + F.col(f"_{n}_off")).alias(named.get(n, f"{n}_before")) for n in sums],
        "total",
        *[f"{w}_total" for w in weights],
    )


def average_rank() -> Column:
    """Average rank of a value in a ``distribution`` frame (ties share the mean rank)."""
    return F.col("before") + (F.col("n") + 1) / 2.0


def quantile_columns(value: str, quantiles: dict[str, float]) -> list[Column]:
    """Aggregates over a ``distribution`` frame: exact, linearly interpolated quantiles."""
    out = []
    for name, p in quantiles.items():
        at = (F.col("total") - 1) * F.lit(float(p))
        spot = {}
        for side, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
            spot[side] = F.max(F.when(holds, F.col(value).cast("double")))
        share = F.max(at - F.floor(at))
        out.append((spot["lo"] + (spot["hi"] - spot["lo"]) * share).alias(name))
    return out


def grouped_quantiles(df: DataFrame, groups: Sequence[str], value: str, quantiles: dict[str, float], **kw) -> DataFrame:
    """Exact quantiles per group; a hot group is spread over all value ranges."""
    return distribution(df, value, groups, **kw).groupBy(*groups).agg(*quantile_columns(value, quantiles))


def long_ranges(df: DataFrame, keep: Sequence[str], columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """(kept columns, feature, value, _range): each feature carries ranges of its own scale."""
    edges = range_edges(df, columns, buckets)
    tagged = assign_ranges(df, edges, {c: f"_range_{i}" for i, c in enumerate(columns)})
    items = [
        F.struct(F.lit(c).alias("feature"), clean_double(c).alias("value"), F.col(f"_range_{i}").alias("_range"))
        for i, c in enumerate(columns)
    ]
    return (
        tagged.select(*keep, F.explode(F.array(*items)).alias("_f"))
        .select(*keep, "_f.feature", "_f.value", "_f._range")
        .where(F.col("value").isNotNull())
    )


def _cell(value: Column, low: float, high: float) -> Column:
    """Which of CELLS equal parts of [low, high] holds the value; monotone, the two ends in the first and the last."""
    if math.isinf(low) or math.isinf(high):
        return F.when(value == -math.inf, 0).when(value == math.inf, CELLS - 1).otherwise(1)
    if not high / 2 - low / 2 > 0:
        return F.when(value < high, 0).otherwise(1)
    share = (value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    return F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).cast("int")


def _wide_cell(value: Column) -> Column:
    """Cells over all numbers, evenly spaced in their logarithm."""
    scaled = F.signum(value) * F.log1p(F.abs(value)) / F.lit(2 * LOG_MOST) + F.lit(0.5)
    return F.least(F.floor(scaled * CELLS), F.lit(CELLS - 1)).cast("int")


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact, linearly interpolated global quantiles of several columns as plain numbers.

    Every round is one aggregate for all columns and levels: it counts the values of each open
    bracket in CELLS parts, with the least and the largest value of each part. The part that holds a
    wanted position is the next bracket, from its least to its largest value, until they are equal.
    A bracket always splits, so heavy values, wherever they lie, end it at once. No step shuffles the
    column; the driver sees at most CELLS rows for each bracket.
    """
    columns, probabilities = list(columns), list(probabilities)
    base = df.select(*[clean_double(c).alias(f"c{i}") for i, c in enumerate(columns)])
    found: dict[tuple[int, int], float] = {}
    totals = [0] * len(columns)
    # bracket (column, low, high) -> wanted positions inside it; the first round has one for each column
    brackets: dict[tuple[int, float | None, float | None], list[tuple[int, int]]] = {(i, None, None): [] for i in range(len(columns))}
    first = True
    while brackets:
        keys = list(brackets)
        items = []
        for b, (i, low, high) in enumerate(keys):
            value = F.col(f"c{i}")
            inside = value.isNotNull() if first else value.between(low, high)
            items.append(F.when(inside, F.struct(F.lit(b).alias("b"), (_wide_cell(value) if first else _cell(value, low, high)).alias("cell"), value.alias("v"))))
        parts = base.select(F.explode(F.array_compact(F.array(*items))).alias("_p")).groupBy("_p.b", "_p.cell")
        rows = parts.agg(F.count(F.lit(1)).alias("n"), F.min("_p.v").alias("low"), F.max("_p.v").alias("high")).collect()
        cells: list[list] = [[] for _ in keys]
        for r in rows:
            cells[r["b"]].append(r)
        following: dict[tuple[int, float | None, float | None], list[tuple[int, int]]] = {}
        for key, held in zip(keys, cells):
            held.sort(key=lambda r: r["cell"])
            wanted = brackets[key]
            if first:
                totals[key[0]] = n = sum(r["n"] for r in held)
                wanted = sorted({(w, w) for p in probabilities if n for w in (math.floor((n - 1) * p), math.ceil((n - 1) * p))})
            run, at = 0, 0
            for position, rank in wanted:  # the wanted position, and its place inside the bracket
                while run + held[at]["n"] <= rank:
                    run, at = run + held[at]["n"], at + 1
                low, high = held[at]["low"], held[at]["high"]
                if low == high:
                    found[key[0], position] = low
                else:
                    following.setdefault((key[0], low, high), []).append((position, rank - run))
        brackets, first = following, False

    def quantile(i: int, p: float) -> float | None:
        if not totals[i]:
            return None
        at = (totals[i] - 1) * p
        low, high = found[i, math.floor(at)], found[i, math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    return {c: [quantile(i, p) for p in probabilities] for i, c in enumerate(columns)}


def _tie_key(df: DataFrame, tie: str) -> Column:
    numeric = isinstance(df.schema[tie].dataType, T.NumericType)
    return F.col(tie).cast("double") if numeric else F.xxhash64(tie).cast("double")


def order_edges(df: DataFrame, orders: Sequence[str], tie: str, buckets: int | None = None) -> dict[str, list[float]]:
    """Range edges for several ``in_order`` calls on the same rows, from one pass."""
    return range_edges(df.withColumn("_tie", _tie_key(df, tie)), [*orders, "_tie"], buckets)


def in_order(
    df: DataFrame,
    order: str,
    tie: str,
    groups: Sequence[str] = (),
    previous: dict[str, str] | None = None,
    position: str = "position",
    size: str | None = None,
    buckets: int | None = None,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Number the rows of each group 1..n by (order, tie) and fetch columns of the row before.

    ``previous`` maps new column names to columns read from the preceding row. A group of any size
    is cut in ranges of ``order``; a value of ``order`` that is itself heavy is cut by ``tie``.
    ``order`` must be numeric; a text ``tie`` is ordered by its hash, then by itself. ``edges`` (from
    ``order_edges``) saves the sketch pass when several orders of one table are needed.
    """
    previous = previous or {}
    buckets = buckets or bucket_count(df.sparkSession)
    keyed = df.withColumn("_tie", _tie_key(df, tie))
    edges = edges or range_edges(keyed, [order, "_tie"], buckets)
    tagged = assign_ranges(keyed, edges, {order: "_r"})
    repeats: dict[float, int] = {}
    for e in edges[order]:
        repeats[e] = repeats.get(e, 0) + 1
    heavy = [(v, k) for v, k in repeats.items() if k > 1]
    if heavy:
        # rows of a heavy value come first in their range; k of the n ranges means k pieces
        spread = df.sparkSession.createDataFrame(heavy, "_hv double, _pieces int")
        tagged = assign_ranges(tagged, edges, {"_tie": "_tr"})
        n_ties = len(set(edges["_tie"])) + 2
        tagged = tagged.join(F.broadcast(spread), F.col(order).cast("double") == F.col("_hv"), "left")
        piece = F.when(F.col("_hv").isNotNull(), F.floor(F.col("_tr") * F.col("_pieces") / F.lit(n_ties))).otherwise(F.lit(buckets + 1))
        tagged = tagged.withColumn("_s", piece.cast("int")).drop("_tr", "_hv", "_pieces")
    else:
        tagged = tagged.withColumn("_s", F.lit(0))
    keys = [*groups, "_r", "_s"]
    inner = Window.partitionBy(*keys).orderBy(order, "_tie", tie)
    carried = F.struct(*[F.col(c).alias(n) for n, c in previous.items()]) if previous else None
    numbered = tagged.withColumn("_in", F.row_number().over(inner))
    pieces = [F.count(F.lit(1)).alias("_n")]
    if carried is not None:
        numbered = numbered.withColumn("_prev", F.lag(carried).over(inner))
        pieces.append(F.max_by(carried, F.struct(F.col(order), F.col("_tie"), F.col(tie))).alias("_last"))
    per_piece = tagged.groupBy(*keys).agg(*pieces)
    outer = Window.partitionBy(*groups).orderBy("_r", "_s")
    offsets = per_piece.select(
        *keys,
        F.coalesce(F.sum("_n").over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*groups)).alias("_size"),
        *([F.lag("_last").over(outer).alias("_carry")] if carried is not None else []),
    )
    if not groups:
        offsets = F.broadcast(offsets)  # at most two rows per range
    joined = numbered.join(offsets, keys, "left")  # a null group keeps its rows, without a position
    result = joined.withColumn(position, F.col("_in") + F.col("_off"))
    if size:
        result = result.withColumn(size, F.col("_size"))
    for name in previous:
        result = result.withColumn(name, F.when(F.col("_in") > 1, F.col(f"_prev.{name}")).otherwise(F.col(f"_carry.{name}")))
    return result.drop("_tie", "_r", "_s", "_in", "_off", "_size", "_prev", "_carry")


def lookup(facts: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int, spread: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Left join of a table with one row per key, where ``weight`` is the key's row count in ``facts``.

    Keys above ``max(hot_rows, total / 1000)`` rows are cut in pieces on both sides. There can be at
    most 1000 of them, so the list of hot keys is safe to broadcast.
    """
    limit = max(hot_rows, math.ceil(total / 1000))
    table = table.drop(weight) if total <= limit else table
    if total <= limit:
        return facts.join(table, list(keys), "left")
    pieces = F.ceil(F.col(weight) / F.lit(limit)).cast("int")
    hot = table.where(F.col(weight) > limit).select(*keys, pieces.alias("_pieces"))
    salted = (
        facts.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce(F.col("_pieces"), F.lit(1))).cast("int"))
        .drop("_pieces")
    )
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1))).drop(weight)
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")
