"""Trailing time windows per key, exact for keys of any size.

The time line is cut in cells whose width divides every window. A window (t - w, t] then is
  the rows of the own cell up to t
  + whole cells in between (pre-aggregated, one row per key and cell)
  + the rows of the cell w earlier that lie after t - w.
Rows are shuffled by (key, cell), so the largest group is one key's rows of one cell. All frames
over rows only grow, which Spark evaluates in linear time; the sliding frame runs over cells.

A key of few rows needs none of that: its rows meet in one partition and the windows are sliding
frames over them, so the rows are neither copied nor joined. ``busy_keys`` tells the two kinds apart.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.functions.columns import HOUR_MICROS, clean_double, micros
from tillscope.session import materialize

CELL_ROWS = 5_000_000
KEY_ROWS = 500  # a sliding frame reads at most this many rows for each row
BUSY_KEYS = 200_000
SECOND = 1_000_000


def choose_cell(df: DataFrame, key: str, ts: str, windows: Sequence[int], total: int, cell_rows: int = CELL_ROWS) -> int:
    """Cell width in microseconds: the windows' common divisor, halved until a cell stays small."""
    width = math.gcd(*windows) * HOUR_MICROS
    while total > cell_rows and width > SECOND:
        t = micros(ts)
        busiest = df.groupBy(key, (t - F.pmod(t, F.lit(width))).alias("_cell")).count().agg(F.max("count")).first()[0]
        if busiest is None or busiest <= cell_rows:
            break
        shrink = next((d for d in (2, 3, 5) if width % (d * SECOND) == 0), None)
        if shrink is None:
            break
        width //= shrink
    return width


def busy_keys(df: DataFrame, key: str, ts: str, total: int, key_rows: int = KEY_ROWS) -> DataFrame:
    """Keys with more than ``max(key_rows, total / BUSY_KEYS)`` rows, the null key and keys with a null time, as ``_busy``."""
    limit = max(key_rows, math.ceil(total / BUSY_KEYS))
    sizes = df.groupBy(F.col(key).alias("_busy")).agg(F.count(F.lit(1)).alias("_n"), F.count_if(micros(ts).isNull()).alias("_untimed"))
    return materialize(sizes.where(F.col("_busy").isNull() | (F.col("_n") > limit) | (F.col("_untimed") > 0)).select("_busy"))


def _stats(x: Column, shifted: Column) -> dict[str, Column]:
    return {"n": F.count(x), "s": F.sum(shifted), "q": F.sum(shifted * shifted), "lo": F.min(x), "hi": F.max(x)}


def trailing_profile(
    df: DataFrame,
    key: str,
    ts: str,
    amount: str,
    tie: str,
    windows: Sequence[int],
    center: float,
    cell: int,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Add, per row, trailing window statistics, the previous row and whole-key totals.

    Per window ``w`` (hours): ``_w{w}_n/_s/_q/_lo/_hi`` = count, sum and sum of squares of
    ``amount - center``, min, max. From the row before by (time, tie): ``_prev_t``, ``_prev_x``.
    Per key: ``_k_n/_s/_q/_lo/_hi`` and ``_k_first``, ``_k_last`` (microseconds).
    Rows with the same key and time count for each other. ``busy`` (from ``busy_keys``) names the keys
    to cut in cells; without it all keys are.
    """
    payload = df.columns
    base = df.select(
        F.struct(*[F.col(c) for c in payload]).alias("_row"),
        F.col(key).alias("_key"),
        micros(ts).alias("_t"),
        clean_double(amount).alias("_x"),
        F.col(tie).alias("_id"),
    ).withColumn("_d", F.col("_x") - F.lit(center))
    if busy is None:
        return _by_cells(base, payload, windows, cell)
    count = busy.count()
    if not count:
        return _by_keys(base, payload, windows)
    listed = F.broadcast(busy) if count <= BUSY_KEYS else busy
    met = base["_key"].eqNullSafe(busy["_busy"])
    return _by_keys(base.join(listed, met, "left_anti"), payload, windows).unionByName(_by_cells(base.join(listed, met, "left_semi"), payload, windows, cell))


def _by_keys(base: DataFrame, payload: Sequence[str], windows: Sequence[int]) -> DataFrame:
    """The profile of keys with few rows, none of them without a time: one shuffle, one sort, sliding frames."""
    by_key = Window.partitionBy("_key")
    in_time = by_key.orderBy("_t")
    stats = _stats(F.col("_x"), F.col("_d"))
    previous = F.lag(F.struct("_t", "_x")).over(by_key.orderBy("_t", "_id", "_x"))

    def whole(name: str, value: Column) -> Column:
        return value if name in ("lo", "hi") else F.coalesce(value, F.lit(0))

    found = base.select(
        "_row",
        *[whole(m, f.over(in_time.rangeBetween(1 - w * HOUR_MICROS, 0))).alias(f"_w{w}_{m}") for w in windows for m, f in stats.items()],
        previous.alias("_prev"),
        *[f.over(by_key).alias(f"_k_{m}") for m, f in stats.items()],
        F.min("_t").over(by_key).alias("_k_first"),
        F.max("_t").over(by_key).alias("_k_last"),
    )
    rest = [c for c in found.columns if c not in ("_row", "_prev") and not c.startswith("_k_")]
    return found.select(
        *[F.col(f"_row.{c}").alias(c) for c in payload],
        *rest,
        F.col("_prev._t").alias("_prev_t"),
        F.col("_prev._x").alias("_prev_x"),
        *[f"_k_{m}" for m in stats],
        "_k_first",
        "_k_last",
    )


def _by_cells(base: DataFrame, payload: Sequence[str], windows: Sequence[int], cell: int) -> DataFrame:
    base = base.withColumn("_o", F.pmod("_t", F.lit(cell))).withColumn("_cell", F.expr(f"(_t - _o) div {cell}L"))
    steps = {w: w * HOUR_MICROS // cell for w in windows}

    # per-cell totals, one row per key and cell; a key has at most as many cells as time allows
    cells = base.groupBy("_key", "_cell").agg(
        *[c.alias(f"c_{m}") for m, c in _stats(F.col("_x"), F.col("_d")).items()],
        F.max(F.struct("_t", "_id", "_x")).alias("c_last"),
        F.min("_t").alias("c_first"),
    )
    merge = {"n": F.sum, "s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max}
    by_key = Window.partitionBy("_key")
    order = by_key.orderBy("_cell")
    middle = [
        f("c_" + m).over(order.rangeBetween(-(k - 1), -1)).alias(f"m{w}_{m}") for w, k in steps.items() if k > 1 for m, f in merge.items()
    ]
    totals = [f("c_" + m).over(by_key).alias(f"_k_{m}") for m, f in merge.items()]
    summary = cells.select(
        "_key",
        "_cell",
        *middle,
        *totals,
        F.min("c_first").over(by_key).alias("_k_first"),
        F.max("c_last").over(by_key)["_t"].alias("_k_last"),
        F.lag("c_last").over(order).alias("_carry"),
    )

    # every row once as itself and once per window as the left edge of a later cell
    shifts = F.explode(F.array(F.lit(0), *[F.lit(k) for k in steps.values()])).alias("_shift")
    copies = base.select("*", shifts).withColumn("_cell", F.col("_cell") + F.col("_shift"))
    copies = copies.withColumn("_row", F.when(F.col("_shift") == 0, F.col("_row")))
    own = F.col("_shift") == 0
    part = Window.partitionBy("_key", "_cell")
    upto = part.orderBy("_o").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    later = part.orderBy(F.col("_o").desc()).rangeBetween(Window.unboundedPreceding, -1)
    before = part.orderBy("_o", "_id").rowsBetween(Window.unboundedPreceding, -1)

    def pick(condition: Column, window: object, prefix: str) -> list[Column]:
        x, d = F.when(condition, F.col("_x")), F.when(condition, F.col("_d"))
        return [c.over(window).alias(f"{prefix}{m}") for m, c in _stats(x, d).items()]

    edges = [c for w, k in steps.items() for c in pick(F.col("_shift") == k, later, f"l{w}_")]
    # exchange the narrow rows first; then one sort serves both rising windows, another the falling one
    placed = copies.repartition("_key", "_cell")
    seen = placed.withColumn("_in_cell", F.last(F.when(own, F.struct("_t", "_id", "_x")), ignorenulls=True).over(before))
    seen = seen.select("*", *pick(own, upto, "r_"))
    pieces = seen.select("_key", "_cell", "_row", "_shift", "_in_cell", *[f"r_{m}" for m in merge], *edges).where(own)
    joined = pieces.join(summary, ["_key", "_cell"], "left")

    def combine(w: int, m: str) -> Column:
        parts = [F.col(f"r_{m}"), F.col(f"l{w}_{m}")] + ([F.col(f"m{w}_{m}")] if steps[w] > 1 else [])
        if m == "lo":
            return F.least(*parts)
        if m == "hi":
            return F.greatest(*parts)
        return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])

    previous = F.coalesce(F.col("_in_cell"), F.col("_carry"))
    return joined.select(
        *[F.col(f"_row.{c}").alias(c) for c in payload],
        *[combine(w, m).alias(f"_w{w}_{m}") for w in windows for m in merge],
        previous["_t"].alias("_prev_t"),
        previous["_x"].alias("_prev_x"),
        *[f"_k_{m}" for m in merge],
        "_k_first",
        "_k_last",
    )


def mean_of(prefix: str, center: float) -> Column:
    """Mean from shifted sums; null when nothing was counted."""
    n, s = F.col(f"{prefix}n"), F.col(f"{prefix}s")
    return F.when(n > 0, F.lit(center) + s / F.nullif(n, F.lit(0)))


def std_of(prefix: str) -> Column:
    """Sample standard deviation from shifted sums; null below two values."""
    n, s, q = F.col(f"{prefix}n"), F.col(f"{prefix}s"), F.col(f"{prefix}q")
    spread = F.greatest(F.lit(0.0), q - s * s / F.nullif(n, F.lit(0)))
    return F.when(n > 1, F.sqrt(spread / F.nullif(n - 1, F.lit(0))))
