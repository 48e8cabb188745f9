"""Shaping of time series: roll-up, calendar filling, lags, rolling rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.functions.columns import DAY_MICROS, clean_double, micros
from tillscope.operators import ranking

# Aggregate names accepted as text, and the calendar steps behind frequency letters.
AGGREGATES = {
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "first": F.min_by,
    "last": F.max_by,
}
STEPS = {"H": "1 hour", "D": "1 day", "W": "7 days", "MS": "1 month"}
ROLLING = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count, "var": F.var_samp}
BLOCK = 100_000


def named_aggregate(name: str, value: Column, order: Column) -> Column:
    if name not in AGGREGATES:
        raise ValueError(f"unknown aggregate: {name}")
    return AGGREGATES[name](value, order) if name in ("first", "last") else AGGREGATES[name](value)


def roll_up(df: DataFrame, date: str, values: Sequence[str], keys: Sequence[str] = (), aggregate: str = "sum", by_day: bool = False) -> DataFrame:
    """One row per (keys, date), or per calendar day."""
    stamp = F.col(date).cast("timestamp")
    when = F.date_trunc("day", stamp) if by_day else stamp
    return df.where(F.col(date).isNotNull()).groupBy(*keys, when.alias("ds")).agg(*[named_aggregate(aggregate, clean_double(v), stamp).alias(v) for v in values])


def infer_frequency(df: DataFrame, date: str = "ds", keys: Sequence[str] = ()) -> str:
    """Most common step between neighbouring dates as a frequency letter, daily when unclear.

    Works on distinct hours per key, so a group is bounded by the calendar.
    """
    hours = F.date_trunc("hour", F.col(date).cast("timestamp"))
    days = df.select(*keys, micros(hours).alias("_t")).distinct()
    step = F.col("_t") - F.lag("_t").over(Window.partitionBy(*keys).orderBy("_t"))
    top = days.select(step.alias("s")).where(F.col("s").isNotNull()).groupBy("s").count().orderBy(F.desc("count"), "s").limit(1).collect()
    if not top:
        return "D"
    length = top[0]["s"] / DAY_MICROS
    if length == 1 / 24:
        return "H"
    if length == 7:
        return "W"
    return "MS" if 28 <= length <= 31 else "D"


def densify(df: DataFrame, value: str, date: str = "ds", keys: Sequence[str] = (), freq: str = "D", fill: str = "zero") -> DataFrame:
    """One row per period between the first and last date of each series.

    ``zero`` puts 0 in the gaps. ``ffill``, ``bfill`` and ``interpolate`` carry or join the known
    values; what stays open becomes 0. A series has one row per period, so windows are bounded by
    the calendar, not by the data volume.
    """
    if freq not in STEPS:
        raise ValueError(f"unknown frequency: {freq}")
    unit = {"H": "hour", "D": "day", "W": "week", "MS": "month"}[freq]
    cells = df.groupBy(*keys, F.date_trunc(unit, F.col(date).cast("timestamp")).alias(date)).agg(F.sum(clean_double(value)).alias(value))
    span = cells.groupBy(*keys).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    grid = span.select(*keys, F.explode(F.expr(f"sequence(_a, _b, interval {STEPS[freq]})")).alias(date))
    wide = grid.join(cells, [*keys, date], "left")
    return fill_gaps(wide, value, date, keys, fill)


def fill_gaps(df: DataFrame, value: str, date: str = "ds", keys: Sequence[str] = (), fill: str = "ffill") -> DataFrame:
    """Fill null values of a one-row-per-period series; linear in time for ``interpolate``."""
    order = Window.partitionBy(*keys).orderBy(date)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), micros(date).alias("t")))
    back = F.last(known, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # the next known value is the last known one in reverse order: a growing frame as well
    ahead = F.last(known, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, 0))
    zero = F.lit(0.0)
    if fill == "zero":
        return df.withColumn(value, F.coalesce(F.col(value), zero))
    if fill == "ffill":
        return df.withColumn("_k", back).withColumn(value, F.coalesce(F.col("_k.v"), zero)).drop("_k")
    if fill == "bfill":
        return df.withColumn("_k", ahead).withColumn(value, F.coalesce(F.col("_k.v"), zero)).drop("_k")
    if fill == "interpolate":
        both = df.withColumns({"_p": back, "_q": ahead})
        share = F.try_divide((micros(date) - F.col("_p.t")).cast("double"), F.col("_q.t") - F.col("_p.t"))
        line = F.col("_p.v") + (F.col("_q.v") - F.col("_p.v")) * share
        return both.withColumn(value, F.coalesce(F.col(value), line, F.col("_p.v"), zero)).drop("_p", "_q")
    raise ValueError(f"unknown fill method: {fill}")


def prepare(df: DataFrame, date: str, value: str, keys: Sequence[str] = (), freq: str | None = None, fill: str = "zero", aggregate: str = "sum") -> DataFrame:
    """Roll-up, frequency and calendar filling in one go."""
    rolled = roll_up(df, date, [value], keys, aggregate)
    return densify(rolled, value, "ds", keys, freq or infer_frequency(rolled, "ds", keys), fill)


def lagged(df: DataFrame, keys: Sequence[str], position: str, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Columns from k rows before, by position: an equi-join on (keys, position), even for hot keys."""
    lags = sorted({k for _, k in columns.values()})
    sources = sorted({c for c, _ in columns.values()})
    moved = df.select(*keys, F.explode(F.array(*[F.lit(k) for k in lags])).alias("_k"), position, *[F.col(c).alias(f"_v_{c}") for c in sources])
    moved = moved.withColumn(position, F.col(position) + F.col("_k")).groupBy(*keys, position)
    table = moved.agg(*[F.max(F.when(F.col("_k") == k, F.col(f"_v_{c}"))).alias(n) for n, (c, k) in columns.items()])
    return df.join(table, [*keys, position], "left")


def lag_features(df: DataFrame, column: str, lags: Sequence[int], date: str, keys: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """``{column}_lag_{k}`` by order of date within the keys."""
    timed = df.withColumn("_t", micros(date))
    numbered = ranking.in_order(timed, "_t", tie or "_t", keys, position="_pos")
    out = lagged(numbered, keys, "_pos", {f"{column}_lag_{k}": (column, k) for k in lags})
    return out.select(*df.columns, *[f"{column}_lag_{k}" for k in lags])


def rolling_features(df: DataFrame, column: str, windows: Sequence[int], date: str, functions: Sequence[str] = ("mean", "std", "min", "max"), keys: Sequence[str] = (), tie: str | None = None, block: int = BLOCK) -> DataFrame:
    """Row-count windows. Positions are cut in blocks; each block also gets the last rows of the one before."""
    unknown = [f for f in functions if f not in ROLLING]
    if unknown:
        raise ValueError(f"unknown functions: {unknown}")
    block = max(block, 2 * max(windows))
    timed = df.withColumn("_t", micros(date))
    numbered = ranking.in_order(timed, "_t", tie or "_t", keys, position="_pos")
    start = F.expr(f"(_pos - 1) div {block}")
    reach = max(windows) - 1
    near_end = F.pmod(F.col("_pos") - 1, F.lit(block)) >= block - reach
    places = F.when(near_end, F.array(start, start + 1)).otherwise(F.array(start))
    spread = numbered.withColumn("_own", start).withColumn("_block", F.explode(places))
    order = Window.partitionBy(*keys, "_block").orderBy("_pos")
    names = {f"{column}_rolling_{w}_{f}": ROLLING[f](clean_double(column)).over(order.rowsBetween(-(w - 1), 0)) for w in windows for f in functions}
    return spread.select(*df.columns, "_own", "_block", *[c.alias(n) for n, c in names.items()]).where("_own = _block").drop("_own", "_block")
