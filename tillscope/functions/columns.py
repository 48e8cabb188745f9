"""Small column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

DAY_MICROS = 86_400_000_000
HOUR_MICROS = 3_600_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch (dates and zone-less timestamps are read as UTC)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole elapsed days between two microsecond columns (floor of 24 h spans)."""
    return F.floor((later - earlier) / F.lit(float(DAY_MICROS))).cast("long")


def clean_double(c: str | Column) -> Column:
    """Double with NaN turned into null and negative zero into zero (range look-ups tell them apart)."""
    d = col(c).cast("double")
    return F.when(~F.isnan(d), d + F.lit(0.0))


def finite_or_zero(c: str | Column) -> Column:
    d = col(c).cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(d)


def safe_div(a: Column, b: Column, default: float | None = None) -> Column:
    out = F.try_divide(a.cast("double"), b.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(default))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("long")


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def unpivot(df: DataFrame, keep: Sequence[str], values: Sequence[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long: one row per (kept columns, feature); NaN becomes null."""
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias(name), clean_double(v).alias(value)) for v in values]))
    return df.select(*keep, pairs.alias("_p")).select(*keep, f"_p.{name}", f"_p.{value}")


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are known; null (not an error) without variance."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
