"""Checks and descriptions of tables before a job runs."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tillscope.functions.columns import clean_double, numeric_columns, require_columns, string_columns
from tillscope.operators import ranking
from tillscope.operators.cleaning import null_counts

log = logging.getLogger(__name__)

# Minimum rows, null share that is worth a warning, and the three named table checks.
MIN_ROWS = 30
NULL_SHARE = 0.3
TABLE_CHECKS = {
    "sales": {"required": ("date", "sales"), "numeric": ("sales",), "datetime": ("date",)},
    "customers": {"required": ("customer_id",), "numeric": (), "datetime": ()},
    "transactions": {"required": ("transaction_id", "amount", "timestamp"), "numeric": ("amount",), "datetime": ("timestamp",)},
}
TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def schema_problems(df: DataFrame, name: str) -> list[str]:
    """Differences from a named table check, read off the schema alone."""
    check = TABLE_CHECKS.get(name)
    if check is None:
        log.warning("unknown table check: %s", name)
        return []
    types = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing column {c}" for c in check["required"] if c not in types]
    problems += [f"{c} is not numeric" for c in check["numeric"] if c in types and not isinstance(types[c], T.NumericType)]
    problems += [f"{c} is not a time" for c in check["datetime"] if c in types and not isinstance(types[c], TIME_TYPES)]
    return problems


def validation_report(df: DataFrame) -> DataFrame:
    """One row per column: nulls, null share, type, and whether the share is above the limit."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    items = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"_{i}").alias("nulls"))
            for i, f in enumerate(df.schema.fields)
        ]
    )
    share = F.coalesce(F.try_divide(F.col("nulls").cast("double"), F.col("rows")), F.lit(0.0))
    return (
        counts.select(F.col("_n").alias("rows"), F.explode(items).alias("_c"))
        .select("_c.column", "_c.type", "rows", "_c.nulls")
        .withColumn("null_share", share)
        .withColumn("too_many_nulls", share > NULL_SHARE)
        .withColumn("enough_rows", F.col("rows") >= MIN_ROWS)
    )


def validate(df: DataFrame, required: Sequence[str] = (), schema: str | None = None, strict: bool = True) -> list[str]:
    """Problems of a table; a missing required column raises when strict."""
    if strict:
        require_columns(df, required)
    problems = [f"missing column {c}" for c in required if c not in df.columns]
    if schema:
        problems += schema_problems(df, schema)
    rows, nulls = null_counts(df)
    if rows < MIN_ROWS:
        problems.append(f"only {rows} rows, at least {MIN_ROWS} expected")
    problems += [f"{c} is null in {k / rows:.1%} of the rows" for c, k in nulls.items() if rows and k / rows > NULL_SHARE]
    return problems


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, nulls, mean, std, min, exact quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    edges = ranking.range_edges(df, columns)
    tagged = ranking.assign_ranges(df, edges, {c: f"_range_{i}" for i, c in enumerate(columns)})
    items = [F.struct(F.lit(c).alias("column"), clean_double(c).alias("value"), F.col(f"_range_{i}").alias("_range")) for i, c in enumerate(columns)]
    long = tagged.select(F.explode(F.array(*items)).alias("_f")).select("_f.*")
    plain = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = ranking.grouped_quantiles(long, ["column"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75}, bucket="_range")
    return plain.join(quartiles, "column", "left")


def text_summary(df: DataFrame, columns: Sequence[str] | None = None, top: int = 5) -> DataFrame:
    """Distinct count and most frequent values per text column.

    Levels are counted first; each of 64 hash slices keeps its own best ``top`` before the final
    choice, so no task sees all levels of a column.
    """
    columns = list(columns or string_columns(df))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    counts = (
        df.select(pairs.alias("_p")).select("_p.*").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
        .withColumn("_slice", F.pmod(F.xxhash64("value"), F.lit(64)))
    )
    best = Window.partitionBy("column", "_slice").orderBy(F.desc("count"), "value")
    final = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    chosen = counts.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= top)
    chosen = chosen.withColumn("place", F.row_number().over(final).cast("long")).where(F.col("place") <= top)
    return chosen.select("column", "place", "value", "count").join(distinct, "column")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    return bool(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count())


def merge(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", validate: str | None = None) -> DataFrame:
    """Equi-join with an optional cardinality check (one_to_one, one_to_many, many_to_one, many_to_many)."""
    keys = [on] if isinstance(on, str) else list(on)
    if validate:
        short = {"1:1": "one_to_one", "1:m": "one_to_many", "m:1": "many_to_one", "m:m": "many_to_many"}
        kind = short.get(validate, validate)
        if kind not in short.values():
            raise ValueError(f"unknown cardinality: {validate}")
        first, _, second = kind.split("_")
        for side, frame in ((first, left), (second, right)):
            if side == "one" and repeated_keys(frame, keys):
                raise ValueError(f"keys {keys} repeat on a side that should be unique ({kind})")
    return left.join(right, keys, how)
