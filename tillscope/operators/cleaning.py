"""Cleaning and scaling. Fitting collects a few numbers per column; applying is a projection."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tillscope.functions.columns import any_of, clean_double, finite_or_zero, numeric_columns, string_columns
from tillscope.operators import ranking
from tillscope.session import materialize

# Share of nulls below which numbers are filled, outlier limits, one-hot level limit.
FILL_BELOW = 0.05
OUTLIER_LIMIT = 3.0
PERCENTILE_FENCES = (0.01, 0.99)
MAX_LEVELS = 1000
DONOR_ROWS = 20_000


def standard_names(df: DataFrame) -> DataFrame:
    """Lower-case names, blanks to underscores, other signs dropped; colliding names are an error."""
    names = [re.sub(r"[^a-z0-9_]", "", c.lower().replace(" ", "_")) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after cleaning: {twice}")
    return df.toDF(*names)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """Row count and nulls (or NaN) per column, from one aggregate."""
    columns = list(columns or df.columns)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    ).first()
    return row["_n"], {c: row[f"_{i}"] for i, c in enumerate(columns)}


def clean(df: DataFrame, names: bool = True, empty_columns: bool = True, duplicates: bool = True, missing: bool = True) -> DataFrame:
    """Names, all-null columns, exact duplicates, then medians for sparsely missing numbers."""
    if names:
        df = standard_names(df)
    if empty_columns:
        rows, nulls = null_counts(df)
        df = df.drop(*[c for c, k in nulls.items() if rows and k == rows])
    if duplicates:
        df = df.dropDuplicates()
    if missing:
        numbers = numeric_columns(df)
        rows, nulls = null_counts(df, numbers) if numbers else (0, {})
        sparse = [c for c in numbers if rows and 0 < nulls[c] / rows < FILL_BELOW]
        if sparse:
            medians = ranking.column_quantiles(df, sparse, [0.5])
            df = df.withColumns({c: F.coalesce(clean_double(c), F.lit(medians[c][0])) for c in sparse})
    return df


def most_frequent(df: DataFrame, column: str):
    """Most frequent non-null value; the lowest one on a tie."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), column).limit(1).collect()
    return top[0][0] if top else None


def fit_impute(df: DataFrame, numeric: str = "mean", categorical: str = "most_frequent", columns: Sequence[str] | None = None) -> dict[str, object]:
    """Fill value per column."""
    chosen = list(columns or df.columns)
    numbers = [c for c in numeric_columns(df) if c in chosen]
    texts = [c for c in string_columns(df) if c in chosen]
    fill: dict[str, object] = {}
    if numbers and numeric == "mean":
        row = df.agg(*[F.avg(clean_double(c)).alias(f"_{i}") for i, c in enumerate(numbers)]).first()
        fill.update({c: row[i] for i, c in enumerate(numbers)})
    elif numbers and numeric == "median":
        fill.update({c: v[0] for c, v in ranking.column_quantiles(df, numbers, [0.5]).items()})
    elif numbers and numeric == "most_frequent":
        fill.update({c: most_frequent(df, c) for c in numbers})
    elif numbers:
        raise ValueError(f"unknown numeric strategy: {numeric}")
    if texts and categorical != "most_frequent":
        raise ValueError(f"unknown categorical strategy: {categorical}")
    fill.update({c: most_frequent(df, c) for c in texts})
    return fill


def impute(df: DataFrame, fill: dict[str, object]) -> DataFrame:
    numbers = set(numeric_columns(df))
    return df.withColumns({c: F.coalesce(clean_double(c) if c in numbers else F.col(c), F.lit(float(v) if c in numbers else v)) for c, v in fill.items() if v is not None})


def impute_nearest(df: DataFrame, columns: Sequence[str], neighbours: int = 5, max_donors: int = DONOR_ROWS) -> DataFrame:
    """Fill nulls with the mean of the nearest donors (nan-Euclidean distance).

    Exact, so every row is a donor; the donor matrix travels to the workers and its size is checked.
    Beyond the limit this is an error, since all pairs of rows would have to be compared: use a
    mean, median or mode there.
    """
    columns = list(columns)
    picked = df.select(*[clean_double(c).alias(c) for c in columns]).where(any_of(clean_double(c).isNotNull() for c in columns))
    pool = picked.limit(max_donors + 1).toPandas().to_numpy("float64")
    if len(pool) > max_donors:
        raise ValueError(f"nearest-neighbour filling is limited to {max_donors} rows; use impute() instead")
    known = ~np.isnan(pool)
    filled = np.where(known, pool, 0.0)
    fallback = [float(v) if v is not None else 0.0 for v in df.agg(*[F.avg(clean_double(c)) for c in columns]).first()]

    def fill(values: np.ndarray) -> np.ndarray:
        have = ~np.isnan(values)
        x = np.where(have, values, 0.0)
        shared = have.astype(float) @ known.T.astype(float)
        square = (x**2) @ known.T + have @ (filled**2).T - 2 * x @ filled.T
        distance = np.where(shared > 0, np.maximum(square, 0) * len(columns) / np.maximum(shared, 1), np.inf)
        out = values.copy()
        for j in range(len(columns)):
            rows = np.flatnonzero(~have[:, j])
            usable = np.flatnonzero(known[:, j])
            for r in rows:
                d = distance[r, usable]
                near = usable[np.argsort(d, kind="stable")[:neighbours]]
                near = near[np.isfinite(distance[r, near])]
                out[r, j] = pool[near, j].mean() if len(near) else fallback[j]
        return out

    schema = T.StructType([T.StructField(c.name, T.DoubleType() if c.name in columns else c.dataType) for c in df.schema.fields])

    def batches(frames):
        for pdf in frames:
            pdf[columns] = fill(pdf[columns].to_numpy("float64"))
            yield pdf

    spread = df.withColumns({c: clean_double(c) for c in columns})
    return spread.mapInPandas(batches, schema)


@dataclass(frozen=True)
class Fence:
    """Outlier limits of one column; values outside are outliers."""

    low: float
    high: float


def fit_fences(df: DataFrame, columns: Sequence[str], method: str = "zscore", threshold: float = OUTLIER_LIMIT) -> dict[str, Fence]:
    columns = list(columns)
    if method == "zscore":
        row = df.agg(*[f(clean_double(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return {
            c: Fence(row[f"m{i}"] - threshold * row[f"s{i}"], row[f"m{i}"] + threshold * row[f"s{i}"])
            for i, c in enumerate(columns)
            if row[f"s{i}"]
        }
    if method == "iqr":
        quartiles = ranking.column_quantiles(df, columns, [0.25, 0.75])
        return {c: Fence(a - threshold * (b - a), b + threshold * (b - a)) for c, (a, b) in quartiles.items() if a is not None}
    if method == "percentile":
        return {c: Fence(a, b) for c, (a, b) in ranking.column_quantiles(df, columns, list(PERCENTILE_FENCES)).items() if a is not None}
    raise ValueError(f"unknown method: {method}")


def is_outlier(column: str, fence: Fence) -> Column:
    x = clean_double(column)
    return F.coalesce((x < fence.low) | (x > fence.high), F.lit(False))


def handle_outliers(df: DataFrame, columns: Sequence[str] | None = None, method: str = "zscore", threshold: float = OUTLIER_LIMIT, treatment: str = "clip") -> DataFrame:
    """Clip, remove or blank outliers. Removal works column after column: later limits see fewer rows."""
    columns = [c for c in (columns or numeric_columns(df)) if c in df.columns]
    if treatment == "remove":
        for c in columns:
            fence = fit_fences(df, [c], method, threshold).get(c)
            if fence:
                df = df.where(~is_outlier(c, fence))
        return df
    fences = fit_fences(df, columns, method, threshold)
    if treatment == "nan":
        return df.withColumns({c: F.when(~is_outlier(c, f), F.col(c)) for c, f in fences.items()})
    if treatment != "clip":
        raise ValueError(f"unknown treatment: {treatment}")
    if method != "iqr" and fences:
        # clip to the most extreme values that are still inside
        inside = {c: F.when(~is_outlier(c, f), clean_double(c)) for c, f in fences.items()}
        row = df.agg(*[g(x).alias(f"{n}{i}") for i, x in enumerate(inside.values()) for n, g in (("lo", F.min), ("hi", F.max))]).first()
        fences = {c: Fence(row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(fences) if row[f"lo{i}"] is not None}
    return df.withColumns(
        {c: F.when(clean_double(c).isNotNull(), F.least(F.greatest(clean_double(c), F.lit(f.low)), F.lit(f.high))) for c, f in fences.items()}
    )


@dataclass(frozen=True)
class Scaler:
    """Centre and divisor per column."""

    method: str
    center: dict[str, float]
    scale: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (clean_double(c) - F.lit(m)) / F.lit(self.scale[c]) for c, m in self.center.items()})

    def invert(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        return df.withColumns({c: F.col(c) * F.lit(self.scale[c]) + F.lit(self.center[c]) for c in columns or self.center})


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "standard", nulls_as_zero: bool = False) -> Scaler:
    """Standard (population spread), min-max or robust (median, IQR); a constant column divides by 1."""
    columns = list(columns)
    if method == "robust":
        q = ranking.column_quantiles(df, columns, [0.25, 0.5, 0.75])
        center = {c: v[1] or 0.0 for c, v in q.items()}
        scale = {c: (v[2] - v[0]) if v[0] is not None else 1.0 for c, v in q.items()}
    elif method in ("standard", "minmax"):
        pair = (("a", F.avg), ("b", F.stddev_pop)) if method == "standard" else (("a", F.min), ("b", F.max))
        read = finite_or_zero if nulls_as_zero else clean_double
        # one line per value: an aggregate as wide as the table is far slower than a grouped one
        values = df.select(F.posexplode(F.array(*[read(c) for c in columns])).alias("_i", "_x")) if columns else None
        rows = values.groupBy("_i").agg(*[f("_x").alias(n) for n, f in pair]).collect() if columns else []
        row = {r["_i"]: r for r in rows}
        found = {c: (row[i]["a"], row[i]["b"]) if i in row else (None, None) for i, c in enumerate(columns)}
        center = {c: a or 0.0 for c, (a, _) in found.items()}
        scale = {c: (b or 0.0) - (center[c] if method == "minmax" else 0.0) for c, (_, b) in found.items()}
    else:
        raise ValueError(f"unknown scaling method: {method}")
    return Scaler(method, center, {c: v if math.isfinite(v) and v > 1e-12 else 1.0 for c, v in scale.items()})


def level_table(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null levels of a column with their row counts."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias(column)).agg(F.count(F.lit(1)).alias("n"))


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = True, max_levels: int = MAX_LEVELS) -> DataFrame:
    """0/1 columns per level in sorted order. Too many levels are an error: the result would be that wide."""
    for c in columns:
        levels = [r[0] for r in level_table(df, c).select(c).orderBy(c).limit(max_levels + 1).collect()]
        if len(levels) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels; use label codes")
        text = F.col(c).cast("string")
        added = {f"{c}_{v}": F.coalesce(text == v, F.lit(False)).cast("long") for v in levels[1 if drop_first else 0 :]}
        df = df.withColumns(added).drop(c)
    return df


def label_codes(df: DataFrame, columns: Sequence[str], tie: str) -> DataFrame:
    """Replace a level by its 0-based rank in sort order.

    The distinct levels are sorted by Spark's range partitioner and numbered by partition offsets,
    so the level list may be as long as it likes; heavy levels are cut in pieces for the join.
    """
    for c in columns:
        filled = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("None")))
        levels = materialize(level_table(filled, c).orderBy(c).withColumn("_part", F.spark_partition_id()))
        sizes = levels.groupBy("_part").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows")).orderBy("_part").collect()
        offset, run = {}, 0
        for s in sizes:  # one entry per sort partition
            offset[s["_part"]] = run
            run += s["k"]
        inner = F.row_number().over(Window.partitionBy("_part").orderBy(c))
        start = F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]) if offset else None
        if start is None:
            df = filled.withColumn(c, F.lit(None).cast("long"))
            continue
        table = levels.select(c, F.col("n").alias("_n"), (inner - 1 + F.element_at(start, F.col("_part"))).cast("long").alias("_code"))
        total = sum(s["rows"] for s in sizes)
        df = ranking.lookup(filled, table, [c], "_n", total, tie).withColumn(c, F.col("_code")).drop("_code")
    return df


def encode(df: DataFrame, columns: Sequence[str], method: str = "onehot", drop_first: bool = True, tie: str | None = None) -> DataFrame:
    if method == "onehot":
        return one_hot(df, columns, drop_first)
    if method == "label":
        return label_codes(df, columns, tie or columns[0])
    # a "target" encoding was announced by the interface we follow but never existed; do not ignore it silently
    raise ValueError(f"unknown encoding: {method}")


def numeric_features(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Model inputs: every numeric column that is not an id, a label or a result."""
    return numeric_columns(df, exclude)
