"""Distribution checks: drift between two batches, correlation, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from tillscope.functions.columns import clean_double, correlation, numeric_columns
from tillscope.functions.tails import kolmogorov_upper
from tillscope.operators import ranking


def data_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per column, from cumulative distinct-value counts."""
    columns = [c for c in (columns or numeric_columns(reference)) if c in current.columns]
    both = reference.select(*[clean_double(c).alias(c) for c in columns], F.lit(0).alias("_late")).unionByName(
        current.select(*[clean_double(c).alias(c) for c in columns], F.lit(1).alias("_late"))
    )
    long = ranking.long_ranges(both, ["_late"], columns)
    d = ranking.distribution(long, "value", ["feature"], bucket="_range", weights={"late": F.col("_late")})
    upto, late = F.col("before") + F.col("n"), F.col("late_before") + F.col("late")
    early_total = F.col("total") - F.col("late_total")
    gap = F.abs(F.try_divide((upto - late).cast("double"), early_total) - F.try_divide(late.cast("double"), F.col("late_total")))
    out = d.groupBy("feature").agg(F.max(gap).alias("ks_statistic"), F.max(early_total).cast("double").alias("_n"), F.max("late_total").cast("double").alias("_m"))
    p = kolmogorov_upper(F.col("ks_statistic"), F.col("_n"), F.col("_m"))
    return out.withColumn("p_value", p).withColumn("is_drifted", F.col("p_value") < threshold).drop("_n", "_m")


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every two columns in one aggregate: (column_a, column_b, r)."""
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(columns, 2))
    both = lambda a, b: correlation(clean_double(a), clean_double(b))
    row = df.agg(*[both(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)], *[both(c, c).alias(f"d{i}") for i, c in enumerate(columns)])
    items = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    items += [F.struct(F.lit(b).alias("column_a"), F.lit(a).alias("column_b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    items += [F.struct(F.lit(c).alias("column_a"), F.lit(c).alias("column_b"), F.col(f"d{i}").alias("r")) for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*items)).alias("_p")).select("_p.*")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal bins between minimum and maximum; the last bin is closed."""
    x = clean_double(column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin long, bin_start double, bin_end double, count long")
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((x - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1)).cast("long")
    counts = df.where(x.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.createDataFrame([(i, low + i * width, low + (i + 1) * width) for i in range(bins)], "bin long, bin_start double, bin_end double")
    return grid.join(F.broadcast(counts), "bin", "left").na.fill(0, ["count"])  # at most `bins` rows
