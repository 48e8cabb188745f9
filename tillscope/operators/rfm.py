"""Customer value: recency, frequency, money, scores, named segments and behaviour features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.functions.columns import DAY_MICROS, any_of, clean_double, elapsed_days, micros, safe_div
from tillscope.operators import ranking

# Score limits of the segment cascade. First match wins; a missing limit is open.
# (segment, minimum recency score, minimum frequency score, minimum money score)
SEGMENT_RULES = (
    ("Champions", 4, 4, 4),
    ("Loyal Customers", None, 4, None),
    ("Potential Loyalists", 4, 2, None),
    ("Recent Customers", 4, None, None),
    ("Promising", 3, 1, 2),
    ("Need Attention", 2, 2, None),
    ("About to Sleep", 2, None, None),
    # what is left has a recency score of 1 and, with five frequency bins, a frequency score below 4
    ("At Risk", None, 3, None),
)
LAST_SEGMENT = "Hibernating"
SCORED = ("recency", "frequency", "monetary")


def rfm(df: DataFrame, customer: str = "customer_id", date: str = "date", amount: str = "amount", reference: datetime | None = None) -> DataFrame:
    """One row per customer. The reference date defaults to the last purchase plus one day."""
    t = micros(date)
    if reference is None:
        newest = df.agg(F.max(t)).first()[0]
        at = F.lit(newest).cast("long") + F.lit(DAY_MICROS)
    else:
        at = micros(F.lit(reference))
    per_customer = df.where(F.col(customer).isNotNull()).groupBy(customer).agg(
        F.max(t).alias("_last"), F.count(F.lit(1)).alias("frequency"), F.sum(clean_double(amount)).alias("monetary")
    )
    return per_customer.select(customer, elapsed_days(at, F.col("_last")).alias("recency"), "frequency", F.coalesce("monetary", F.lit(0.0)).alias("monetary"))


def _quantile_score(df: DataFrame, column: str, bins: int, output: str) -> DataFrame:
    """Quantile bin by value, best label for the smallest value; repeated edges are merged."""
    edges = [e for e in ranking.column_quantiles(df, [column], [i / bins for i in range(bins + 1)])[column] if e is not None]
    inner = sorted(set(edges))[1:-1]
    if not inner:
        return df.withColumn(output, F.when(F.col(column).isNotNull(), F.lit(bins)).cast("long"))
    return ranking.count_below(df, column, inner, output).withColumn(output, F.lit(bins) - F.col(output))


def _position_score(df: DataFrame, column: str, tie: str, bins: int, output: str, edges: dict | None = None) -> DataFrame:
    """Quantile bin of the 1..n position by (value, tie), in whole numbers."""
    numbered = ranking.in_order(df, column, tie, position="_p", size="_n", edges=edges)
    score = F.greatest(F.lit(1), F.expr(f"((_p - 1) * {bins} + greatest(_n - 2, 0)) div greatest(_n - 1, 1)"))
    return numbered.withColumn(output, score.cast("long")).drop("_p", "_n")


def rfm_scores(table: DataFrame, customer: str = "customer_id", recency_bins: int = 5, frequency_bins: int = 5, monetary_bins: int = 5) -> DataFrame:
    """Add r, f, m scores, the joined code and the total. ``table`` is read several times: materialise it first."""
    edges = ranking.order_edges(table, ["frequency", "monetary"], customer)
    out = _quantile_score(table, "recency", recency_bins, "r_score")
    out = _position_score(out, "frequency", customer, frequency_bins, "f_score", edges)
    out = _position_score(out, "monetary", customer, monetary_bins, "m_score", edges)
    scores = [F.col(c) for c in ("r_score", "f_score", "m_score")]
    return out.withColumn("rfm_score", F.concat(*[s.cast("string") for s in scores])).withColumn("rfm_total", sum(scores[1:], scores[0]))


def segment_name() -> Column:
    """The cascade over r, f and m scores as one CASE expression."""
    names = ("r_score", "f_score", "m_score")
    out = None
    for label, *limits in SEGMENT_RULES:
        parts = [F.col(n) >= limit for n, limit in zip(names, limits) if limit is not None]
        condition = parts[0]
        for p in parts[1:]:
            condition = condition & p
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(LAST_SEGMENT)


def rfm_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", segment_name())


def group_quantiles_wide(df: DataFrame, group: str, columns: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """One row per group with exact ``{column}_{name}`` quantiles of every column."""
    long = ranking.long_ranges(df, [group], columns)
    table = ranking.grouped_quantiles(long, [group, "feature"], "value", quantiles, bucket="_range")
    picks = [F.max(F.when(F.col("feature") == c, F.col(q))).alias(f"{c}_{q}") for c in columns for q in quantiles]
    return table.groupBy(group).agg(*picks)


def segment_profiles(df: DataFrame, extra: DataFrame | None = None, customer: str = "customer_id") -> DataFrame:
    """Mean, median and count of the scored measures per segment, with size and share."""
    measures = ["recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_total"]
    if extra is not None:
        added = ["avg_order_value", "monetary_per_day"]
        df = df.join(extra.select(customer, *added), customer, "left")
        measures += added
    plain = df.groupBy("segment").agg(
        *[f(clean_double(m)).alias(f"{m}_{n}") for m in measures for n, f in (("mean", F.avg), ("count", F.count))],
        F.count(F.lit(1)).alias("customer_count"),
    )
    medians = group_quantiles_wide(df, "segment", measures, {"median": 0.5})
    total = F.sum("customer_count").over(Window.partitionBy())  # over one row per segment
    return (
        plain.join(medians, "segment", "left")
        .withColumn("customer_percentage", F.col("customer_count") / total * 100)
        .orderBy(F.desc("monetary_mean"), "segment")
    )


def value_features(table: DataFrame) -> DataFrame:
    """Ratios and logs that need only the three measures."""
    r, f, m = (F.col(c).cast("double") for c in SCORED)
    return table.withColumns(
        {
            "avg_order_value": safe_div(m, f),
            "monetary_per_day": m / (r + 1),
            "log_monetary": F.log1p(m),
            "log_frequency": F.log1p(f),
            "recency_inverse": F.lit(1.0) / (r + 1),
        }
    )


def purchase_behaviour(df: DataFrame, customer: str = "customer_id", date: str = "date", amount: str = "amount", purchase: str = "transaction_id") -> DataFrame:
    """Spread, intervals, calendar habits and spending trend per customer.

    The purchases are numbered once per customer by (date, purchase id); every statistic but the
    median is then one grouped aggregate with partial sums.
    """
    known = df.where(F.col(customer).isNotNull()).select(
        customer, micros(date).alias("_t"), F.col(date).cast("timestamp").alias("_ts"), clean_double(amount).alias("_x"), F.col(purchase).alias("_id")
    )
    steps = ranking.in_order(known, "_t", "_id", [customer], previous={"_t0": "_t"})
    gap = elapsed_days(F.col("_t"), F.col("_t0"))
    day = F.weekday("_ts").cast("long")
    grouped = steps.groupBy(customer).agg(
        F.coalesce(F.stddev_samp("_x"), F.lit(0.0)).alias("amount_std"),
        F.min("_x").alias("amount_min"),
        F.max("_x").alias("amount_max"),
        F.avg(gap).alias("avg_days_between"),
        F.stddev_samp(gap).alias("std_days_between"),
        F.min(gap).alias("min_days_between"),
        F.max(gap).alias("max_days_between"),
        F.avg((day >= 5).cast("double")).alias("weekend_purchase_ratio"),
        F.mode(F.hour("_ts").cast("long"), True).alias("preferred_hour"),  # at most 24 counters
        F.mode(day, True).alias("preferred_day"),  # at most 7 counters
        F.coalesce(F.regr_slope(F.col("_x"), F.col("position").cast("double")), F.lit(0.0)).alias("spending_trend"),
    )
    medians = ranking.grouped_quantiles(known, [customer], "_x", {"amount_median": 0.5})
    return grouped.join(medians, customer, "left")


def rfm_features(table: DataFrame, purchases: DataFrame | None = None, customer: str = "customer_id", **names: str) -> DataFrame:
    """Value features, and behaviour features when the purchases are given."""
    out = value_features(table)
    if purchases is None:
        return out
    out = out.join(purchase_behaviour(purchases, customer, **names), customer, "left")
    return out.withColumn("amount_cv", F.col("amount_std") / (F.col("avg_order_value") + 1))


def outlier_customers(features: DataFrame, columns: Sequence[str], method: str = "iqr", threshold: float = 1.5) -> DataFrame:
    """Rows that are outliers in any of the columns."""
    present = [c for c in columns if c in features.columns]
    if method == "iqr":
        fences = ranking.column_quantiles(features, present, [0.25, 0.75])
        tests = []
        for c, (low, high) in fences.items():
            if low is not None:
                reach = threshold * (high - low)
                tests.append((F.col(c) < low - reach) | (F.col(c) > high + reach))
    elif method == "zscore":
        moments = features.agg(*[f(clean_double(c)).alias(f"{n}{i}") for i, c in enumerate(present) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        tests = [F.abs(F.col(c) - moments[f"m{i}"]) > threshold * moments[f"s{i}"] for i, c in enumerate(present) if moments[f"s{i}"]]
    else:
        raise ValueError(f"unknown method: {method}")
    return features.where(F.coalesce(any_of(tests), F.lit(False)))


def feature_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max, one row per feature."""
    long = ranking.long_ranges(df, [], columns)
    plain = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    quartiles = ranking.grouped_quantiles(long, ["feature"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, bucket="_range")
    return plain.join(quartiles, "feature", "left")
