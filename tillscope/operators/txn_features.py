"""Features of single transactions: amount, calendar, customer profile, velocity, rank."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillscope.functions.columns import DAY_MICROS, HOUR_MICROS, clean_double, elapsed_days, flag, micros, require_columns, safe_div
from tillscope.operators import ranking, trailing

# Feature windows in hours, percentile and deviation limits of the feature set.
VELOCITY_HOURS = (1, 6, 24)
STATISTIC_HOURS = (1, 24, 168)
LARGE_AMOUNT_QUANTILE = 0.95
DEVIATION_LIMIT = 3.0
RARE_SHARE = 0.01
RAPID_HOURS = 0.5


@dataclass(frozen=True)
class Columns:
    """Column names of a transaction table."""

    transaction: str = "transaction_id"
    customer: str = "customer_id"
    amount: str = "amount"
    timestamp: str = "timestamp"


@dataclass(frozen=True)
class AmountModel:
    """Numbers of the training batch that amount features refer to."""

    rows: int
    mean: float
    std: float | None
    large: float
    decile_edges: tuple[float, ...]


def fit_amounts(df: DataFrame, c: Columns = Columns()) -> AmountModel:
    """Global mean, spread, P95 and decile edges; two small aggregates, no data leaves Spark."""
    x = clean_double(c.amount)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).first()
    levels = [i / 10 for i in range(11)] + [LARGE_AMOUNT_QUANTILE]
    q = ranking.column_quantiles(df, [c.amount], levels)[c.amount]
    return AmountModel(row.n, row.m or 0.0, row.s, q[11] if q[11] is not None else 0.0, tuple(v for v in q[:11] if v is not None))


def decile_bin(df: DataFrame, column: str, edges: Sequence[float], output: str) -> DataFrame:
    """0-based quantile bin, right-closed, lowest value included, repeated edges dropped."""
    distinct = sorted(set(edges))
    if len(distinct) < 2:
        return df.withColumn(output, F.lit(None).cast("long"))
    inner = distinct[1:-1]
    binned = ranking.count_below(df, column, inner, output) if inner else df.withColumn(output, F.when(F.col(column).isNotNull(), F.lit(0)).cast("long"))
    inside = F.col(column).between(distinct[0], distinct[-1])
    return binned.withColumn(output, F.when(inside, F.col(output)))


def amount_features(df: DataFrame, model: AmountModel, c: Columns = Columns()) -> DataFrame:
    x = F.col(c.amount).cast("double")
    # cents from the rounded hundredths: float truncation would turn 16.99 into 98
    cents = F.pmod(F.round(x * 100).cast("long"), F.lit(100))
    out = df.withColumn("amount_log", F.log1p(x))
    out = decile_bin(out, c.amount, model.decile_edges, "amount_bin")
    return (
        out.withColumn("is_round_amount", flag(F.pmod(x, F.lit(10.0)) == 0))
        .withColumn("is_large_amount", flag(x > F.lit(model.large)))
        .withColumn("amount_cents", cents)
        .withColumn("ends_in_99", flag(cents == 99))
    )


def time_features(df: DataFrame, c: Columns = Columns()) -> DataFrame:
    ts = F.col(c.timestamp).cast("timestamp")
    hour, day = F.hour(ts).cast("long"), F.weekday(ts).cast("long")
    turn = 2 * F.pi()
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": day,
            "day_of_month": F.dayofmonth(ts).cast("long"),
            "month": F.month(ts).cast("long"),
            "is_weekend": flag(day >= 5),
            "time_period": F.when(hour <= 6, "night").when(hour <= 12, "morning").when(hour <= 18, "afternoon").when(hour <= 24, "evening"),
            "is_business_hours": flag(hour.between(9, 17) & (day < 5)),
            "is_unusual_time": flag(hour <= 5),
            "hour_sin": F.sin(turn * hour / 24),
            "hour_cos": F.cos(turn * hour / 24),
            "dow_sin": F.sin(turn * day / 7),
            "dow_cos": F.cos(turn * day / 7),
        }
    )


def with_history(df: DataFrame, model: AmountModel, c: Columns = Columns(), velocity: Sequence[int] = VELOCITY_HOURS, statistic: Sequence[int] = STATISTIC_HOURS, rows: DataFrame | None = None) -> DataFrame:
    """Customer profile, previous transaction and trailing windows from one shuffle of the rows.

    ``rows`` is a frame of the same rows that is cheaper to read; the customers' sizes are counted there.
    """
    hours = sorted({*velocity, *statistic})
    rows = df if rows is None else rows
    busy = trailing.busy_keys(rows, c.customer, c.timestamp, model.rows)
    cell = trailing.choose_cell(rows, c.customer, c.timestamp, hours, model.rows)
    p = trailing.trailing_profile(df, c.customer, c.timestamp, c.amount, c.transaction, hours, model.mean, cell, busy)
    x = F.col(c.amount).cast("double")
    age = elapsed_days(F.col("_k_last"), F.col("_k_first"))
    mean, std = trailing.mean_of("_k_", model.mean), trailing.std_of("_k_")
    since = F.coalesce((micros(c.timestamp) - F.col("_prev_t")) / F.lit(float(HOUR_MICROS)), F.lit(0.0))
    change = F.coalesce(x - F.col("_prev_x"), F.lit(0.0))
    out: dict[str, Column] = {
        "cust_amount_mean": mean,
        "cust_amount_std": std,
        "cust_amount_min": F.col("_k_lo"),
        "cust_amount_max": F.col("_k_hi"),
        "cust_transaction_count": F.col("_k_n").cast("long"),
        "cust_account_age": age,
        "cust_txn_per_day": F.col("_k_n") / (age + 1),
        "amount_deviation": safe_div(x - mean, std + 1),
        "is_max_amount": flag(x == F.col("_k_hi")),
        "amount_to_avg_ratio": safe_div(x, mean + 1),
        "hours_since_last": since,
        "amount_change": change,
        "amount_change_pct": safe_div(change, F.col("_prev_x") + 1, 0.0),
    }
    for w in velocity:
        out[f"txn_count_{w}h"] = F.col(f"_w{w}_n").cast("long")
        out[f"amount_sum_{w}h"] = F.when(F.col(f"_w{w}_n") > 0, F.col(f"_w{w}_s") + F.col(f"_w{w}_n") * F.lit(model.mean))
    out["rapid_succession"] = flag(since < RAPID_HOURS)
    for w in statistic:
        out[f"amount_mean_{w}h"] = trailing.mean_of(f"_w{w}_", model.mean)
        out[f"amount_std_{w}h"] = F.coalesce(trailing.std_of(f"_w{w}_"), F.lit(0.0))
        out[f"amount_max_{w}h"] = F.col(f"_w{w}_hi")
        out[f"amount_min_{w}h"] = F.col(f"_w{w}_lo")
        out[f"count_{w}h"] = F.col(f"_w{w}_n").cast("long")
    return p.select(*df.columns, *[v.alias(k) for k, v in out.items()])


def rank_shares(df: DataFrame, model: AmountModel, c: Columns = Columns(), hot_rows: int = ranking.HOT_KEY_ROWS) -> DataFrame:
    """Average-rank share of the amount, over all rows and within the customer.

    Ranks are found on distinct (customer, amount) counts and on distinct amounts; the facts are
    joined once, on (customer, amount), with heavy pairs cut in pieces.
    """
    edges = ranking.range_edges(df, [c.amount])
    keyed = ranking.assign_ranges(df.withColumn("_amt", clean_double(c.amount)), {"_amt": edges[c.amount]}, {"_amt": "_range"})
    share = ranking.average_rank() / F.col("total")
    within = ranking.distribution(keyed, "_amt", [c.customer], bucket="_range")
    within = within.select(c.customer, "_amt", F.col("n").alias("_n"), share.alias("amount_percentile_customer"))
    overall = ranking.distribution(keyed, "_amt", bucket="_range").select("_amt", F.col("n").alias("_all"), share.alias("amount_percentile"))
    # rows of a null customer have a global share only, so both tables hang on the facts
    narrow = keyed.drop("_range")
    out = ranking.lookup(narrow, overall, ["_amt"], "_all", model.rows, c.transaction, hot_rows)
    out = ranking.lookup(out, within, [c.customer, "_amt"], "_n", model.rows, c.transaction, hot_rows)
    return out.select(*df.columns, "amount_percentile", "amount_percentile_customer")


def zscores(df: DataFrame, model: AmountModel, c: Columns = Columns()) -> DataFrame:
    """Global z-score and the two |z| > 3 flags; needs ``amount_deviation``."""
    x = F.col(c.amount).cast("double")
    z = (x - F.lit(model.mean)) / (F.lit(model.std) + F.lit(1e-10))
    return df.withColumns(
        {
            "amount_zscore_global": z,
            "amount_zscore_customer": F.col("amount_deviation"),
            "high_zscore": flag(F.abs(z) > DEVIATION_LIMIT),
            "high_customer_zscore": flag(F.abs(F.col("amount_deviation")) > DEVIATION_LIMIT),
        }
    )


def level_frequencies(df: DataFrame, column: str) -> DataFrame:
    """(level, n, share of non-null rows). Pre-aggregated; the total comes from the level counts."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(column)).first()[0]
    return counts.withColumn("share", safe_div(F.col("n"), F.lit(total)))


def encode_levels(df: DataFrame, columns: Sequence[str], tie: str, hot_rows: int = ranking.HOT_KEY_ROWS, rows: DataFrame | None = None) -> DataFrame:
    """Frequency code and rare-level flag per text column; ``rows`` is a frame of the same rows to count levels in."""
    rows = df if rows is None else rows
    for name in columns:
        if name not in df.columns:
            continue
        total = rows.agg(F.count(name)).first()[0]
        table = level_frequencies(rows, name).select(name, F.col("n").alias("_n"), F.col("share").alias(f"{name}_freq"))
        df = ranking.lookup(df, table, [name], "_n", total, tie, hot_rows)
        df = df.withColumn(f"{name}_is_rare", flag(F.col(f"{name}_freq") < RARE_SHARE))
    return df


def transaction_features(df: DataFrame, c: Columns = Columns(), categorical: Sequence[str] = (), model: AmountModel | None = None) -> DataFrame:
    """The whole feature set, in the order in which the shuffles are cheapest."""
    require_columns(df, [c.transaction, c.customer, c.amount, c.timestamp])
    model = model or fit_amounts(df, c)
    out = rank_shares(df, model, c)
    # sizes and levels are counted in the input: the joined frame would be computed once more for each count
    out = with_history(out, model, c, rows=df)
    out = zscores(time_features(amount_features(out, model, c), c), model, c)
    return encode_levels(out, categorical, c.transaction, rows=df)


def customer_baselines(df: DataFrame, c: Columns = Columns()) -> DataFrame:
    """Mean, spread, median, extremes, activity span and usual hour per customer."""
    x, ts = clean_double(c.amount), F.col(c.timestamp).cast("timestamp")
    plain = df.where(F.col(c.customer).isNotNull()).groupBy(c.customer).agg(
        F.avg(x).alias("baseline_mean"),
        F.stddev_samp(x).alias("baseline_std"),
        F.min(x).alias("baseline_min"),
        F.max(x).alias("baseline_max"),
        F.count(ts).alias("total_transactions"),
        F.min(ts).alias("first_transaction"),
        F.max(ts).alias("last_transaction"),
        F.mode(F.hour(ts).cast("long"), True).alias("typical_hour"),  # at most 24 counters per buffer
    )
    medians = ranking.grouped_quantiles(df, [c.customer], c.amount, {"baseline_median": 0.5})
    return plain.join(medians, c.customer, "left")


def baseline_deviations(df: DataFrame, baselines: DataFrame, total: int, c: Columns = Columns(), threshold: float = DEVIATION_LIMIT) -> DataFrame:
    """Deviation from the customer's own baseline and its flag."""
    table = baselines.select(c.customer, "baseline_mean", "baseline_std", F.col("total_transactions").alias("_n"))
    out = ranking.lookup(df, table, [c.customer], "_n", total, c.transaction)
    deviation = safe_div(F.col(c.amount).cast("double") - F.col("baseline_mean"), F.col("baseline_std") + 1)
    return out.withColumn("baseline_deviation", deviation).withColumn("exceeds_baseline", flag(F.abs(deviation) > threshold))


def feature_names(velocity: Sequence[int] = VELOCITY_HOURS, statistic: Sequence[int] = STATISTIC_HOURS) -> list[str]:
    """Names of the engineered columns, by group."""
    amount = ["amount_log", "amount_bin", "is_round_amount", "is_large_amount", "amount_cents", "ends_in_99"]
    calendar = ["hour", "day_of_week", "day_of_month", "month", "is_weekend", "time_period", "is_business_hours", "is_unusual_time"]
    cycle = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
    customer = [f"cust_{n}" for n in ("amount_mean", "amount_std", "amount_min", "amount_max", "transaction_count", "account_age", "txn_per_day")]
    relative = ["amount_deviation", "is_max_amount", "amount_to_avg_ratio"]
    change = ["hours_since_last", "amount_change", "amount_change_pct", "rapid_succession"]
    score = ["amount_zscore_global", "amount_zscore_customer", "amount_percentile", "amount_percentile_customer", "high_zscore", "high_customer_zscore"]
    rolling = [n for w in velocity for n in (f"txn_count_{w}h", f"amount_sum_{w}h")]
    rolling += [f"{n}_{w}h" for w in statistic for n in ("amount_mean", "amount_std", "amount_max", "amount_min", "count")]
    return [*amount, *calendar, *cycle, *customer, *relative, *change, *score, *rolling]
