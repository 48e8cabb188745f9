"""Registered queries on single transactions, each with its comparison SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillscope.operators import txn_features as tf
from tillscope.plans.sql_parts import TXN
from tillscope.plans.views import rounded, transactions

_ID = "transaction_id"
# means of cents have short decimal forms: compare them far from rounding ties
_MEANS = {n: 8 for n in ("cust_amount_mean", "baseline_mean", *[f"amount_mean_{w}h" for w in tf.STATISTIC_HOURS])}


def q_amount(spark, d):
    df = transactions(spark, d)
    out = tf.amount_features(df, tf.fit_amounts(df))
    return rounded(out.select(_ID, "amount_log", "amount_bin", "is_round_amount", "is_large_amount", "amount_cents", "ends_in_99"))


def q_time(spark, d):
    names = tf.feature_names()
    wanted = [n for n in names[names.index("hour") : names.index("dow_cos") + 1]]
    return rounded(tf.time_features(transactions(spark, d)).select(_ID, *wanted))


def _history(spark, d, columns):
    df = transactions(spark, d)
    return rounded(tf.with_history(df, tf.fit_amounts(df)).select(_ID, *columns), 4, **_MEANS)


PROFILE = ["cust_amount_mean", "cust_amount_std", "cust_amount_min", "cust_amount_max", "cust_transaction_count", "cust_account_age", "cust_txn_per_day"]
RELATIVE = ["amount_deviation", "is_max_amount", "amount_to_avg_ratio"]
CHANGES = ["hours_since_last", "amount_change", "amount_change_pct", "rapid_succession"]
VELOCITY = [f"{n}_{w}h" for w in tf.VELOCITY_HOURS for n in ("txn_count", "amount_sum")]
ROLLING = [f"{n}_{w}h" for w in tf.STATISTIC_HOURS for n in ("amount_mean", "amount_std", "amount_max", "amount_min", "count")]


def q_percentiles(spark, d):
    df = transactions(spark, d)
    return rounded(tf.rank_shares(df, tf.fit_amounts(df)).select(_ID, "amount_percentile", "amount_percentile_customer"))


def q_zscores(spark, d):
    df = transactions(spark, d)
    model = tf.fit_amounts(df)
    out = tf.zscores(tf.with_history(df, model), model)
    return rounded(out.select(_ID, "amount_zscore_global", "amount_zscore_customer", "high_zscore", "high_customer_zscore"), 4)


def q_levels(spark, d):
    return rounded(tf.encode_levels(transactions(spark, d), ["category"], _ID).select(_ID, "category_freq", "category_is_rare"))


def q_level_table(spark, d):
    return rounded(tf.level_frequencies(transactions(spark, d), "category"))


def q_baselines(spark, d):
    return rounded(tf.customer_baselines(transactions(spark, d)).drop("first_transaction", "last_transaction"), 4, **_MEANS)


def q_deviation(spark, d):
    df = transactions(spark, d)
    out = tf.baseline_deviations(df, tf.customer_baselines(df), df.count())
    return rounded(out.select(_ID, "baseline_deviation", "exceeds_baseline"), 4)


def q_all_features(spark, d):
    df = transactions(spark, d)
    out = tf.transaction_features(df, categorical=["category"])
    return rounded(out.select(_ID, *tf.feature_names(), "category_freq", "category_is_rare"), 4, **_MEANS)


_STATS = """stats AS (SELECT *, avg(amount) OVER c AS mu, stddev_samp(amount) OVER c AS sd, min(amount) OVER c AS lo, max(amount) OVER c AS hi,
  count(amount) OVER c AS n, floor((max(t) OVER c - min(t) OVER c) / 86400000000.0) AS age FROM txn WINDOW c AS (PARTITION BY customer_id))"""
_PREV = """prev AS (SELECT *, lag(t) OVER w AS t0, lag(amount) OVER w AS a0 FROM txn WINDOW w AS (PARTITION BY customer_id ORDER BY t, transaction_id))"""
_GLOBAL = "g AS (SELECT avg(amount) AS gm, stddev_samp(amount) AS gs, quantile_cont(amount, 0.95) AS p95, list_sort(list_distinct(quantile_cont(amount, [0,.1,.2,.3,.4,.5,.6,.7,.8,.9,1]))) AS e FROM txn)"

_AMOUNT = {
    "amount_log": "round(ln(1 + amount), {r})",
    "amount_bin": "CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < amount)) AS BIGINT)",
    "is_round_amount": "CAST(amount % 10 = 0 AS BIGINT)",
    "is_large_amount": "CAST(amount > p95 AS BIGINT)",
    "amount_cents": "CAST(round(amount * 100) AS BIGINT) % 100",
    "ends_in_99": "CAST(CAST(round(amount * 100) AS BIGINT) % 100 = 99 AS BIGINT)",
}
_TIME = {
    "hour": "CAST(hour(\"timestamp\") AS BIGINT)",
    "day_of_week": "CAST(isodow(\"timestamp\") - 1 AS BIGINT)",
    "day_of_month": "CAST(day(\"timestamp\") AS BIGINT)",
    "month": "CAST(month(\"timestamp\") AS BIGINT)",
    "is_weekend": "CAST(isodow(\"timestamp\") >= 6 AS BIGINT)",
    "time_period": "CASE WHEN hour(\"timestamp\") <= 6 THEN 'night' WHEN hour(\"timestamp\") <= 12 THEN 'morning' WHEN hour(\"timestamp\") <= 18 THEN 'afternoon' ELSE 'evening' END",
    "is_business_hours": "CAST(hour(\"timestamp\") BETWEEN 9 AND 17 AND isodow(\"timestamp\") < 6 AS BIGINT)",
    "is_unusual_time": "CAST(hour(\"timestamp\") <= 5 AS BIGINT)",
    "hour_sin": "round(sin(2 * pi() * hour(\"timestamp\") / 24), {r}) + 0.0",
    "hour_cos": "round(cos(2 * pi() * hour(\"timestamp\") / 24), {r}) + 0.0",
    "dow_sin": "round(sin(2 * pi() * (isodow(\"timestamp\") - 1) / 7), {r}) + 0.0",
    "dow_cos": "round(cos(2 * pi() * (isodow(\"timestamp\") - 1) / 7), {r}) + 0.0",
}
_PROFILE = {
    "cust_amount_mean": "round(mu, 8)",
    "cust_amount_std": "round(sd, 4)",
    "cust_amount_min": "round(lo, 4)",
    "cust_amount_max": "round(hi, 4)",
    "cust_transaction_count": "CAST(n AS BIGINT)",
    "cust_account_age": "CAST(age AS BIGINT)",
    "cust_txn_per_day": "round(n / (age + 1), 4)",
}
_RELATIVE = {
    "amount_deviation": "round((amount - mu) / (sd + 1), 4) + 0.0",
    "is_max_amount": "CAST(amount = hi AS BIGINT)",
    "amount_to_avg_ratio": "round(amount / (mu + 1), 4)",
}
_CHANGE = {
    "hours_since_last": "round(coalesce((t - t0) / 3600000000.0, 0), 4)",
    "amount_change": "round(coalesce(amount - a0, 0), 4) + 0.0",
    "amount_change_pct": "round(coalesce((amount - a0) / nullif(a0 + 1, 0), 0), 4) + 0.0",
    "rapid_succession": "CAST(coalesce((t - t0) / 3600000000.0, 0) < 0.5 AS BIGINT)",
}
_Z = {
    "amount_zscore_global": "round((amount - gm) / (gs + 1e-10), 4) + 0.0",
    "amount_zscore_customer": "round((amount - mu) / (sd + 1), 4) + 0.0",
    "high_zscore": "CAST(abs((amount - gm) / (gs + 1e-10)) > 3 AS BIGINT)",
    "high_customer_zscore": "CAST(abs((amount - mu) / (sd + 1)) > 3 AS BIGINT)",
}
_RANK = {
    "amount_percentile": "round((rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0) / count(*) OVER (), {r})",
    "amount_percentile_customer": "round((rank() OVER (PARTITION BY customer_id ORDER BY amount) + (count(*) OVER (PARTITION BY customer_id, amount) - 1) / 2.0) / count(*) OVER (PARTITION BY customer_id), {r})",
}
_LEVEL = {
    "category_freq": "round(count(*) OVER (PARTITION BY category) * 1.0 / count(*) OVER (), {r})",
    "category_is_rare": "CAST(count(*) OVER (PARTITION BY category) * 1.0 / count(*) OVER () < 0.01 AS BIGINT)",
}


def _over(w: int) -> str:
    return f"OVER (PARTITION BY customer_id ORDER BY t RANGE BETWEEN {w * 3600000000 - 1} PRECEDING AND CURRENT ROW)"


_VELOCITY = {}
for _w in tf.VELOCITY_HOURS:
    _VELOCITY[f"txn_count_{_w}h"] = f"CAST(count(amount) {_over(_w)} AS BIGINT)"
    _VELOCITY[f"amount_sum_{_w}h"] = f"round(sum(amount) {_over(_w)}, 4)"
_ROLLING = {}
for _w in tf.STATISTIC_HOURS:
    _ROLLING[f"amount_mean_{_w}h"] = f"round(avg(amount) {_over(_w)}, 8)"
    _ROLLING[f"amount_std_{_w}h"] = f"round(coalesce(stddev_samp(amount) {_over(_w)}, 0), 4)"
    _ROLLING[f"amount_max_{_w}h"] = f"round(max(amount) {_over(_w)}, 4)"
    _ROLLING[f"amount_min_{_w}h"] = f"round(min(amount) {_over(_w)}, 4)"
    _ROLLING[f"count_{_w}h"] = f"CAST(count(amount) {_over(_w)} AS BIGINT)"


def _select(parts: dict[str, str], digits: int = 6) -> str:
    return ", ".join(f"{v.replace('{r}', str(digits))} AS {k}" for k, v in parts.items())


_ALL = {**_AMOUNT, **_TIME, **_PROFILE, **_RELATIVE, **_CHANGE, **_Z}

QUERIES = {
    "txn_amount_features": (q_amount, f"WITH {TXN}, {_GLOBAL} SELECT transaction_id, {_select(_AMOUNT)} FROM txn, g"),
    "txn_time_features": (q_time, f"WITH {TXN} SELECT transaction_id, {_select(_TIME)} FROM txn"),
    "txn_customer_profile": (lambda s, d: _history(s, d, PROFILE), f"WITH {TXN}, {_STATS} SELECT transaction_id, {_select(_PROFILE)} FROM stats"),
    "txn_relative_amount": (lambda s, d: _history(s, d, RELATIVE), f"WITH {TXN}, {_STATS} SELECT transaction_id, {_select(_RELATIVE)} FROM stats"),
    "txn_changes": (lambda s, d: _history(s, d, CHANGES), f"WITH {TXN}, {_PREV} SELECT transaction_id, {_select(_CHANGE)} FROM prev"),
    "txn_velocity": (lambda s, d: _history(s, d, VELOCITY), f"WITH {TXN} SELECT transaction_id, {_select(_VELOCITY)} FROM txn"),
    "txn_window_stats": (lambda s, d: _history(s, d, ROLLING), f"WITH {TXN} SELECT transaction_id, {_select(_ROLLING)} FROM txn"),
    "txn_percentiles": (q_percentiles, f"WITH {TXN} SELECT transaction_id, {_select(_RANK)} FROM txn"),
    "txn_zscores": (q_zscores, f"WITH {TXN}, {_GLOBAL}, {_STATS} SELECT transaction_id, {_select(_Z)} FROM stats, g"),
    "rare_levels": (q_levels, f"WITH {TXN} SELECT transaction_id, {_select(_LEVEL)} FROM txn"),
    "level_frequencies": (q_level_table, f"WITH {TXN} SELECT category, CAST(count(*) AS BIGINT) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share FROM txn GROUP BY category"),
    "baselines": (
        q_baselines,
        f"WITH {TXN}, hours AS (SELECT customer_id, h, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, h) AS k "
        "FROM (SELECT customer_id, hour(\"timestamp\") AS h FROM txn) GROUP BY customer_id, h) "
        "SELECT customer_id, round(avg(amount), 8) AS baseline_mean, round(stddev_samp(amount), 4) AS baseline_std, round(min(amount), 4) AS baseline_min, round(max(amount), 4) AS baseline_max, "
        "CAST(count(*) AS BIGINT) AS total_transactions, CAST(max(h) AS BIGINT) AS typical_hour, round(median(amount), 4) AS baseline_median "
        "FROM txn JOIN (SELECT customer_id, h FROM hours WHERE k = 1) USING (customer_id) GROUP BY customer_id",
    ),
    "baseline_deviation": (
        q_deviation,
        f"WITH {TXN}, {_STATS} SELECT transaction_id, round((amount - mu) / (sd + 1), 4) + 0.0 AS baseline_deviation, CAST(abs((amount - mu) / (sd + 1)) > 3 AS BIGINT) AS exceeds_baseline FROM stats",
    ),
    "txn_all_features": (
        q_all_features,
        f"WITH {TXN}, {_GLOBAL}, {_STATS}, {_PREV}, j AS (SELECT stats.*, t0, a0, g.* FROM stats JOIN prev USING (transaction_id), g) "
        f"SELECT transaction_id, {_select({**_ALL, **_VELOCITY, **_ROLLING, **_RANK, **_LEVEL}, 4)} FROM j",
    ),
}
