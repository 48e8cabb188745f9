"""Registered queries on customers and purchases, each with its comparison SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillscope.operators import rfm
from tillscope.plans.sql_parts import PURCHASES, SEGS, rfm_of, scores_of, segments_of
from tillscope.plans.views import purchases, rounded, scored_customers, table
from tillscope.session import materialize


def q_rfm(spark, d):
    return rounded(rfm.rfm(purchases(spark, d)), 2)


def q_rfm_scores(spark, d):
    return rounded(rfm.rfm_scores(materialize(rfm.rfm(purchases(spark, d)))), 2)


def q_rfm_segments(spark, d):
    return rounded(scored_customers(spark, d).select("customer_id", "rfm_score", "rfm_total", "segment"), 2)


def q_segment_profile(spark, d):
    return rounded(rfm.segment_profiles(scored_customers(spark, d)), 4)


def q_segment_profile_with_features(spark, d):
    seg = scored_customers(spark, d)
    extra = rfm.value_features(seg.select("customer_id", "recency", "frequency", "monetary"))
    keep = ["segment", "avg_order_value_mean", "avg_order_value_median", "monetary_per_day_mean", "monetary_per_day_median", "customer_count"]
    return rounded(rfm.segment_profiles(seg, extra).select(*keep), 4)


BEHAVIOUR = ["amount_std", "amount_min", "amount_max", "amount_median"]
INTERVALS = ["avg_days_between", "std_days_between", "min_days_between", "max_days_between"]
HABITS = ["weekend_purchase_ratio", "preferred_hour", "preferred_day"]


def _behaviour(spark, d, columns):
    return rounded(rfm.purchase_behaviour(purchases(spark, d)).select("customer_id", *columns), 4)


def q_rfm_features(spark, d):
    p = purchases(spark, d)
    base = rfm.rfm(p).withColumn("monetary", F.round(F.col("monetary") * 100) / 100)  # whole cents
    out = rfm.rfm_features(materialize(base), p)
    keep = ["avg_order_value", "monetary_per_day", "log_monetary", "log_frequency", "recency_inverse", "amount_cv", "spending_trend", "amount_median", "avg_days_between"]
    return rounded(out.select("customer_id", *keep), 4)


def q_outlier_customers(spark, d):
    base = materialize(rfm.rfm(purchases(spark, d)))
    return rounded(rfm.outlier_customers(base, ["recency", "monetary"]), 2)


def q_outlier_customers_zscore(spark, d):
    base = materialize(rfm.rfm(purchases(spark, d)))
    return rounded(rfm.outlier_customers(base, ["recency", "frequency", "monetary"], "zscore", 2.0), 2)


def q_feature_summary(spark, d):
    base = materialize(rfm.value_features(rfm.rfm(purchases(spark, d))))
    return rounded(rfm.feature_summary(base, ["recency", "frequency", "monetary", "avg_order_value", "log_monetary", "recency_inverse"]), 4)


_RFM = f"WITH {PURCHASES},\n{rfm_of('purchases')}"
_FEATURES = """feats AS (SELECT *, monetary / frequency AS avg_order_value, monetary / (recency + 1) AS monetary_per_day,
  ln(1 + monetary) AS log_monetary, ln(1 + frequency) AS log_frequency, 1.0 / (recency + 1) AS recency_inverse FROM rfm)"""
_MEASURES = ["recency", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_total"]
_STEPS = """steps AS (SELECT *, floor((epoch_us(date) - epoch_us(lag(date) OVER w)) / 86400000000.0) AS gap,
  row_number() OVER w AS pos FROM purchases WINDOW w AS (PARTITION BY customer_id ORDER BY date, transaction_id))"""
_MODES = """hours AS (SELECT customer_id, h, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, h) AS k
  FROM (SELECT customer_id, hour(date) AS h FROM purchases) GROUP BY customer_id, h),
days AS (SELECT customer_id, w, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, w) AS k
  FROM (SELECT customer_id, isodow(date) - 1 AS w FROM purchases) GROUP BY customer_id, w)"""

QUERIES = {
    "rfm": (q_rfm, f"{_RFM} SELECT customer_id, recency, frequency, round(monetary, 2) AS monetary FROM rfm"),
    "rfm_scores": (
        q_rfm_scores,
        f"{_RFM},\n{scores_of('rfm')} SELECT customer_id, recency, frequency, round(monetary, 2) AS monetary, r_score, f_score, m_score, rfm_score, rfm_total FROM scored",
    ),
    "rfm_segments": (q_rfm_segments, f"WITH {SEGS} SELECT customer_id, rfm_score, rfm_total, segment FROM segs"),
    "segment_profile": (
        q_segment_profile,
        f"WITH {SEGS} SELECT segment, "
        + ", ".join(
            f"round(avg({m}), 4) AS {m}_mean, round(CAST(median({m}) AS DOUBLE), 4) AS {m}_median, CAST(count({m}) AS BIGINT) AS {m}_count" for m in _MEASURES
        )
        + ", CAST(count(*) AS BIGINT) AS customer_count, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS customer_percentage FROM segs GROUP BY segment",
    ),
    "segment_profile_with_features": (
        q_segment_profile_with_features,
        f"WITH {SEGS}, f AS (SELECT *, monetary / frequency AS avg_order_value, monetary / (recency + 1) AS monetary_per_day FROM segs) SELECT segment, "
        + ", ".join(f"round(avg({m}), 4) AS {m}_mean, round(median({m}), 4) AS {m}_median" for m in ("avg_order_value", "monetary_per_day"))
        + ", CAST(count(*) AS BIGINT) AS customer_count FROM f GROUP BY segment",
    ),
    "amount_statistics": (
        lambda spark, d: _behaviour(spark, d, BEHAVIOUR),
        f"WITH {PURCHASES} SELECT customer_id, round(coalesce(stddev_samp(amount), 0), 4) AS amount_std, round(min(amount), 4) AS amount_min, "
        "round(max(amount), 4) AS amount_max, round(median(amount), 4) AS amount_median FROM purchases GROUP BY customer_id",
    ),
    "purchase_intervals": (
        lambda spark, d: _behaviour(spark, d, INTERVALS),
        f"WITH {PURCHASES}, {_STEPS} SELECT customer_id, round(avg(gap), 4) AS avg_days_between, round(stddev_samp(gap), 4) AS std_days_between, "
        "CAST(min(gap) AS BIGINT) AS min_days_between, CAST(max(gap) AS BIGINT) AS max_days_between FROM steps GROUP BY customer_id",
    ),
    "purchase_habits": (
        lambda spark, d: _behaviour(spark, d, HABITS),
        f"WITH {PURCHASES}, {_MODES}, share AS (SELECT customer_id, avg(CASE WHEN isodow(date) >= 6 THEN 1.0 ELSE 0.0 END) AS s FROM purchases GROUP BY customer_id) "
        "SELECT customer_id, round(s, 4) AS weekend_purchase_ratio, CAST(h AS BIGINT) AS preferred_hour, CAST(w AS BIGINT) AS preferred_day FROM share "
        "JOIN (SELECT customer_id, h FROM hours WHERE k = 1) USING (customer_id) JOIN (SELECT customer_id, w FROM days WHERE k = 1) USING (customer_id)",
    ),
    "spending_trend": (
        lambda spark, d: _behaviour(spark, d, ["spending_trend"]),
        f"WITH {PURCHASES}, {_STEPS} SELECT customer_id, round(CASE WHEN count(*) < 2 THEN 0 ELSE regr_slope(amount, pos) END, 4) AS spending_trend FROM steps GROUP BY customer_id",
    ),
    "rfm_features": (
        q_rfm_features,
        f"{_RFM.replace('sum(amount)', 'round(sum(amount), 2)')}, {_FEATURES}, {_STEPS}, agg AS (SELECT customer_id, coalesce(stddev_samp(amount), 0) AS sd, median(amount) AS md, avg(gap) AS ag, "
        "CASE WHEN count(*) < 2 THEN 0 ELSE regr_slope(amount, pos) END AS tr FROM steps GROUP BY customer_id) "
        "SELECT customer_id, round(avg_order_value, 4) AS avg_order_value, round(monetary_per_day, 4) AS monetary_per_day, round(log_monetary, 4) AS log_monetary, "
        "round(log_frequency, 4) AS log_frequency, round(recency_inverse, 4) AS recency_inverse, round(sd / (avg_order_value + 1), 4) AS amount_cv, "
        "round(tr, 4) AS spending_trend, round(md, 4) AS amount_median, round(ag, 4) AS avg_days_between FROM feats JOIN agg USING (customer_id)",
    ),
    "outlier_customers": (
        q_outlier_customers,
        f"{_RFM}, q AS (SELECT quantile_cont(recency, [0.25, 0.75]) AS r, quantile_cont(monetary, [0.25, 0.75]) AS m FROM rfm) "
        "SELECT customer_id, recency, frequency, round(monetary, 2) AS monetary FROM rfm, q WHERE recency < r[1] - 1.5 * (r[2] - r[1]) OR recency > r[2] + 1.5 * (r[2] - r[1]) "
        "OR monetary < m[1] - 1.5 * (m[2] - m[1]) OR monetary > m[2] + 1.5 * (m[2] - m[1])",
    ),
    "outlier_customers_zscore": (
        q_outlier_customers_zscore,
        f"{_RFM}, s AS (SELECT avg(recency) AS ra, stddev_pop(recency) AS rs, avg(frequency) AS fa, stddev_pop(frequency) AS fs, avg(monetary) AS ma, stddev_pop(monetary) AS ms FROM rfm) "
        "SELECT customer_id, recency, frequency, round(monetary, 2) AS monetary FROM rfm, s WHERE abs(recency - ra) > 2 * rs OR abs(frequency - fa) > 2 * fs OR abs(monetary - ma) > 2 * ms",
    ),
    "feature_summary": (
        q_feature_summary,
        f"{_RFM}, {_FEATURES} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min, "
            f"round(CAST(max({c}) AS DOUBLE), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM feats"
            for c in ("recency", "frequency", "monetary", "avg_order_value", "log_monetary", "recency_inverse")
        ),
    ),
}
