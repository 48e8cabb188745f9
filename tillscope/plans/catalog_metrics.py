"""Registered queries that judge detectors and forecasts, and shape series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillscope.operators import detector_metrics as dm, forecast_metrics as fm, ranking, series
from tillscope.functions.columns import micros
from tillscope.plans.sql_parts import TXN
from tillscope.plans.views import rounded, sales_rows, table, transactions

CUT = 150


def scored(spark, d):
    """Transactions with a label, the amount as score and a fixed rule as prediction."""
    return transactions(spark, d).select(
        "transaction_id", F.col("is_fraud").cast("long").alias("y"), F.col("amount").alias("score"), (F.col("amount") > CUT).cast("long").alias("pred"), "amount"
    )


def judged_documents(spark, d):
    """A second label with many tied scores: text length against a quality mark."""
    docs = table(spark, d, "documents").select("doc_id", F.floor(F.col("n_chars") / 100).cast("double").alias("score"))
    return docs.join(table(spark, d, "labels"), "doc_id").select("doc_id", F.col("quality").cast("long").alias("y"), "score")


def two_models(spark, d):
    s = scored(spark, d)
    a = s.select(F.lit("above_150").alias("model"), "y", "pred", "score")
    b = s.select(F.lit("below_5").alias("model"), F.when(F.col("y") == 1, -1).otherwise(1).alias("y"), F.when(F.col("score") < 5, -1).otherwise(1).alias("pred"), (-F.col("score")).alias("score"))
    return dm.binary(a, "y", "pred").unionByName(dm.binary(b, "y", "pred"))


def daily_series(spark, d):
    """Daily revenue per order priority, in whole cents."""
    out = series.roll_up(sales_rows(spark, d), "date", ["sales"], ["series_id"])
    return out.select("series_id", "ds", (F.round(F.col("sales") * 100) / 100).alias("actual"))


def week_ago(spark, d):
    """Forecast = the value seven rows before; the first week has none."""
    s = ranking.in_order(daily_series(spark, d).withColumn("_t", micros("ds")), "_t", "_t", ["series_id"])
    out = series.lagged(s, ["series_id"], "position", {"predicted": ("actual", 7)})
    return out.where(F.col("predicted").isNotNull()).select("series_id", "ds", "actual", "predicted")


def with_interval(spark, d):
    return week_ago(spark, d).withColumn("lower", F.col("predicted") * 0.5).withColumn("upper", F.col("predicted") * 1.5)


def named_models(spark, d):
    w = week_ago(spark, d)
    first = w.select(F.lit("week_ago").alias("model"), "series_id", "ds", "actual", "predicted")
    second = fm.naive_forecast(w.select("series_id", "ds", "actual"), ["series_id"]).select(F.lit("naive").alias("model"), "series_id", "ds", "actual", F.col("naive").alias("predicted"))
    return first.unionByName(second)


_CONF = ["true_positives", "false_positives", "false_negatives", "true_negatives", "precision", "recall", "f1", "accuracy", "specificity", "false_positive_rate", "false_negative_rate", "fraud_rate_actual", "fraud_rate_predicted", "total_samples", "total_frauds"]


def q_business(spark, d):
    return rounded(dm.business_metrics(scored(spark, d), investigation_cost=10.0, fraud_cost_ratio=1.5), 4)


def q_best_business(spark, d):
    return rounded(dm.best_business_threshold(scored(spark, d), investigation_cost=10.0, fraud_cost_ratio=1.0), 4)


def q_daily_sales(spark, d):
    orders = table(spark, d, "orders").join(
        table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("quantity")), "o_orderkey", "left"
    )
    return rounded(series.roll_up(orders.select("o_orderdate", F.col("o_totalprice").alias("sales"), "quantity"), "o_orderdate", ["sales", "quantity"], by_day=True), 2)


def q_dense(spark, d):
    return rounded(series.prepare(sales_rows(spark, d), "date", "sales", ["series_id"], freq="D"), 2)


def _filled(fill):
    def query(spark, d):
        daily = daily_series(spark, d).withColumnRenamed("actual", "sales")
        return rounded(series.densify(daily, "sales", "ds", ["series_id"], freq="D", fill=fill), 2)

    return query


def q_monthly(spark, d):
    return rounded(series.prepare(sales_rows(spark, d), "date", "sales", ["series_id"], freq="MS"), 2)


def q_lags(spark, d):
    return rounded(series.lag_features(daily_series(spark, d), "actual", [1, 7, 28], "ds", ["series_id"]), 2)


def q_rolling(spark, d):
    return rounded(series.rolling_features(daily_series(spark, d), "actual", [7, 30], "ds", keys=["series_id"]), 3)


def q_named_aggregate(name):
    return lambda spark, d: rounded(series.roll_up(sales_rows(spark, d), "date", ["sales"], ["series_id"], aggregate=name), 4)


def q_dm(spark, d):
    w = fm.naive_forecast(week_ago(spark, d), ["series_id"], output="pred2").withColumnRenamed("predicted", "pred1")
    return rounded(fm.diebold_mariano(w, ["series_id"], horizon=3), 5)


def q_residuals(spark, d):
    # the normal tail has no SQL form in the comparison engine: compare everything else
    out = fm.residual_diagnostics(week_ago(spark, d), ["series_id"]).drop("breusch_pagan_pvalue", "is_homoscedastic")
    return rounded(out, 5, mean=3, std=3)


_SCORED = f"""{TXN}, sc AS (SELECT transaction_id, CAST(is_fraud AS BIGINT) AS y, amount AS score, CAST(amount > {CUT} AS BIGINT) AS pred, amount FROM txn)"""
_JUDGED = "sc AS (SELECT doc_id, CAST(quality AS BIGINT) AS y, CAST(floor(n_chars / 100.0) AS DOUBLE) AS score FROM documents JOIN labels USING (doc_id))"
_COUNTS = """SELECT {g}count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,
  count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn FROM {s}"""
_RATIOS = {
    "true_positives": "CAST(tp AS BIGINT)",
    "false_positives": "CAST(fp AS BIGINT)",
    "false_negatives": "CAST(fn AS BIGINT)",
    "true_negatives": "CAST(tn AS BIGINT)",
    "precision": "round(coalesce(tp * 1.0 / nullif(tp + fp, 0), 0.0), 6)",
    "recall": "round(coalesce(tp * 1.0 / nullif(tp + fn, 0), 0.0), 6)",
    "f1": "round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6)",
    "accuracy": "round((tp + tn) * 1.0 / (tp + fp + fn + tn), 6)",
    "specificity": "round(coalesce(tn * 1.0 / nullif(tn + fp, 0), 0.0), 6)",
    "false_positive_rate": "round(coalesce(fp * 1.0 / nullif(tn + fp, 0), 0.0), 6)",
    "false_negative_rate": "round(coalesce(fn * 1.0 / nullif(fn + tp, 0), 0.0), 6)",
    "fraud_rate_actual": "round((tp + fn) * 1.0 / (tp + fp + fn + tn), 6)",
    "fraud_rate_predicted": "round((tp + fp) * 1.0 / (tp + fp + fn + tn), 6)",
    "total_samples": "CAST(tp + fp + fn + tn AS BIGINT)",
    "total_frauds": "CAST(tp + fn AS BIGINT)",
}


def _pick(parts, names=None):
    return ", ".join(f"{parts[n]} AS {n}" for n in (names or parts))


_TURN = "tu AS (SELECT * REPLACE (CASE WHEN (SELECT corr(score, y) FROM sc) < 0 THEN 0 - score ELSE score END AS score) FROM sc)"
# per distinct score, falling: rows and positives at or above
_CURVE = """cu AS (SELECT score AS threshold, sum(count(*)) OVER w AS flagged, sum(sum(y)) OVER w AS tp, sum(y) AS pos, count(*) - sum(y) AS neg,
  sum(count(*)) OVER () AS total, sum(sum(y)) OVER () AS positives FROM tu GROUP BY score WINDOW w AS (ORDER BY score DESC))"""
_AREA = """SELECT round((SELECT sum(r) FILTER (y = 1) FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM tu))
  / (p * n) - (p + 1) / 2.0 / n, 6) AS auc_roc, round((SELECT sum(pos * 1.0 / positives * tp / flagged) FROM cu), 6) AS avg_precision
  FROM (SELECT sum(y) * 1.0 AS p, count(*) - sum(y) * 1.0 AS n FROM sc)"""


def _roc(source: str) -> str:
    return (
        f"WITH {source}, {_TURN}, {_CURVE}, k AS (SELECT *, lag(pos) OVER w AS p0, lag(neg) OVER w AS n0, row_number() OVER w AS i, count(*) OVER () AS c FROM cu WINDOW w AS (ORDER BY threshold)) "
        "SELECT round(threshold, 6) AS threshold, round((flagged - tp) * 1.0 / (total - positives), 6) AS fpr, round(tp * 1.0 / positives, 6) AS tpr FROM k WHERE i = 1 OR i = c OR pos <> p0 OR neg <> n0 "
        "UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0"
    )


def _pr(source: str) -> str:
    return f"WITH {source}, {_TURN}, {_CURVE} SELECT round(threshold, 6) AS threshold, round(tp * 1.0 / flagged, 6) AS precision, round(tp * 1.0 / positives, 6) AS recall FROM cu UNION ALL SELECT NULL, 1.0, 0.0"


def _sweep(test: str, source: str = "sc") -> str:
    return f"""th AS (SELECT i AS step, CASE WHEN i = 99 THEN hi ELSE lo + i * ((hi - lo) / 99) END AS threshold FROM range(100) t(i), (SELECT min(score) AS lo, max(score) AS hi FROM {source})),
sw AS (SELECT step, threshold, count(*) FILTER (score {test} threshold) AS flagged, count(*) FILTER (score {test} threshold AND y = 1) AS tp, count(*) FILTER (y = 1) AS positives, count(*) AS n FROM th, {source} GROUP BY step, threshold)"""


_SWEEP_OUT = """SELECT CAST(step AS BIGINT) AS step, round(threshold, 6) AS threshold, round(coalesce(tp * 1.0 / nullif(flagged, 0), 0.0), 6) AS precision, round(coalesce(tp * 1.0 / nullif(positives, 0), 0.0), 6) AS recall,
  round(coalesce(2.0 * tp / nullif(flagged + positives, 0), 0.0), 6) AS f1, round(flagged * 1.0 / n, 6) AS flagged_rate FROM sw"""
_MONEY = """round(c, 4) AS caught_fraud_amount, round(m, 4) AS missed_fraud_amount, round(t, 4) AS total_fraud_amount, round(c / (t + 1e-10), 4) AS fraud_detection_rate, round(k * 10.0::DOUBLE, 4) AS investigation_costs,
  round(m * {r}, 4) AS fraud_loss, round(c * {r}, 4) AS prevented_loss, round(c * {r} - k * 10.0::DOUBLE, 4) + 0.0 AS net_savings, round((c * {r} - k * 10.0::DOUBLE) / (k * 10.0::DOUBLE + 1e-10), 4) + 0.0 AS roi"""

_DAILY = "dly AS (SELECT o_orderpriority AS series_id, o_orderdate AS ds, round(sum(o_totalprice), 2) AS actual FROM orders GROUP BY 1, 2)"
_WEEK = f"{_DAILY}, wk AS (SELECT * FROM (SELECT *, lag(actual, 7) OVER (PARTITION BY series_id ORDER BY ds) AS predicted FROM dly) WHERE predicted IS NOT NULL)"
_BASE = {
    "n": "CAST(count(*) AS BIGINT)",
    "mse": "avg((actual - predicted) ** 2)",
    "rmse": "sqrt(avg((actual - predicted) ** 2))",
    "mae": "avg(abs(actual - predicted))",
    "r2": "1 - sum((actual - predicted) ** 2) / (count(*) * var_pop(actual))",
    "mape": "avg(abs((actual - predicted) / actual)) FILTER (actual <> 0) * 100",
    "smape": "avg(2 * abs(actual - predicted) / (abs(actual) + abs(predicted))) * 100",
}
_MORE = {
    "mase": "avg(abs(actual - predicted)) / avg(abs(actual - a0))",
    "tracking_signal": "sum(actual - predicted) / avg(abs(actual - predicted))",
    "bias": "avg(predicted - actual)",
    "theils_u": "sqrt(avg((da - dp) ** 2)) / (sqrt(avg(da ** 2)) + sqrt(avg(dp ** 2)))",
    "coverage_10pct": "avg(CASE WHEN abs((actual - predicted) / actual) <= 0.1 THEN 1.0 ELSE 0.0 END) * 100",
}
_STEP = "st AS (SELECT *, actual / nullif(a0, 0) - 1 AS da, predicted / nullif(p0, 0) - 1 AS dp FROM (SELECT *, lag(actual) OVER w AS a0, lag(predicted) OVER w AS p0 FROM {s} WINDOW w AS (PARTITION BY {k} ORDER BY ds)))"
_DIGITS = {"mse": 0, "rmse": 3, "mae": 3, "bias": 3}


def _metrics(parts, digits=6):
    return ", ".join(v + f" AS {k}" if k == "n" else f"round({v}, {_DIGITS.get(k, digits)}) + 0.0 AS {k}" for k, v in parts.items())


_NAMED = f"{_WEEK}, nm AS (SELECT 'week_ago' AS model, series_id, ds, actual, predicted FROM wk UNION ALL SELECT 'naive', series_id, ds, actual, coalesce(lag(actual) OVER (PARTITION BY series_id ORDER BY ds), actual) FROM wk)"
_RESID_LAGS = ", ".join(f"sum(e * e{k}) AS s{k}" for k in range(1, 11))
_RESID = (
    f"{_WEEK}, r0 AS (SELECT series_id, ds, actual - predicted AS r FROM wk), r1 AS (SELECT *, r - avg(r) OVER (PARTITION BY series_id) AS e, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS t FROM r0), "
    "r2 AS (SELECT *, "
    + ", ".join(f"lag(e, {k}) OVER (PARTITION BY series_id ORDER BY ds) AS e{k}" for k in range(1, 11))
    + f" FROM r1), r3 AS (SELECT series_id, count(*) AS n, avg(r) AS m, stddev_pop(r) AS sd, avg(e ** 3) / power(avg(e ** 2), 1.5) AS sk, avg(e ** 4) / power(avg(e ** 2), 2) - 3 AS ku, sum(e * e) AS s0, power(corr(r * r, t), 2) AS r2, {_RESID_LAGS} FROM r2 GROUP BY series_id), "
    "r4 AS (SELECT *, n / 6.0 * (sk ** 2 + ku ** 2 / 4) AS jb, n * (n + 2) * (" + " + ".join(f"power(s{k} / s0, 2) / (n - {k})" for k in range(1, 11)) + ") AS lb FROM r3)"
)

QUERIES = {
    "confusion": (lambda s, d: rounded(dm.evaluate(scored(s, d))), f"WITH {_SCORED}, c AS ({_COUNTS.format(g='', s='sc')}) SELECT {_pick(_RATIOS)} FROM c"),
    "auc": (lambda s, d: rounded(dm.area_metrics(scored(s, d))), f"WITH {_SCORED}, {_TURN}, {_CURVE} {_AREA}"),
    "auc_tied_scores": (lambda s, d: rounded(dm.area_metrics(judged_documents(s, d))), f"WITH {_JUDGED}, {_TURN}, {_CURVE} {_AREA}"),
    "roc": (lambda s, d: rounded(dm.roc_points(scored(s, d))), _roc(_SCORED)),
    "roc_tied_scores": (lambda s, d: rounded(dm.roc_points(judged_documents(s, d))), _roc(_JUDGED)),
    "precision_recall": (lambda s, d: rounded(dm.precision_recall_points(scored(s, d))), _pr(_SCORED)),
    "precision_recall_tied_scores": (lambda s, d: rounded(dm.precision_recall_points(judged_documents(s, d))), _pr(_JUDGED)),
    "threshold_sweep": (lambda s, d: rounded(dm.threshold_metrics(scored(s, d))), f"WITH {_SCORED}, {_sweep('>')} {_SWEEP_OUT}"),
    "threshold_sweep_lower": (lambda s, d: rounded(dm.threshold_metrics(judged_documents(s, d), direction="lower")), f"WITH {_JUDGED}, {_sweep('<')} {_SWEEP_OUT}"),
    "best_threshold_f1": (lambda s, d: rounded(dm.best_threshold(scored(s, d), "f1")), f"WITH {_SCORED}, {_sweep('<')} {_SWEEP_OUT} ORDER BY coalesce(2.0 * tp / nullif(flagged + positives, 0), 0.0) DESC, step LIMIT 1"),
    "best_threshold_precision": (
        lambda s, d: rounded(dm.best_threshold(judged_documents(s, d), "precision", direction="higher")),
        f"WITH {_JUDGED}, {_sweep('>')} {_SWEEP_OUT} ORDER BY coalesce(tp * 1.0 / nullif(flagged, 0), 0.0) DESC, step LIMIT 1",
    ),
    "business": (
        q_business,
        f"WITH {_SCORED}, b AS (SELECT sum(amount) FILTER (y = 1 AND pred = 1) AS c, sum(amount) FILTER (y = 1 AND pred = 0) AS m, sum(amount) FILTER (y = 1) AS t, sum(pred) * 1.0 AS k FROM sc) SELECT {_MONEY.replace('{r}', '1.5')} FROM b",
    ),
    "best_business_threshold": (
        q_best_business,
        f"WITH {_SCORED}, {_sweep('>')}, b AS (SELECT step, threshold, coalesce(sum(amount) FILTER (score > threshold AND y = 1), 0) AS c, sum(amount) FILTER (y = 1) AS t, count(*) FILTER (score > threshold) * 1.0 AS k FROM th, sc GROUP BY step, threshold), "
        f"e AS (SELECT *, t - c AS m FROM b) SELECT CAST(step AS BIGINT) AS step, round(threshold, 4) AS threshold, {_MONEY.replace('{r}', '1.0')} FROM e ORDER BY c - k * 10.0::DOUBLE DESC, step LIMIT 1",
    ),
    "class_report": (
        lambda s, d: rounded(dm.class_report(scored(s, d))),
        f"WITH {_SCORED}, c AS ({_COUNTS.format(g='', s='sc')}), p AS (SELECT 'Normal' AS class, coalesce(tn * 1.0 / nullif(tn + fn, 0), 0) AS p, coalesce(tn * 1.0 / nullif(tn + fp, 0), 0) AS r, coalesce(2.0 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f, tn + fp AS s FROM c "
        "UNION ALL SELECT 'Fraud', coalesce(tp * 1.0 / nullif(tp + fp, 0), 0), coalesce(tp * 1.0 / nullif(tp + fn, 0), 0), coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM c), "
        "u AS (SELECT * FROM p UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM p UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM p) "
        "SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM u",
    ),
    "model_comparison": (
        lambda s, d: rounded(dm.compare_models(two_models(s, d))),
        f"WITH {_SCORED}, m AS (SELECT 'above_150' AS model, y, pred, score FROM sc UNION ALL SELECT 'below_5', y, CAST(score < 5 AS BIGINT), -score FROM sc), c AS ({_COUNTS.format(g='model, ', s='m')} GROUP BY model), "
        "tu AS (SELECT * REPLACE (CASE WHEN corr(score, y) OVER (PARTITION BY model) < 0 THEN 0 - score ELSE score END AS score) FROM m), "
        "rk AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM tu), "
        "au AS (SELECT model, (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS a FROM rk GROUP BY model) "
        f"SELECT model, {_pick(_RATIOS, ['precision', 'recall', 'f1', 'false_positive_rate'])}, round(a, 6) AS auc_roc FROM c JOIN au USING (model)",
    ),
    "daily_sales": (
        q_daily_sales,
        "SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ds, round(sum(o_totalprice), 2) AS sales, round(sum(q), 2) AS quantity FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY o_orderdate",
    ),
    "dense_series": (
        q_dense,
        f"WITH {_DAILY}, g AS (SELECT series_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS ds FROM (SELECT series_id, min(ds) AS a, max(ds) AS b FROM dly GROUP BY 1)) "
        "SELECT g.series_id, strftime(g.ds, '%Y-%m-%d %H:%M:%S') AS ds, coalesce(actual, 0) AS sales FROM g LEFT JOIN dly ON g.series_id = dly.series_id AND g.ds = dly.ds",
    ),
    "dense_series_interpolated": (
        _filled("interpolate"),
        f"WITH {_DAILY}, g AS (SELECT series_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS ds FROM (SELECT series_id, min(ds) AS a, max(ds) AS b FROM dly GROUP BY 1)), "
        "j AS (SELECT g.series_id, g.ds, actual, CASE WHEN actual IS NOT NULL THEN g.ds END AS kt FROM g LEFT JOIN dly ON g.series_id = dly.series_id AND g.ds = dly.ds), "
        "k AS (SELECT *, last_value(actual IGNORE NULLS) OVER p AS v0, last_value(kt IGNORE NULLS) OVER p AS t0, first_value(actual IGNORE NULLS) OVER n AS v1, first_value(kt IGNORE NULLS) OVER n AS t1 FROM j "
        "WINDOW p AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) "
        "SELECT series_id, strftime(ds, '%Y-%m-%d %H:%M:%S') AS ds, round(coalesce(actual, v0 + (v1 - v0) * ((epoch_us(ds) - epoch_us(t0)) / (epoch_us(t1) - epoch_us(t0)))), 2) AS sales FROM k",
    ),
    "dense_series_forward_filled": (
        _filled("ffill"),
        f"WITH {_DAILY}, g AS (SELECT series_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS ds FROM (SELECT series_id, min(ds) AS a, max(ds) AS b FROM dly GROUP BY 1)) "
        "SELECT g.series_id, strftime(g.ds, '%Y-%m-%d %H:%M:%S') AS ds, last_value(actual IGNORE NULLS) OVER (PARTITION BY g.series_id ORDER BY g.ds) AS sales FROM g LEFT JOIN dly ON g.series_id = dly.series_id AND g.ds = dly.ds",
    ),
    "monthly_series": (
        q_monthly,
        "SELECT o_orderpriority AS series_id, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') AS ds, round(sum(o_totalprice), 2) AS sales FROM orders GROUP BY 1, 2",
    ),
    "lags": (
        q_lags,
        f"WITH {_DAILY} SELECT series_id, strftime(ds, '%Y-%m-%d %H:%M:%S') AS ds, actual, lag(actual, 1) OVER w AS actual_lag_1, lag(actual, 7) OVER w AS actual_lag_7, lag(actual, 28) OVER w AS actual_lag_28 FROM dly WINDOW w AS (PARTITION BY series_id ORDER BY ds)",
    ),
    "rolling": (
        q_rolling,
        f"WITH {_DAILY} SELECT series_id, strftime(ds, '%Y-%m-%d %H:%M:%S') AS ds, actual, "
        + ", ".join(f"round({f}(actual) OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 3) AS actual_rolling_{w}_{n}" for w in (7, 30) for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")))
        + " FROM dly",
    ),
    **{
        f"roll_up_{n}": (q_named_aggregate(n), f"SELECT o_orderpriority AS series_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ds, round({f}(o_totalprice), 4) AS sales FROM orders GROUP BY 1, o_orderdate")
        for n, f in (("mean", "avg"), ("max", "max"), ("std", "stddev_samp"))
    },
    "forecast_metrics": (
        lambda s, d: rounded(fm.forecast_metrics(week_ago(s, d), ["series_id"]), 6, **_DIGITS),
        f"WITH {_WEEK}, {_STEP.format(s='wk', k='series_id')} SELECT series_id, {_metrics({**_BASE, **_MORE})} FROM st GROUP BY series_id",
    ),
    "interval_metrics": (
        lambda s, d: rounded(fm.interval_metrics(with_interval(s, d), ["series_id"]), 4),
        f"WITH {_WEEK}, iv AS (SELECT *, predicted * 0.5 AS lo, predicted * 1.5 AS hi FROM wk) SELECT series_id, round(avg(CASE WHEN actual BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END) * 100, 4) AS actual_coverage, 95.0::DOUBLE AS target_coverage, "
        "round((avg(CASE WHEN actual BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END) - 0.95) * 100, 4) + 0.0 AS coverage_gap, round(avg(hi - lo), 4) AS mean_interval_width, round(avg((hi - lo) / actual) * 100, 4) AS relative_width, "
        "round(avg(hi - lo + CASE WHEN actual < lo THEN 2 / (1 - 0.95::DOUBLE) * (lo - actual) WHEN actual > hi THEN 2 / (1 - 0.95::DOUBLE) * (actual - hi) ELSE 0 END), 4) AS winkler_score FROM iv GROUP BY series_id",
    ),
    "fva": (
        lambda s, d: rounded(fm.value_added(week_ago(s, d), ["series_id"]), 4),
        f"WITH {_WEEK}, nv AS (SELECT *, coalesce(lag(actual) OVER (PARTITION BY series_id ORDER BY ds), actual) AS naive FROM wk), a AS (SELECT series_id, avg(abs((actual - predicted) / actual)) * 100 AS mm, avg(abs((actual - naive) / actual)) * 100 AS nm, "
        "sqrt(avg((actual - predicted) ** 2)) AS mr, sqrt(avg((actual - naive) ** 2)) AS nr FROM nv GROUP BY 1) SELECT series_id, round(mm, 4) AS model_mape, round(nm, 4) AS naive_mape, round(nm - mm, 4) + 0.0 AS fva_mape, round((nm - mm) / nm * 100, 4) + 0.0 AS fva_mape_pct, "
        "round(mr, 4) AS model_rmse, round(nr, 4) AS naive_rmse, round(nr - mr, 4) + 0.0 AS fva_rmse, round((nr - mr) / nr * 100, 4) + 0.0 AS fva_rmse_pct FROM a",
    ),
    "forecast_comparison": (
        lambda s, d: rounded(fm.compare_models(named_models(s, d), "model", ["series_id"]).select("series_id", "model", "rmse", "mape", "mase", "mape_rank", "rmse_rank", "overall_rank"), 6, rmse=3),
        f"WITH {_NAMED}, {_STEP.format(s='nm', k='series_id, model')}, a AS (SELECT series_id, model, {_BASE['rmse']} AS rmse, {_BASE['mape']} AS mape, {_MORE['mase']} AS mase FROM st GROUP BY 1, 2), "
        "r AS (SELECT *, rank() OVER (PARTITION BY series_id ORDER BY mape) + (count(*) OVER (PARTITION BY series_id, mape) - 1) / 2.0 AS mr, rank() OVER (PARTITION BY series_id ORDER BY rmse) + (count(*) OVER (PARTITION BY series_id, rmse) - 1) / 2.0 AS rr FROM a) "
        "SELECT series_id, model, round(rmse, 3) AS rmse, round(mape, 6) AS mape, round(mase, 6) AS mase, CAST(mr AS DOUBLE) AS mape_rank, CAST(rr AS DOUBLE) AS rmse_rank, CAST((mr + rr) / 2 AS DOUBLE) AS overall_rank FROM r",
    ),
    "residuals": (
        q_residuals,
        f"WITH {_RESID} SELECT series_id, round(m, 3) + 0.0 AS mean, round(sd, 3) AS std, round(sk, 5) + 0.0 AS skewness, round(ku, 5) + 0.0 AS kurtosis, round(jb, 5) AS jarque_bera_stat, round(lb, 5) AS ljung_box_stat, round(n * r2, 5) AS breusch_pagan_stat, "
        "round(exp(-jb / 2), 5) AS jarque_bera_pvalue, round(exp(-lb / 2) * (1 + lb / 2 + power(lb / 2, 2) / 2 + power(lb / 2, 3) / 6 + power(lb / 2, 4) / 24), 5) AS ljung_box_pvalue, "
        "CAST(exp(-jb / 2) > 0.05 AS BIGINT) AS is_normal, "
        "CAST(exp(-lb / 2) * (1 + lb / 2 + power(lb / 2, 2) / 2 + power(lb / 2, 3) / 6 + power(lb / 2, 4) / 24) < 0.05 AS BIGINT) AS has_autocorrelation FROM r4",
    ),
    "diebold_mariano": (
        lambda s, d: q_dm(s, d).drop("p_value"),
        f"WITH {_WEEK}, l AS (SELECT series_id, ds, (actual - predicted) ** 2 - (actual - coalesce(lag(actual) OVER (PARTITION BY series_id ORDER BY ds), actual)) ** 2 AS d FROM wk), k AS (SELECT *, lag(d, 1) OVER w AS d1, lag(d, 2) OVER w AS d2 FROM l WINDOW w AS (PARTITION BY series_id ORDER BY ds)), "
        "s AS (SELECT series_id, avg(d) AS m, (var_pop(d) + 2 * (covar_samp(d, d1) + covar_samp(d, d2))) / count(*) AS v FROM k GROUP BY 1) "
        "SELECT series_id, round(m / sqrt(v), 5) + 0.0 AS dm_statistic, CAST(m < 0 AS BIGINT) AS model1_better FROM s",
    ),
    "evaluation_report": (
        lambda s, d: rounded(fm.evaluation_report(with_interval(s, d), ["series_id"], lower="lower", upper="upper"), 4),
        None,
    ),
}
