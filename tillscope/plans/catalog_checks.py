"""Queries over fitted models whose results a closed form or a rule gives, with that rule as SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillscope.operators import arima, forest
from tillscope.plans.sql_parts import TXN
from tillscope.plans.views import rounded, table, transactions
from tillscope.session import materialize, shared_dir
from tillscope.sources import readers, sinks

_MONTHS = "m AS (SELECT l_suppkey, date_trunc('month', l_shipdate) AS ds, sum(l_extendedprice) AS y FROM lineitem GROUP BY 1, 2)"


def _monthly(spark, d):
    """Revenue by supplier and month: as many series as there are suppliers."""
    months = F.date_trunc("month", "l_shipdate").alias("ds")
    return materialize(table(spark, d, "lineitem").groupBy("l_suppkey", months).agg(F.sum("l_extendedprice").alias("y")))


def q_arima_first_order(spark, d):
    model = arima.fit(_monthly(spark, d), "l_suppkey", order=(1, 0, 0))
    return rounded(model.select("l_suppkey", F.round("const", 1).alias("const"), F.element_at("ar", 1).alias("slope"), "n", "status"), 4)


def q_arima_drift(spark, d):
    model = arima.fit(_monthly(spark, d), "l_suppkey", order=(0, 1, 0))
    return rounded(model.select("l_suppkey", "const", F.sqrt("sigma2").alias("spread"), "n"), 4)


def q_forecast_shape(spark, d):
    monthly = _monthly(spark, d)
    ahead = arima.forecast(monthly, arima.fit(monthly, "l_suppkey", order=(1, 0, 1)), 6, key="l_suppkey", step="1 month")
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return rounded(ahead.groupBy("l_suppkey").agg(F.count("yhat").alias("n"), F.min("ds").alias("first"), F.max("ds").alias("last"), F.min(ordered.cast("int")).alias("ordered")))


def _scored(spark, d):
    df = transactions(spark, d).select("transaction_id", "amount", F.hour("timestamp").cast("double").alias("hour"))
    return materialize(df), ["amount", "hour"]


def q_forest_rules(spark, d):
    """What must hold for any forest: how many rows are flagged, the range of the probability, the risk levels."""
    df, inputs = _scored(spark, d)
    flagged = materialize(forest.detect(df, inputs, "transaction_id", trees=30)[0])
    p, score = F.col("fraud_probability"), F.col("anomaly_score")
    low, high = flagged.agg(F.min(score), F.max(score)).first()
    level = F.when(p <= 0, F.lit(None)).when(p <= 0.3, "Low").when(p <= 0.6, "Medium").when(p <= 0.8, "High").otherwise("Critical")
    return rounded(
        flagged.agg(
            F.count(F.lit(1)).alias("n"),
            (F.count_if("is_flagged") <= F.floor((F.count(F.lit(1)) - 1) * 0.01) + 1).cast("int").alias("flagged_bounded"),
            F.count_if(F.col("is_flagged") != (score < 0)).alias("flag_differs"),
            F.min(p).alias("least"),
            F.max(p).alias("most"),
            F.count_if(F.abs(p - (1 - (score - low) / (high - low))) > 1e-9).alias("probability_differs"),
            F.count_if(~F.col("risk_level").eqNullSafe(level)).alias("level_differs"),
        )
    )


def q_stored_forest(spark, d):
    """A forest written, read back and used again scores every row as the fresh one does."""
    df, inputs = _scored(spark, d)
    fresh = forest.fit(df, inputs, "transaction_id", trees=20)
    path = f"{shared_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}"
    tables = fresh.tables(spark)
    sinks.save_model(tables, path)
    stored = forest.Forest.from_tables(sinks.load_model(spark, path, list(tables)))
    both = stored.score(fresh.score(df, output="a"), output="b")
    return rounded(both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("a") - F.col("b")) > 1e-12).alias("differs")))


def q_not_a_number(spark, d):
    """NaN and infinity become null on the way to JSON."""
    odd = F.when(F.col("event_id") % 7 == 0, float("nan")).when(F.col("event_id") % 7 == 1, float("inf")).otherwise(F.col("value"))
    path = f"{shared_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}.json"
    sinks.write_json(table(spark, d, "events").select("event_id", odd.alias("value")), path)
    return rounded(readers.load(spark, path, "event_id BIGINT, value DOUBLE"))


QUERIES = {
    "arima_first_order": (
        q_arima_first_order,
        f"WITH {_MONTHS}, p AS (SELECT l_suppkey, y, lag(y) OVER (PARTITION BY l_suppkey ORDER BY ds) AS x FROM m) "
        "SELECT l_suppkey, round(regr_intercept(y, x), 1) AS const, round(regr_slope(y, x), 4) AS slope, count(x) AS n, 'fitted' AS status FROM p GROUP BY l_suppkey",
    ),
    "arima_drift": (
        q_arima_drift,
        f"WITH {_MONTHS}, p AS (SELECT l_suppkey, y - lag(y) OVER (PARTITION BY l_suppkey ORDER BY ds) AS step FROM m) "
        "SELECT l_suppkey, round(avg(step), 4) AS const, round(stddev_pop(step), 4) AS spread, count(step) AS n FROM p GROUP BY l_suppkey",
    ),
    "forecast_shape": (
        q_forecast_shape,
        f"WITH {_MONTHS} SELECT l_suppkey, 6::BIGINT AS n, strftime(max(ds) + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS first, strftime(max(ds) + INTERVAL 6 MONTH, '%Y-%m-%d %H:%M:%S') AS last, "
        "1::BIGINT AS ordered FROM m GROUP BY l_suppkey",
    ),
    "forest_rules": (
        q_forest_rules,
        f"WITH {TXN} SELECT count(*) AS n, 1::BIGINT AS flagged_bounded, 0::BIGINT AS flag_differs, 0.0::DOUBLE AS least, 1.0::DOUBLE AS most, 0::BIGINT AS probability_differs, 0::BIGINT AS level_differs FROM txn",
    ),
    "stored_forest": (q_stored_forest, "SELECT count(*) AS n, 0::BIGINT AS differs FROM events"),
    "not_a_number": (q_not_a_number, "SELECT event_id, CASE WHEN event_id % 7 > 1 THEN round(value, 6) END AS value FROM events"),
}
