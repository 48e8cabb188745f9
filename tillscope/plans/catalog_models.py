"""Registered queries for fitted models, detector rules, files and whole jobs.

Fitted models have no SQL counterpart and are checked by row counts here and by planted cases in
the tests; the rules around them (votes, probabilities, risk levels, summaries) have SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillscope.functions.columns import finite_or_zero
from tillscope.operators import arima, cleaning, clustering, decomposition, detectors, forest, neighbours, rfm, segments, series, txn_features
from tillscope.plans import jobs
from tillscope.plans.sql_parts import SEGS, TXN
from tillscope.plans.views import purchases, rounded, sales_rows, scored_customers, table, transactions
from tillscope.session import materialize, shared_dir
from tillscope.sources import readers, sinks

FEATURES = list(rfm.SCORED)
CLUSTERS = 4


def _rfm(spark, d):
    return materialize(rfm.rfm(purchases(spark, d)))


def q_kmeans_profile(spark, d):
    base = _rfm(spark, d)
    assigned = materialize(clustering.fit(base, FEATURES, CLUSTERS, restarts=3).assign(base))
    return rounded(segments.profile_table(assigned, "cluster", FEATURES), 4)


def q_kmeans_selection(spark, d):
    return rounded(clustering.fit(_rfm(spark, d), FEATURES, restarts=3).selection_table(spark), 4)


def q_kmeans_centers(spark, d):
    return rounded(clustering.fit(_rfm(spark, d), FEATURES, CLUSTERS, restarts=3).centers(spark), 4)


def q_kmeans_quality(spark, d):
    base = _rfm(spark, d)
    return rounded(clustering.quality(clustering.fit(base, FEATURES, CLUSTERS, restarts=3), base), 4)


def q_projection(spark, d):
    base = _rfm(spark, d)
    model = clustering.fit(base, FEATURES, CLUSTERS, restarts=1)
    return rounded(clustering.project(model, base).select("customer_id", "PC1", "PC2", "cluster"), 4)


def q_embedding_clusters(spark, d):
    """Clusters of the embedding table: as many columns as the vectors have places."""
    e = table(spark, d, "embeddings")
    width = len(e.first()["embedding"])
    wide = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(width)])
    model = clustering.fit(wide, [f"e{i}" for i in range(width)], 10, restarts=2)
    return model.assign(wide).groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("rows"))


def q_cluster_spread(spark, d):
    return rounded(clustering.spread_metrics(scored_customers(spark, d), "segment", ["recency", "frequency"]), 5)


def _txn_inputs(spark, d):
    df = transactions(spark, d)
    out = txn_features.with_history(df, txn_features.fit_amounts(df))
    return materialize(txn_features.time_features(out))


INPUTS = ["amount", "hour", "hours_since_last", "amount_change", "txn_count_24h", "amount_mean_168h", "amount_deviation"]


def q_forest_flags(spark, d):
    flagged, _ = forest.detect(_txn_inputs(spark, d), INPUTS, "transaction_id")
    return rounded(flagged.select("transaction_id", "anomaly_score", "is_flagged", "fraud_probability", "risk_level"))


def q_forest_importance(spark, d):
    df = _txn_inputs(spark, d)
    return rounded(forest.importance(forest.fit(df, INPUTS, "transaction_id", trees=30), df, "transaction_id"))


def q_forest_info(spark, d):
    _, model = forest.detect(_txn_inputs(spark, d), INPUTS, "transaction_id", trees=30)
    return rounded(model.info(spark))


def q_ensemble(spark, d):
    df = _txn_inputs(spark, d).select("transaction_id", *INPUTS)  # no step reads the other features: the rows that are joined stay narrow
    e = detectors.fit_ensemble(df, INPUTS, "transaction_id", ("isolation_forest", "lof", "ocsvm"))
    return rounded(detectors.vote(e.decisions(df), list(e.models), e.ranges).select("transaction_id", "prediction", "confidence"))


def q_lof_scores(spark, d):
    """Exact local outlier factor of every transaction against all others, on the scaled inputs."""
    df = _txn_inputs(spark, d)
    scaler = cleaning.fit_scaler(df, INPUTS, "standard", nulls_as_zero=True)
    names = [f"s_{c}" for c in INPUTS]
    scaled = df.select("transaction_id", *[((finite_or_zero(c) - F.lit(scaler.center[c])) / F.lit(scaler.scale[c])).alias(n) for c, n in zip(INPUTS, names)])
    return rounded(neighbours.local_outlier_factor(scaled, "transaction_id", names, detectors.NEIGHBOURS))


def _decisions(spark, d):
    """Three simple rules as decision columns, so that the vote itself can be compared."""
    t = transactions(spark, d)
    return t.select(
        "transaction_id", (F.lit(150.0) - F.col("amount")).alias("_d_high"), (F.hour("timestamp") - 4.5).alias("_d_night"), (F.col("amount") - 1.0).alias("_d_tiny")
    )


def _vote(voting):
    return lambda spark, d: rounded(detectors.vote(_decisions(spark, d), ["high", "night", "tiny"], voting=voting).select("transaction_id", "prediction", "confidence"))


def _ruled(spark, d):
    """Transactions flagged by amount: minus the amount as score, batch probability, risk level."""
    t = transactions(spark, d).withColumn("anomaly_score", -F.col("amount"))
    low, high = t.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    out = t.withColumn("is_flagged", forest.predict("anomaly_score", -200.0) == -1).withColumn("fraud_probability", forest.probability("anomaly_score", low, high))
    return out.withColumn("risk_level", forest.risk_level("fraud_probability"))


def q_risk(spark, d):
    return rounded(_ruled(spark, d).select("transaction_id", "is_flagged", "fraud_probability", "risk_level"))


def q_top_flagged(spark, d):
    return rounded(forest.top_flagged(_ruled(spark, d), "transaction_id", 100).select("transaction_id", "amount", "risk_level"))


def _daily(spark, d):
    return materialize(series.prepare(sales_rows(spark, d), "date", "sales", ["series_id"], freq="D"))


def q_trend_season(spark, d):
    spec = decomposition.Spec(mode="additive")
    return rounded(decomposition.forecast(decomposition.fit(_daily(spark, d), spec, value="sales"), spec, 30), 2)


def q_components(spark, d):
    spec = decomposition.Spec(mode="additive")
    daily = _daily(spark, d)
    return rounded(decomposition.history(daily, decomposition.fit(daily, spec, value="sales"), spec, value="sales"), 2)


def q_changepoints(spark, d):
    return rounded(decomposition.changepoints(decomposition.fit(_daily(spark, d), value="sales")), 4)


def q_decomposition_backtest(spark, d):
    out = decomposition.backtest(_daily(spark, d), decomposition.Spec(mode="additive"), value="sales")
    return rounded(decomposition.backtest_metrics(out), 4)


def q_arima(spark, d):
    daily = _daily(spark, d)
    return rounded(arima.forecast(daily, materialize(arima.fit(daily, value="sales", period=7)), 30, value="sales"), 2)


def q_arima_orders(spark, d):
    daily = _daily(spark, d)
    return rounded(arima.diagnostics(daily, materialize(arima.fit(daily, value="sales")), value="sales"), 4)


def q_arima_backtest(spark, d):
    daily = _daily(spark, d)
    model = materialize(arima.fit(daily, value="sales", auto_order=False))
    return rounded(arima.backtest_metrics(arima.backtest(daily, model, value="sales")), 4)


def _files(writer, suffix, schema):
    def query(spark, d):
        df = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_totalprice", "o_orderpriority")
        path = f"{shared_dir(spark).rstrip('/')}/files/{uuid.uuid4().hex}.{suffix}"
        writer(df, path)
        back = readers.load(spark, path, schema, date_columns=["o_orderdate"])
        return rounded(back.withColumn("o_orderdate", F.to_date("o_orderdate")), 2)

    return query


def q_detected_dates(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("ordered"), "o_orderpriority")
    return rounded(readers.detect_dates(df).withColumn("ordered", F.to_date("ordered")))


def q_fraud_job(spark, d):
    scored = jobs.fraud_job(transactions(spark, d))["scored"]
    return rounded(scored.select("transaction_id", "anomaly_score", "is_flagged", "fraud_probability", "risk_level"))


def q_segmentation_job(spark, d):
    return rounded(jobs.segmentation_job(purchases(spark, d), CLUSTERS, restarts=3)["campaigns"])


def q_forecast_job(spark, d):
    return rounded(jobs.forecast_job(sales_rows(spark, d), key="series_id")["summary"], 4)


def q_key_figures(spark, d):
    fraud = jobs.fraud_job(transactions(spark, d), trees=30)
    return rounded(jobs.key_figures(fraud, jobs.segmentation_job(purchases(spark, d), CLUSTERS, restarts=1), jobs.forecast_job(sales_rows(spark, d))), 4)


_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate STRING, o_totalprice DOUBLE, o_orderpriority STRING"
_FILE_SQL = "SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, round(o_totalprice, 2) AS o_totalprice, o_orderpriority FROM orders"
_RULED = f"""{TXN}, b AS (SELECT min(-amount) AS lo, max(-amount) AS hi FROM txn), pr AS (SELECT *, 1 - (-amount - lo) / (hi - lo) AS p, -amount < -200 AS fl FROM txn, b),
ru AS (SELECT *, CASE WHEN p > 0 AND p <= 0.3 THEN 'Low' WHEN p > 0.3 AND p <= 0.6 THEN 'Medium' WHEN p > 0.6 AND p <= 0.8 THEN 'High' WHEN p > 0.8 AND p <= 1 THEN 'Critical' END AS risk FROM pr)"""
_DEC = f"{TXN}, de AS (SELECT transaction_id, 150.0::DOUBLE - amount AS a, hour(\"timestamp\") - 4.5::DOUBLE AS b, amount - 1.0::DOUBLE AS c FROM txn)"
_SOFT = " + ".join(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-10)" for c in "abc")

QUERIES = {
    "kmeans_profile": (q_kmeans_profile, None),
    "kmeans_selection": (q_kmeans_selection, None),
    "kmeans_centers": (q_kmeans_centers, None),
    "kmeans_quality": (q_kmeans_quality, None),
    "projection": (q_projection, None),
    "embedding_clusters": (q_embedding_clusters, None),
    "cluster_spread": (
        q_cluster_spread,
        f"WITH {SEGS}, m AS (SELECT segment, count(*) AS n, avg(recency) AS r, avg(frequency) AS f FROM segs GROUP BY 1), w AS (SELECT segment, sum((recency - r) ** 2 + (frequency - f) ** 2) AS ss, avg(sqrt((recency - r) ** 2 + (frequency - f) ** 2)) AS dist FROM segs JOIN m USING (segment) GROUP BY 1), "
        "g AS (SELECT sum(n * r) / sum(n) AS gr, sum(n * f) / sum(n) AS gf, sum(n) AS total, count(*) AS k FROM m), ch AS (SELECT sum(n * ((r - gr) ** 2 + (f - gf) ** 2)) * (max(total) - max(k)) / ((SELECT sum(ss) FROM w) * (max(k) - 1)) AS ch, max(k) AS k FROM m, g), "
        "j AS (SELECT * FROM m JOIN w USING (segment)), db AS (SELECT avg(x) AS db FROM (SELECT a.segment, max((a.dist + b.dist) / sqrt((a.r - b.r) ** 2 + (a.f - b.f) ** 2)) AS x FROM j a JOIN j b ON a.segment <> b.segment GROUP BY 1)) "
        "SELECT CAST(k AS BIGINT) AS n_clusters, round(ch, 5) AS calinski_harabasz, round(db, 5) AS davies_bouldin FROM ch, db",
    ),
    "forest_flags": (q_forest_flags, None),
    "forest_importance": (q_forest_importance, None),
    "forest_info": (q_forest_info, None),
    "ensemble": (q_ensemble, None),
    # exact neighbours; tests/test_neighbours.py compares with numpy brute force
    "lof_scores": (q_lof_scores, None),
    "ensemble_vote_hard": (
        _vote("hard"),
        f"WITH {_DEC}, v AS (SELECT transaction_id, CASE WHEN a < 0 THEN -1 ELSE 1 END + CASE WHEN b < 0 THEN -1 ELSE 1 END + CASE WHEN c < 0 THEN -1 ELSE 1 END AS v FROM de) "
        "SELECT transaction_id, CAST(CASE WHEN v > 0 THEN 1 ELSE -1 END AS BIGINT) AS prediction, round(abs(v) / 3.0::DOUBLE, 6) AS confidence FROM v",
    ),
    "ensemble_vote_soft": (
        _vote("soft"),
        f"WITH {_DEC}, v AS (SELECT transaction_id, ({_SOFT}) / 3 AS v FROM de) SELECT transaction_id, CAST(CASE WHEN v < 0.5 THEN -1 ELSE 1 END AS BIGINT) AS prediction, round(abs(v - 0.5::DOUBLE) * 2, 6) AS confidence FROM v",
    ),
    "risk_levels": (q_risk, f"WITH {_RULED} SELECT transaction_id, CAST(fl AS BIGINT) AS is_flagged, round(p, 6) AS fraud_probability, risk AS risk_level FROM ru"),
    "top_flagged": (q_top_flagged, f"WITH {_RULED} SELECT transaction_id, round(amount, 6) AS amount, risk AS risk_level FROM ru WHERE fl ORDER BY -amount, transaction_id LIMIT 100"),
    "fraud_advice": (
        lambda s, d: rounded(forest.advice(_ruled(s, d))),
        f"WITH {_RULED}, a AS (SELECT count(*) AS n, sum(CAST(fl AS INT)) * 100.0 / count(*) AS rate, stddev_samp(-amount) AS sd, count(*) FILTER (risk = 'Critical') AS cr FROM ru), "
        "l AS (SELECT list_filter([CASE WHEN rate > 5 THEN printf('flag_rate_high: %.1f%% of rows flagged', rate) WHEN rate < 0.1 THEN printf('flag_rate_low: %.2f%% of rows flagged', rate) END, "
        "CASE WHEN sd < 0.1 THEN 'scores_close: spread below 0.1' END, CASE WHEN cr > n * 0.01 THEN printf('review_critical: %d rows', cr) END, "
        "'score_on_arrival', 'alert_on_critical', 'refit_on_new_labels', 'compare_with_ensemble'], lambda x: x IS NOT NULL) AS l FROM a) "
        "SELECT CAST(i AS BIGINT) AS place, l[i + 1] AS line FROM l, range(10) t(i) WHERE i < len(l)",
    ),
    "fraud_summary": (
        lambda s, d: rounded(sinks.fraud_summary(_ruled(s, d))),
        f"WITH {_RULED} SELECT CAST(count(*) AS BIGINT) AS total_transactions, CAST(sum(CAST(fl AS INT)) AS BIGINT) AS flagged_transactions, round(sum(CAST(fl AS INT)) * 1.0 / count(*), 6) AS flagged_share, round(avg(p), 6) AS mean_probability, "
        "CAST(count(*) FILTER (risk = 'Critical') AS BIGINT) AS critical_transactions FROM ru",
    ),
    "forecast_trend_season": (q_trend_season, None),
    "forecast_components": (q_components, None),
    "trend_changepoints": (q_changepoints, None),
    "decomposition_backtest": (q_decomposition_backtest, None),
    "forecast_arima": (q_arima, None),
    "arima_orders": (q_arima_orders, None),
    "arima_backtest": (q_arima_backtest, None),
    "csv_round_trip": (_files(sinks.write_rows, "csv", _SCHEMA), _FILE_SQL),
    "json_round_trip": (_files(sinks.write_json, "json", _SCHEMA), _FILE_SQL),
    "detected_dates": (q_detected_dates, "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered, o_orderpriority FROM orders"),
    "fraud_job": (q_fraud_job, None),
    "segmentation_job": (q_segmentation_job, None),
    "forecast_job": (q_forecast_job, None),
    "key_figures": (q_key_figures, None),
}
