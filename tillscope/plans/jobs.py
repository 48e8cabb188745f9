"""The three jobs end to end, and the summary over all of them.

Each job returns its result frames; with ``output`` they are also written. Intermediate tables that
several later steps read are written once to the shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tillscope.functions.columns import require_columns
from tillscope.operators import arima, cleaning, clustering, decomposition, detector_metrics, forecast_metrics, forest, rfm, segments, series, txn_features
from tillscope.session import materialize
from tillscope.sources import sinks
from tillscope.sources.readers import rename

NOT_FEATURES = ("transaction_id", "customer_id", "timestamp", "is_fraud", "time_period", "risk_level")


def fraud_job(df: DataFrame, mapping: Mapping[str, str] | None = None, contamination: float = forest.CONTAMINATION, trees: int = forest.TREES, output: str | None = None) -> dict[str, DataFrame]:
    """Clean, features, forest, flags; metrics when the label column ``is_fraud`` is there."""
    data = rename(df, mapping) if mapping else df
    require_columns(data, ["transaction_id", "customer_id", "amount", "timestamp"])
    # cleaned rows are read by several statistics, the features by fitting and scoring
    cleaned = materialize(cleaning.clean(data))
    features = materialize(txn_features.transaction_features(cleaned))
    flagged, model = forest.detect(features, cleaning.numeric_features(features, NOT_FEATURES), "transaction_id", contamination=contamination, trees=trees)
    # flags are a projection of the scores that ``detect`` has written
    out = {"flagged": flagged.where("is_flagged"), "scored": flagged, "model_info": model.info(df.sparkSession), "advice": forest.advice(flagged), "summary": sinks.fraud_summary(flagged)}
    if "is_fraud" in flagged.columns:
        judged = flagged.select(F.col("is_fraud").alias("y"), F.col("is_flagged").cast("long").alias("pred"), F.col("anomaly_score").alias("score"))
        out["metrics"] = detector_metrics.evaluate(judged, score="score")
    if output:
        sinks.write_rows(out["flagged"], f"{output}/fraud/flagged")
        for name in ("summary", "model_info", "advice", "metrics"):
            if name in out:
                sinks.write_summary(out[name], f"{output}/fraud/{name}")
        sinks.save_model(model.tables(df.sparkSession), f"{output}/fraud/model")
    return out


def segmentation_job(df: DataFrame, k: int | None = None, mapping: Mapping[str, str] | None = None, restarts: int = clustering.RESTARTS, output: str | None = None) -> dict[str, DataFrame]:
    """Clean, RFM, scores, behaviour features, clusters, profiles, campaign texts."""
    data = rename(df, mapping) if mapping else df
    require_columns(data, ["customer_id", "date", "amount", "transaction_id"])
    spark = df.sparkSession
    cleaned = materialize(cleaning.clean(data))
    table = materialize(rfm.rfm(cleaned))
    scored = materialize(rfm.rfm_segments(rfm.rfm_scores(table)))
    features = materialize(rfm.rfm_features(scored, cleaned))
    model = clustering.fit(features, list(rfm.SCORED), k, restarts=restarts)
    assigned = materialize(model.assign(features))
    numeric = [c for c in cleaning.numeric_features(assigned, ("customer_id", "cluster"))]
    profiles = segments.profile_table(assigned, "cluster", numeric)
    out = {
        "customers": assigned,
        "profiles": profiles,
        "rfm_profiles": rfm.segment_profiles(scored),
        "metrics": clustering.quality(model, features),
        "selection": model.selection_table(spark),
        "centers": model.centers(spark),
        "names": segments.cluster_names(profiles),
        "campaigns": segments.campaign_texts(profiles),
    }
    if output:
        sinks.write_rows(assigned, f"{output}/segments/customers")
        sinks.write_summary(sinks.segment_summary(profiles, out["metrics"]), f"{output}/segments/summary")
        sinks.write_summary(out["campaigns"], f"{output}/segments/campaigns")
    return out


def forecast_job(
    df: DataFrame, model: str = "decomposition", horizon: int = 30, value: str = "sales", date: str = "date", key: str | None = None, spec: decomposition.Spec = decomposition.Spec(), output: str | None = None
) -> dict[str, DataFrame]:
    """Clean, daily series, fit, forecast, in-sample metrics. Without ``key`` all rows are one series."""
    require_columns(df, [date, value])
    name = key or "series_id"
    data = df if key else df.withColumn(name, F.lit("all"))
    # exact duplicates are not removed here: without a row id two equal sales are two sales
    cleaned = cleaning.clean(data.select(name, date, value), names=False, duplicates=False)
    dense = materialize(series.prepare(cleaned, date, value, [name], freq="D"))
    if model == "arima":
        fitted = materialize(arima.fit(dense, name, value=value, period=7))
        future = arima.forecast(dense, fitted, horizon, key=name, value=value)
        past = arima.in_sample(dense, fitted, name, value=value)
        info = arima.info(dense, fitted, name)
    elif model == "decomposition":
        fitted = materialize(decomposition.fit(dense, spec, name, value=value))
        future = decomposition.forecast(fitted, spec, horizon, key=name)
        past = decomposition.history(dense, fitted, spec, name, value=value).select(name, "ds", "actual", F.col("yhat").alias("predicted"))
        info = decomposition.diagnostics(fitted, spec, name)
    else:
        raise ValueError(f"unknown model: {model}")
    future = materialize(future)
    metrics = forecast_metrics.forecast_metrics(materialize(past), [name])
    out = {"forecast": future, "metrics": metrics, "model_info": info, "summary": sinks.forecast_summary(future, info, metrics, name), "model": fitted}
    if output:
        sinks.write_rows(future, f"{output}/forecast/rows")
        sinks.write_summary(out["summary"], f"{output}/forecast/summary")
        sinks.save_model({"model": fitted}, f"{output}/forecast/model")
    return out


def key_figures(fraud: Mapping[str, DataFrame], segmentation: Mapping[str, DataFrame], forecast: Mapping[str, DataFrame]) -> DataFrame:
    """One row over the three jobs: forecast error, segments, flagged rows and detector quality."""
    parts = {
        "forecast": forecast["metrics"].agg(F.avg("mape").alias("mape")),
        "segments": segmentation["profiles"].agg(F.count(F.lit(1)).alias("count")),
        "fraud": fraud["summary"].select("flagged_transactions", "flagged_share"),
    }
    if "metrics" in fraud:
        parts["detector"] = fraud["metrics"].select("auc_roc", "precision")
    return sinks.kpi_summary(fraud["summary"].sparkSession, **parts)


def run_all(transactions: DataFrame, purchases: DataFrame, sales: DataFrame, output: str | None = None, k: int | None = None, model: str = "decomposition") -> dict[str, Mapping[str, DataFrame] | DataFrame]:
    fraud = fraud_job(transactions, output=output)
    segmentation = segmentation_job(purchases, k, output=output)
    forecast = forecast_job(sales, model, output=output)
    figures = key_figures(fraud, segmentation, forecast)
    if output:
        sinks.write_summary(figures, f"{output}/summary")
    return {"fraud": fraud, "segmentation": segmentation, "forecast": forecast, "summary": figures}
