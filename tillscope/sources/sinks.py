"""Result sinks: rows as CSV, summaries as JSON, model tables as Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def plain_values(df: DataFrame) -> DataFrame:
    """NaN and infinity have no JSON form: they become null."""
    fixed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = F.col(f.name)
            fixed[f.name] = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
    return df.withColumns(fixed) if fixed else df


def write_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, written by all tasks; null fields are kept."""
    plain_values(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A frame of a few rows as JSON lines; null fields are kept."""
    plain_values(df).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def forecast_summary(forecast: DataFrame, info: DataFrame, metrics: DataFrame, series: str = "series_id", date: str = "ds") -> DataFrame:
    """Model description, metrics, horizon length and date span per series."""
    span = forecast.groupBy(series).agg(F.count(F.lit(1)).alias("forecast_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return span.join(info, series, "left").join(metrics, series, "left")


def segment_summary(profiles: DataFrame, metrics: DataFrame) -> DataFrame:
    """Segment profiles with the quality figures of the clustering beside them."""
    quality = metrics.withColumn("_one", F.lit(1))
    return profiles.withColumn("_one", F.lit(1)).join(F.broadcast(quality), "_one").drop("_one")  # one row of metrics


def fraud_summary(flagged: DataFrame, flag: str = "is_flagged", probability: str = "fraud_probability") -> DataFrame:
    f = F.col(flag).cast("long")
    return flagged.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(f).alias("flagged_transactions"),
        F.try_divide(F.sum(f).cast("double"), F.count(F.lit(1))).alias("flagged_share"),
        F.avg(probability).alias("mean_probability"),
        F.count_if(F.col("risk_level") == "Critical").alias("critical_transactions"),
    )


def kpi_summary(spark: SparkSession, **kpis: DataFrame) -> DataFrame:
    """One row with the key figures of several jobs; each input is a frame of one row."""
    frames = [df.select(*[F.col(c).alias(f"{name}_{c}") for c in df.columns], F.lit(1).alias("_one")) for name, df in kpis.items()]
    return reduce(lambda a, b: a.join(b, "_one", "full"), frames).drop("_one")


def save_model(tables: dict[str, DataFrame], path: str) -> None:
    """A fitted model is a set of small tables; each becomes a Parquet folder."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_model(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
