"""The three input shapes (transactions, purchases, sales) read from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillscope.operators import rfm as rfm_ops
from tillscope.session import materialize, tune
from tillscope.sources.readers import load_parquet


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_parquet(tune(spark), f"{folder.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("category"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),  # a label for metric checks
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").alias("transaction_id"),
    )


def sales_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("sales")
    )


def scored_customers(spark: SparkSession, folder: str) -> DataFrame:
    """RFM table with scores and segment, written once per call since many statistics read it."""
    base = materialize(rfm_ops.rfm(purchases(spark, folder)))
    return materialize(rfm_ops.rfm_segments(rfm_ops.rfm_scores(base)))


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Plain result types for comparison: doubles rounded, integers as BIGINT, booleans as 0/1."""
    out: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            scale = F.lit(10.0 ** special.get(f.name, digits))
            c = F.round(c.cast("double") * scale) / scale + F.lit(0.0)  # the same arithmetic as the comparison engine
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("int").cast("long") if isinstance(f.dataType, T.BooleanType) else c.cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)
