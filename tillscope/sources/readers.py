"""Table readers for the supported file formats, and the input views of the jobs."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Date patterns tried on text columns, and the share that must parse.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd HH:mm:ss")
DATE_SHARE = 0.8

# The documented table layouts.
SALES = "date DATE, sales DOUBLE, quantity BIGINT"
PURCHASES = "transaction_id BIGINT, customer_id BIGINT, date TIMESTAMP, amount DOUBLE, category STRING, channel STRING"
TRANSACTIONS = "transaction_id BIGINT, customer_id BIGINT, timestamp TIMESTAMP, amount DOUBLE, merchant_id BIGINT, category STRING, is_fraud INT"


def normalise(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become UTC timestamps, NaN becomes null; nothing else changes."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            changed[f.name] = F.col(f.name).cast("timestamp")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            changed[f.name] = F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
    return df.withColumns(changed) if changed else df


def parse_dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Text to timestamp; what no pattern reads becomes null."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]) for c in columns if c in text})


def detect_dates(df: DataFrame, formats: Sequence[str] = DATE_FORMATS, share: float = DATE_SHARE) -> DataFrame:
    """Convert text columns of which more than ``share`` of all values parse with one of the patterns.

    All columns and patterns are judged on the whole table in one aggregate. What does not parse
    becomes null in the new column; the text stays beside it as ``<column>_text`` where that happens.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    counts = [F.count(df[c]).alias(f"n{k}") for k, c in enumerate(texts)]
    counts += [F.count(F.try_to_timestamp(df[c], F.lit(f))).alias(f"n{k}_{i}") for k, c in enumerate(texts) for i, f in enumerate(formats)]
    row = df.agg(*counts).first()
    changed = {}
    for k, c in enumerate(texts):
        best = next((i for i in range(len(formats)) if row[f"n{k}"] and row[f"n{k}_{i}"] / row[f"n{k}"] > share), None)
        if best is not None:
            changed[c] = F.try_to_timestamp(df[c], F.lit(formats[best]))
            if row[f"n{k}_{best}"] < row[f"n{k}"]:
                changed[f"{c}_text"] = df[c]
    return df.withColumns(changed) if changed else df


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, date_columns: Sequence[str] = (), parse: bool = True, **options) -> DataFrame:
    """CSV with header. Give a schema for large inputs: inference reads the files once more."""
    reader = spark.read.option("header", True).options(**options)
    df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
    df = parse_dates(df, date_columns)
    return normalise(detect_dates(df) if parse and schema is None else df)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.parquet(path))


def load_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, date_columns: Sequence[str] = ()) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return normalise(parse_dates(reader.json(path), date_columns))


def load(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Choose the reader by file suffix."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".csv":
        return load_csv(spark, path, schema, **options)
    if suffix == ".parquet":
        return load_parquet(spark, path)
    if suffix == ".json":
        return load_json(spark, path, schema, **options)
    raise ValueError(f"unsupported format: {suffix or path}")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Apply a {standard name: name in the file} mapping; other columns stay."""
    back = {source: target for target, source in mapping.items() if source in df.columns}
    return df.select(*[F.col(c).alias(back.get(c, c)) for c in df.columns])
