"""The batch operators on a stream: per-transaction features, a stored forest, daily totals.

Everything that refers to a whole batch (P95, decile edges, score range) comes from the stored
training figures, so the result of a row does not depend on the micro-batch it arrives in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillscope.functions.columns import clean_double
from tillscope.operators import forest, txn_features

# columns that need nothing but the transaction itself
ROW_FEATURES = ("amount_log", "is_round_amount", "is_large_amount", "amount_cents", "ends_in_99", "hour", "day_of_week", "is_weekend", "is_unusual_time", "hour_sin", "hour_cos")


def row_features(df: DataFrame, amounts: txn_features.AmountModel, c: txn_features.Columns = txn_features.Columns()) -> DataFrame:
    """Amount and calendar features; the same plan for a table and a stream."""
    return txn_features.time_features(txn_features.amount_features(df, amounts, c), c)


def score_transactions(stream: DataFrame, model: forest.Forest, amounts: txn_features.AmountModel, c: txn_features.Columns = txn_features.Columns()) -> DataFrame:
    """Score, flag, probability and risk level per arriving transaction."""
    return forest.flag(model.score(row_features(stream, amounts, c)), model)


def daily_totals(stream: DataFrame, date: str, values: Sequence[str], keys: Sequence[str] = (), lateness: str = "1 day") -> DataFrame:
    """Running daily roll-up; a day is final once the watermark has passed it."""
    timed = stream.withColumn(date, F.col(date).cast("timestamp")).withWatermark(date, lateness)
    sums = timed.groupBy(*keys, F.window(date, "1 day").alias("_w")).agg(*[F.sum(clean_double(v)).alias(v) for v in values])
    return sums.select(*keys, F.col("_w.start").alias("ds"), *values)


def append_to(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once per input row."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
