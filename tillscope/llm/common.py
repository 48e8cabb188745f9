"""What the text operators share: reading tables, runtime settings, spread helpers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillscope.session import materialize, tune

__all__ = ["bitmap", "fan", "materialize", "prepare", "slices", "table", "text_bytes", "with_hit"]

# Arrow batches between the JVM and Python are cut by size as well as by rows, so that long texts stay bounded
BATCH_BYTES = "8m"


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(column: str) -> Column:
    """The UTF-8 bytes of a text column, null as empty; Python then needs no decoding of odd bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def fan(spark: SparkSession) -> int:
    """Width of a two-level combine: about the square root of the shuffle width."""
    return max(2, math.ceil(math.sqrt(int(spark.conf.get("spark.sql.shuffle.partitions")))))


CELL_BITS = 32_768


def bitmap(rows: DataFrame, hashed: str, bits: int) -> DataFrame:
    """The hashes of ``rows`` as a bitmap of ``bits`` bits, one row per cell: small enough to broadcast at any size."""
    bit = F.pmod(F.col(hashed), F.lit(bits))
    return rows.groupBy(F.floor(bit / CELL_BITS).alias("_cell")).agg(F.bitmap_construct_agg(F.pmod(bit, F.lit(CELL_BITS))).alias("_bits"))


def with_hit(rows: DataFrame, hashed: Column, cells: DataFrame, bits: int, name: str = "_hit") -> DataFrame:
    """Add whether the bitmap may hold the hash: never false for one that was put in."""
    bit = F.pmod(hashed, F.lit(bits))
    marked = rows.join(F.broadcast(cells), F.floor(bit / CELL_BITS) == F.col("_cell"), "left")
    place = F.pmod(bit, F.lit(CELL_BITS))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return marked.withColumn(name, F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False))).drop("_cell", "_bits")


def slices(batch: pa.RecordBatch, column: str, budget: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch in row runs of at most ``budget`` bytes in ``column`` (a longer single row stays alone)."""
    sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > budget:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < len(sizes):
        yield batch.slice(start)
