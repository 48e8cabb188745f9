"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# helper functions travel to the Python workers by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules["tillscope"])

# Runtime settings that every job relies on. They can be set on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a generated method above 8000 bytes is never compiled by the JVM: wide steps then run outside whole-stage code
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "tillscope", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tillscope-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a frame is read by several later jobs: the lineage is cut, a lost executor
    costs only a re-read, and later readers still get column pruning and file statistics.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    for owner in _OWNERS:
        owner.append(path)
    df.write.option("compression", "zstd").parquet(path)  # read a few times, and the disk is the scarcer good
    return spark.read.schema(df.schema).parquet(path)


_OWNERS: list[list[str]] = []


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside are deleted at the end; write results before that."""
    mine: list[str] = []
    _OWNERS.append(mine)
    try:
        yield
    finally:
        _OWNERS.remove(mine)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in mine:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def bucket_count(spark: SparkSession) -> int:
    """How many value ranges a distributed rank is split into; follows the shuffle width."""
    return min(20_000, max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
