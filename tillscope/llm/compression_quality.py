"""Quality classifier by compression: zstandard dictionaries built from good and from bad labelled text.

A text that resembles the good examples compresses better with the good dictionary than with the bad
one. The feature is the normalised compressed-size difference

    d = (size with the bad dictionary - size with the good dictionary) / raw size in bytes  (0 for empty)

and a logistic (Platt) fit of the label on d turns it into a calibrated probability.

Learning. Labelled rows outside the held-out third (crc32 of the id as text, mod 3, not 1) are split by
another hash in a dictionary fold and a calibration fold, so that the calibration sees texts the
dictionaries never saw. Each class's dictionary is trained on a hash-chosen sample of whole texts of at
most ``sample_bytes`` bytes (a documented bound: the sample is chosen by a uniform hash threshold that
the class's total size sets, so it is spread over the whole table). The calibration uses at most
``calibration_rows`` rows of (d, label), two numbers each, chosen by hash order. The two dictionaries
(``dict_bytes`` each) and two coefficients are all that is broadcast; every document is then scored in
Arrow batches, whole texts, no cut.

Defined results: null text scores as empty (d = 0, score = the fitted intercept's probability); a null
doc_id is not held out and is never a training row; repeated rows get equal rows; an empty table gives an
empty result; a class without any training text gets an empty dictionary (plain compression). Only
doc_id and text of documents and doc_id and quality of labels are read, so clashing names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.llm.common import materialize, prepare, text_bytes

DICT_BYTES = 112_640
SAMPLE_BYTES = 8 << 20
CALIBRATION_ROWS = 50_000
LEVEL = 3
THRESHOLD = 0.5


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _unit(seed: str, id_col: str = "doc_id") -> Column:
    """A uniform number in [0, 1) from the id."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def build_dictionary(samples: list[bytes], dict_bytes: int = DICT_BYTES) -> bytes:
    """A trained zstandard dictionary; raw content when there are too few samples to train on; b'' when none."""
    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstd.train_dictionary(dict_bytes, samples).as_bytes()
    except zstd.ZstdError:
        joined = b"".join(samples)
        return joined[-dict_bytes:]


def _compressor(data: bytes) -> zstd.ZstdCompressor:
    if not data:
        return zstd.ZstdCompressor(level=LEVEL)
    return zstd.ZstdCompressor(level=LEVEL, dict_data=zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_AUTO))


def difference(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """d for each text (bytes; None as empty)."""
    cg, cb = _compressor(good), _compressor(bad)
    out = np.zeros(len(texts))
    for i, t in enumerate(texts):
        if t:
            out[i] = (len(cb.compress(t)) - len(cg.compress(t))) / len(t)
    return out


def _featured(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = difference(batch.column(batch.schema.get_field_index("_text")).to_pylist(), good, bad)
            yield batch.drop_columns(["_text"]).append_column("d", pa.array(d, pa.float64()))

    return run


def platt(d: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic fit of y on d with Platt's smoothed targets; (slope, intercept). No rows: (0, 0)."""
    if len(d) == 0:
        return 0.0, 0.0
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([d, np.ones_like(d)])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        grad = x.T @ (p - target)
        hess = x.T @ (x * (p * (1 - p))[:, None]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, dict_bytes: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES, calibration_rows: int = CALIBRATION_ROWS) -> tuple[bytes, bytes, float, float]:
    """(good dictionary, bad dictionary, slope, intercept) from the labelled rows outside the held-out third."""
    prepare(docs.sparkSession)
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_y"))
    # only ids, labels and sizes are joined and kept; texts are read again for the bounded samples alone
    narrow = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("_id"), F.length(text_bytes(text_col)).alias("_n")).join(marks, "_id")
    rows = materialize(narrow.withColumn("_u", _unit("fold", "_id")).withColumn("_fold", F.when(_unit("split", "_id") < 0.5, "dict").otherwise("calibration")))
    sizes = {r["_y"]: r["n"] for r in rows.where("_fold = 'dict'").groupBy("_y").agg(F.sum("_n").alias("n")).collect()}

    def texts_of(chosen: DataFrame) -> DataFrame:
        ids = chosen.select("_id", "_y").dropDuplicates(["_id"])
        return docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_text")).join(F.broadcast(ids), "_id")

    dictionaries = {}
    for y in (0, 1):
        share = min(1.0, sample_bytes / max(1, sizes.get(y) or 0))
        chosen = rows.where((F.col("_fold") == "dict") & (F.col("_y") == y) & (F.col("_u") < share))
        # the hash threshold makes the sample about sample_bytes; the running sum makes it a hard bound
        bounded = chosen.withColumn("_upto", F.sum("_n").over(Window.orderBy("_u", "_id").rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_upto") <= sample_bytes)
        dictionaries[y] = build_dictionary([r["_text"] for r in texts_of(bounded).select("_text").collect()], dict_bytes)
    good, bad = dictionaries[1], dictionaries[0]
    calibration = texts_of(rows.where("_fold = 'calibration'").orderBy("_u", "_id").limit(calibration_rows)).select("_y", "_text")
    fitted = calibration.mapInArrow(_featured(good, bad), "_y int, d double").collect()
    slope, intercept = platt(np.array([r["d"] for r in fitted], float), np.array([r["_y"] for r in fitted], float))
    return good, bad, slope, intercept


def compression_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", **bounds) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score in [0, 1] (label 1 likelier when higher), predicted (score >= 0.5), d.

    Null text counts as empty; a null id is never held out nor learnt from; repeated rows give equal rows;
    an empty table gives an empty result.
    """
    good, bad, slope, intercept = train(docs, labels, id_col, text_col, label_col, **bounds)
    featured = docs.select(F.col(id_col).cast("long").alias(id_col), held_out(id_col).alias("held_out"), text_bytes(text_col).alias("_text")).mapInArrow(
        _featured(good, bad), f"{id_col} long, held_out boolean, d double"
    )
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("d") + F.lit(intercept))))
    return featured.select(id_col, "held_out", score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), "d")
