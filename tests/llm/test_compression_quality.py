"""Compression quality classifier: features against a direct computation, calibration, held-out accuracy, odd rows."""

import numpy as np
import zstandard as zstd
from pyspark.sql import functions as F

from tillscope.llm import compression_quality as C

SF = "/root/testdata/sf0.01"


def test_difference_by_hand():
    good = C.build_dictionary([b"the quick brown fox jumps over the lazy dog " * 20 + bytes([i]) for i in range(40)], 4096)
    bad = C.build_dictionary([b"zq xv kj !! ## $$ %% buy now cheap pills " * 20 + bytes([i]) for i in range(40)], 4096)
    text = b"the lazy dog sleeps while the quick brown fox jumps"
    cg = zstd.ZstdCompressor(level=C.LEVEL, dict_data=zstd.ZstdCompressionDict(good)).compress(text)
    cb = zstd.ZstdCompressor(level=C.LEVEL, dict_data=zstd.ZstdCompressionDict(bad)).compress(text)
    assert C.difference([text, b"", None], good, bad).tolist() == [(len(cb) - len(cg)) / len(text), 0.0, 0.0]
    assert C.difference([text], good, bad)[0] > 0


def test_platt_recovers_a_logistic():
    rng = np.random.default_rng(1)
    d = rng.normal(size=20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(3 * d - 1)))).astype(float)
    slope, intercept = C.platt(d, y)
    assert abs(slope - 3) < 0.2 and abs(intercept + 1) < 0.1
    assert C.platt(np.array([]), np.array([])) == (0.0, 0.0)


def test_held_out_accuracy_and_contract(shared):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    labels = shared.read.parquet(f"{SF}/labels.parquet")
    got = C.compression_quality(docs, labels)
    assert got.count() == docs.count()
    assert got.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    want_held = docs.select("doc_id", (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1).alias("w"))
    assert got.join(want_held, "doc_id").where(F.col("w") != F.col("held_out")).count() == 0
    judged = got.where("held_out").join(labels, "doc_id").select("quality", "predicted").collect()
    accuracy = sum(r.quality == r.predicted for r in judged) / len(judged)
    base = max(sum(r.quality for r in judged), sum(1 - r.quality for r in judged)) / len(judged)
    assert accuracy >= base


def test_odd_rows(odd, shared):
    frame, rows = odd
    labels = shared.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(rows) if r[0] is not None], "doc_id long, quality int, toxic int")
    got = C.compression_quality(frame, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    empty = [r.score for r in got if r.d == 0.0]
    assert len(set(round(s, 12) for s in empty)) == 1
    assert C.compression_quality(frame.limit(0), labels.limit(0)).count() == 0
