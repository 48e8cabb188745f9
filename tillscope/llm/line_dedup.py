"""Substring dedup by hashing lines, and sentences within lines.

Units are normalised (A-Z in lower case, white space to one space) and hashed to 128 bits. Of all units
of one kind with the same digest the earliest by (document, offset) stays, the others are removed from
the original bytes. Digests that occur once never meet their text again: those that occur more often
go into a bitmap of fixed size, and only units that it may hold are joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillscope.llm.common import bitmap, materialize, prepare, slices, text_bytes, with_hit

LINE, SENTENCE = 0, 1
# shorter sentences are alike by chance; one of either length counts, since not all scripts part words by spaces
LEAST_WORDS = 8
LEAST_BYTES = 48
BITS = 1 << 26
_ENDS = re.compile(b"(?:[.!?]|" + b"|".join(mark.encode() for mark in "。．！？｡؟۔।॥…") + rb")+\s*")
_UNITS = "_doc long, _tag long, kind int, begin long, end long, h1 long, h2 long"


def units(text: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """(kind, begin, end, normalised bytes). A line's span holds its line break, a sentence's the space after it."""
    begin = 0
    while begin < len(text):
        end = text.find(b"\n", begin)
        end = len(text) if end < 0 else end + 1
        line = text[begin:end]
        words = line.lower().split()
        plain = b" ".join(words)
        if words:
            yield LINE, begin, end, plain
        if len(words) >= LEAST_WORDS or len(plain) >= LEAST_BYTES:
            at = 0
            for stop in (*(mark.end() for mark in _ENDS.finditer(line)), len(line)):
                words = line[at:stop].lower().split()
                plain = b" ".join(words)
                if len(words) >= LEAST_WORDS or len(plain) >= LEAST_BYTES:
                    yield SENTENCE, begin + at, begin + stop, plain
                at = stop
        begin = end


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "_text", 2 << 20):
            rows: list[tuple] = []
            digests: list[bytes] = []
            for doc, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
                for kind, begin, end, plain in units(text):
                    rows.append((doc, tag, kind, begin, end))
                    digests.append(xxhash.xxh3_128_digest(plain, kind))
            if rows:
                cells = np.array(rows, np.int64)
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [cells[:, 0], cells[:, 1], cells[:, 2].astype(np.int32), cells[:, 3], cells[:, 4], halves[:, 0], halves[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_doc", "_tag", "kind", "begin", "end", "h1", "h2"])


def cut(text: bytes, begins: list[int], ends: list[int]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text without the given spans, and the spans merged."""
    spans: list[list[int]] = []
    for a, b in sorted(zip(begins, ends)):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    left, at = [], 0
    for a, b in spans:
        left.append(text[at:a])
        at = b
    return b"".join([*left, text[at:]]), [(a, b) for a, b in spans]


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        left = [cut(t, a or [], b or []) for t, a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
        spans = pa.array([[{"begin": a, "end": b} for a, b in s] for _, s in left], kind)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in left], pa.binary()), spans], ["_box", "_left", "spans"])


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text (what is left), n_bytes of the input, n_removed units, spans removed from the input bytes.

    Every line that is not blank counts, and every sentence of at least ``LEAST_WORDS`` words or
    ``LEAST_BYTES`` normalised bytes. Null texts are empty; null ids come after all others, ordered by a hash of their
    text. Rows that repeat both id and text are one document and lose the same units. An empty table
    gives no rows. Only id and text are read; ``docs`` is read three times and must not change.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_text")).withColumn("_tag", F.xxhash64("_text"))
    rows = rows.withColumn("_doc", F.coalesce(F.col("_id").cast("long"), F.shiftrightunsigned("_tag", 2).bitwiseOR(F.lit(1 << 62))))
    found = rows.select("_doc", "_tag", "_text").mapInArrow(_unit_batches, _UNITS)
    place = F.struct("_doc", "begin", "_tag")
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = materialize(first)
    met = with_hit(found, F.col("h1"), bitmap(first, "h1", BITS), BITS).where("_hit").drop("_hit")
    again = met.join(first, ["h1", "h2"]).where(place != F.col("first"))
    spans = again.groupBy("_doc", "_tag").agg(F.collect_set(F.struct("begin", "end", "kind")).alias("_spans")).withColumn("_n", F.size("_spans"))  # repeated rows count once
    spans = materialize(spans)

    key = F.xxhash64("_doc", "_tag")
    flagged = with_hit(rows, key, bitmap(spans.select(key.alias("_h")), "_h", BITS), BITS)
    text = F.col("_text").cast("string")
    size = F.length("_text").cast("long")
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    whole = flagged.where("NOT _hit").select("_id", text.alias("text"), size.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), none.alias("spans"))
    touched = flagged.where("_hit").join(spans, ["_doc", "_tag"], "left")
    boxed = touched.select(F.struct("_id", size.alias("n"), F.coalesce("_n", F.lit(0)).alias("gone")).alias("_box"), "_text", "_spans.begin", "_spans.end")
    left = boxed.mapInArrow(_cut_batches, f"_box {boxed.schema['_box'].dataType.simpleString()}, _left binary, spans array<struct<begin:bigint,end:bigint>>")
    left = left.select(F.col("_box._id").alias("_id"), F.col("_left").cast("string").alias("text"), F.col("_box.n").alias("n_bytes"), F.col("_box.gone").cast("long").alias("n_removed"), "spans")
    return whole.unionByName(left).withColumnRenamed("_id", id_col)
