"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-gram buckets of every labelled text in Arrow batches; each task keeps one dense
count row per language and sends it in chunks, which are summed per (language, chunk). The model is a
matrix (languages x buckets) of log probabilities; it is broadcast, and its size is fixed by the number
of languages and buckets, never by the number of documents. Texts are scored batch by batch in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillscope.llm.common import prepare, slices, text_bytes

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
CHUNK = 1 << 11
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
PIECE = 1 << 20  # characters that are hashed at once
UNKNOWN = "und"


def _codes(text: str) -> np.ndarray:
    """Code points in lower case; every ASCII character that is no letter becomes a space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = (codes < 128) & ((codes < 97) | (codes > 122))
    return np.where(plain, np.uint32(32), codes)


def _pieces(text: str) -> Iterator[np.ndarray]:
    """Runs of a text with the overlap that n-grams need; the whole text is covered."""
    for start in range(0, len(text), PIECE):
        yield _codes(text[start : start + PIECE + max(ORDERS) - 1])


def grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the n-grams that start in the first PIECE characters, for each order."""
    value = np.zeros(len(codes), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        value = value[: len(codes) - order + 1] * np.uint32(0x01000193) + codes[order - 1 :]
        if order in ORDERS:
            mixed = (value + np.uint32(order)) * np.uint32(2654435761)
            mixed ^= mixed >> np.uint32(15)
            yield ((mixed * np.uint32(2246822519)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)[:PIECE]


def _text(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held = counts.get(lang)
            if held is None:
                held = counts[lang] = np.zeros(BUCKETS, np.int64)
            for piece in _pieces(_text(text)):
                for found in grams(piece):
                    held += np.bincount(found, minlength=BUCKETS)
    rows = [(lang, c, held[c * CHUNK : (c + 1) * CHUNK].tobytes()) for lang, held in counts.items() for c in range(BUCKETS // CHUNK)]
    if rows:
        yield pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "chunk": pa.array([r[1] for r in rows], pa.int32()), "counts": pa.array([r[2] for r in rows], pa.binary())})


def _sum_chunks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CHUNK, np.int64)
    for batch in batches:
        for data in batch.column(batch.schema.get_field_index("counts")).to_pylist():
            total += np.frombuffer(data, np.int64)
    yield pa.RecordBatch.from_pydict({"lang": [key[0].as_py()], "chunk": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the matrix buckets x languages of log probabilities.

    Rows without a language or with an empty text teach nothing. Without any usable row the list is empty.
    """
    prepare(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), text_bytes(text_col).alias("text")).where(F.length("text") > 0)
    chunks = rows.mapInArrow(_count_batches, "lang string, chunk int, counts binary")
    summed = chunks.groupBy("lang", "chunk").applyInArrow(_sum_chunks, "lang string, chunk int, counts binary")
    found: dict[str, np.ndarray] = {}
    for lang, chunk, data in summed.toLocalIterator():  # languages x 8 rows of 16 KB
        found.setdefault(lang, np.zeros(BUCKETS, np.int64))[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(data, np.int64)
    langs = sorted(found)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    counts = np.stack([found[x] for x in langs], axis=1) + SMOOTHING
    return langs, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def has_letter(text: str) -> bool:
    return bool(re.search("[A-Za-z]", text)) or any(map(str.isalpha, text))


def score_text(text: str, matrix: np.ndarray) -> tuple[np.ndarray, int]:
    """Log likelihood of each language and the number of n-grams."""
    total, n = np.zeros(matrix.shape[1], np.float64), 0
    for piece in _pieces(text):
        for found in grams(piece):
            total += matrix[found].sum(axis=0, dtype=np.float64)
            n += len(found)
    return total, n


def _predictor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = shared.value
        for whole in batches:
            for batch in slices(whole, "_text", 2 * PIECE):
                names, scores = [], []
                for text in map(_text, batch.column(1).to_pylist()):
                    if not langs or not has_letter(text):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    total, n = score_text(text, matrix)
                    best = int(total.argmax())
                    # posterior at the weight of at most 50 n-grams: comparable for short and long texts
                    odds = np.exp((total - total[best]) * (min(n, 50) / max(n, 1)))
                    names.append(langs[best])
                    scores.append(float(1.0 / odds.sum()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["_box", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], carry: Column, text_col: str = "text") -> DataFrame:
    """``carry`` as ``_box``, lang_pred and score (0 to 1) of every row.

    Null texts and texts without any letter give ``und`` with score 0, and so does a model without
    languages. Ties go to the first language by name. Texts of any length are scored whole; repeated
    rows are scored each; an empty table gives no rows. Only ``carry`` and the text leave ``docs``.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(carry.alias("_box"), text_bytes(text_col).alias("_text"))
    kind = rows.schema["_box"].dataType.simpleString()
    return rows.mapInArrow(_predictor(shared), f"_box {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == part


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the documents outside the held-out part, predict all. A null id belongs to the training part."""
    held = F.coalesce(held_out(id_col), F.lit(False))
    model = train(docs.where(~held), text_col, lang_col)
    out = identify(docs, model, F.struct(F.col(id_col).alias("id"), held.alias("held_out")), text_col)
    return out.select(F.col("_box.id").alias(id_col), F.col("_box.held_out").alias("held_out"), "lang_pred", "score")
