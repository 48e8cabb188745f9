"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fitting reads a bounded sample of labelled rows (``MAX_EXAMPLES``). Terms that say something about the
label (chi-square over the sample, at most ``MAX_TERMS``) make up the vectors. The index cuts the
examples in blocks and keeps, per term, its postings and its largest weight in each block: the sum of
these maxima bounds every cosine of a block, so blocks are visited from the best bound down until no
block can hold a nearer example. The nearest vote by their cosine; an isotonic fit of leave-one-out
votes turns a vote into a probability. Sample, index and fit have a fixed size and are broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillscope.llm.common import prepare, slices, text_bytes

MAX_EXAMPLES = 20_000  # labelled rows that are fitted on
MAX_TERMS = 20_000
LEAST_CHI2 = 24.0
LOT = 16  # best blocks that are summed first
BLOCK = 128
NEAREST = 15
THRESHOLD = 0.7
PIECE = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")


def term_counts(text: bytes, among: dict[str, int] | None = None) -> Counter:
    """Lower-case words of a whole text (of ``among`` only); long texts are read in pieces that end between words."""
    found: Counter = Counter()
    plain = text.decode("utf-8", "replace")
    begin = 0
    while begin < len(plain):
        end = min(begin + PIECE, len(plain))
        while end < len(plain) and plain[end].isalpha() and plain[end - 1].isalpha():
            end += 1
        words = _WORD.findall(plain[begin:end].lower())
        found.update(words if among is None else filter(among.__contains__, words))
        begin = end
    return found


@dataclass
class Index:
    """Postings by term over examples in blocks; all arrays are bounded by the sample."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray  # smallest id of each example; examples with the same vector are one
    sizes: np.ndarray  # rows of each example
    hits: np.ndarray  # and those of label 1
    start: np.ndarray  # first posting of each term
    example: np.ndarray  # example of each posting, ascending inside a term
    weight: np.ndarray
    most: np.ndarray  # terms x blocks: largest weight
    empty_rate: float  # share of label 1 among examples without any term
    steps: np.ndarray  # isotonic fit: votes
    rates: np.ndarray  # and probabilities

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text, of length one."""
        known = [(self.terms[t], n) for t, n in counts.items() if t in self.terms]
        if not known:
            return np.zeros(0, np.int64), np.zeros(0)
        at, n = np.array(sorted(known), np.int64).T
        value = (1 + np.log(n)) * self.idf[at]
        return at, value / np.sqrt((value * value).sum())

    def nearest(self, at: np.ndarray, value: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosine above zero and their cosines; of equal ones those met first."""
        bound = value @ self.most[at]
        visit = np.argsort(-bound, kind="stable")
        visit = visit[: np.count_nonzero(bound > 0)]
        spans = list(zip(self.start[at].tolist(), self.start[at + 1].tolist()))
        ids = np.concatenate([self.example[a:b] for a, b in spans])
        part = np.concatenate([v * self.weight[a:b] for (a, b), v in zip(spans, value)])
        home = ids // BLOCK
        found, cosine = np.zeros(0, np.int64), np.zeros(0)
        for begin, end in ((0, LOT), (LOT, len(visit))):  # the rest is bounded by what the best blocks hold
            blocks = visit[begin:end]
            if len(cosine) >= k:
                blocks = blocks[bound[blocks] > cosine[k - 1] + 1e-12]
            if not len(blocks):
                break
            row_of = np.full(len(bound), -1)
            row_of[blocks] = np.arange(len(blocks))
            row = row_of[home]
            here = row >= 0
            sums = np.bincount(row[here] * BLOCK + ids[here] % BLOCK, part[here], len(blocks) * BLOCK).reshape(-1, BLOCK)
            row, cell = np.nonzero(sums > 1e-12)
            found, cosine = np.concatenate((found, blocks[row] * BLOCK + cell)), np.concatenate((cosine, sums[row, cell]))
            order = np.lexsort((found, -cosine))[:k]
            found, cosine = found[order], cosine[order]
        return found, cosine

    def vote(self, found: np.ndarray, cosine: np.ndarray, without: tuple[int, int] | None = None) -> float | None:
        """Share of label 1 among the nearest, weighted by 1 / (distance + 0.05); ``without`` leaves out a row (example, label)."""
        hits, sizes = self.hits[found], self.sizes[found]
        if without:
            own = found == without[0]
            hits, sizes = hits - own * without[1], sizes - own
        weight = sizes / (1.05 - np.minimum(cosine, 1.0))
        return float((hits / np.maximum(sizes, 1) * weight).sum() / weight.sum()) if weight.any() else None

    def score(self, text: bytes) -> tuple[float, np.ndarray, np.ndarray]:
        at, value = self.vector(term_counts(text, self.terms))
        if len(at):
            found, cosine = self.nearest(at, value)
            if len(found):
                return float(np.interp(self.vote(found, cosine), self.steps, self.rates)), found, cosine
        return self.empty_rate, np.zeros(0, np.int64), np.zeros(0)


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over the votes, with one pseudo-count at either end of the scale."""
    values, where = np.unique(np.concatenate((votes, [0.0, 1.0])), return_inverse=True)
    hits = np.bincount(where, np.concatenate((labels, [0.0, 1.0])))
    counts = np.bincount(where).astype(float)
    pools: list[list[float]] = []  # hits, count, values
    for h, c in zip(hits, counts):
        pools.append([h, c, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            h2, c2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + h2, pools[-1][1] + c2, pools[-1][2] + n2]
    return values, np.repeat([h / c for h, c, _ in pools], [int(n) for *_, n in pools])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term and label in a task's part of the sample."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for label, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            seen[label].update(term_counts(text).keys())
    names = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([side[t] for t in names], pa.int64()) for side in seen]], ["term", "n0", "n1"])


def _keep_terms(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for batch in batches:
            rows = [sorted((terms[t], n) for t, n in term_counts(x, terms).items()) for x in batch.column(2).to_pylist()]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([[t for t, _ in r] for r in rows], kind), pa.array([[n for _, n in r] for r in rows], kind)], ["id", "label", "terms", "counts"]
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> Index:
    """Index over a sample of labelled documents; the caller leaves out what must not be learnt.

    Labels that are null are passed over; of several labels of an id the largest counts. The sample
    takes the ids of the smallest hashes, about ``max_examples`` of them and never more.
    """
    spark = prepare(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_key")).agg((F.max(label_col) > 0).cast("int").alias("_label"))
    order = F.xxhash64(F.lit("sample"), F.col("_key"))
    known = known.withColumn("_o", order)
    share = max_examples / max(known.count(), max_examples)
    edge = int((share * 1.05 - 0.5) * 2**64) if share < 0.9 else 2**63 - 1
    sample = known.where(F.col("_o") <= F.lit(edge)).orderBy("_o", "_key").limit(max_examples).drop("_o")
    texts = docs.select(F.col(id_col).alias("_key"), text_bytes(text_col).alias("_text")).join(F.broadcast(sample), "_key").select("_key", "_label", "_text")

    sizes = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    counted = texts.mapInArrow(_count_terms, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    total = float(n0 + n1)
    cross = a * F.lit(float(n1)) - b * F.lit(float(n0))
    spread = (a + b) * (F.lit(total) - a - b) * float(max(n0, 1)) * float(max(n1, 1))
    chosen = counted.where("a + b >= 3").withColumn("chi2", F.when(spread > 0, F.lit(total) * cross * cross / spread).otherwise(F.lit(0.0)))
    chosen = chosen.where(F.col("chi2") >= LEAST_CHI2).orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).collect()
    terms = {r["term"]: i for i, r in enumerate(chosen)}
    idf = np.array([np.log((1 + total) / (1 + r["a"] + r["b"])) + 1 for r in chosen])

    rows = texts.mapInArrow(_keep_terms(spark.sparkContext.broadcast(terms)), f"id {texts.schema['_key'].dataType.simpleString()}, label int, terms array<int>, counts array<int>")
    examples = sorted(rows.distinct().toLocalIterator(), key=lambda r: r["id"])  # at most max_examples short rows
    return _index(terms, idf, examples)


def _index(terms: dict[str, int], idf: np.ndarray, examples: list) -> Index:
    """Examples that share terms lie next to each other, so that the block maxima are tight."""
    merged: dict[tuple, list] = {}
    for r in examples:
        if r["terms"]:
            at = np.array(r["terms"], np.int64)
            value = (1 + np.log(np.array(r["counts"]))) * idf[at]
            value /= np.sqrt((value * value).sum())
            held = merged.setdefault((tuple(r["terms"]), tuple(np.round(value, 9).tolist())), [r["id"], 0, 0, at, value])
            held[0], held[1], held[2] = min(held[0], r["id"]), held[1] + 1, held[2] + r["label"]
    bare = [r["label"] for r in examples if not r["terms"]]
    filled = [merged[key] for key in sorted(merged)]
    most = np.zeros((len(terms), max(1, -(-len(filled) // BLOCK))))
    term = np.concatenate([np.zeros(0, np.int64), *[f[3] for f in filled]])
    example = np.repeat(np.arange(len(filled)), [len(f[3]) for f in filled])
    weight = np.concatenate([np.zeros(0), *[f[4] for f in filled]])
    np.maximum.at(most, (term, example // BLOCK), weight)
    order = np.lexsort((example, term))
    index = Index(
        terms,
        idf,
        np.array([f[0] for f in filled], np.int64),
        np.array([f[1] for f in filled], np.int64),
        np.array([f[2] for f in filled], np.int64),
        np.searchsorted(term[order], np.arange(len(terms) + 1)),
        example[order],
        weight[order],
        most,
        (sum(bare) + 0.5) / (len(bare) + 1.0) if bare else 0.5 * (len(filled) == 0),
        np.array([0.0, 1.0]),
        np.array([0.0, 1.0]),
    )
    votes, truth = [], []
    for i, (_, size, hits, at, value) in enumerate(filled):
        found, cosine = index.nearest(at, value)
        for label, rows in ((1, hits), (0, size - hits)):
            vote = index.vote(found, cosine, without=(i, label)) if rows else None
            if vote is not None:
                votes += [vote] * rows
                truth += [label] * rows
    if votes:
        index.steps, index.rates = isotonic(np.array(votes), np.array(truth, np.float64))
    return index


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(**shared.value)
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("rate", pa.float64())]))
        for whole in batches:
            for batch in slices(whole, "_text", 2 * PIECE):
                scores, evidence = [], []
                for text in batch.column(1).to_pylist():
                    score, found, cosine = index.score(text)
                    scores.append(score)
                    evidence.append([{"doc_id": int(index.ids[i]), "cosine": float(c), "rate": float(index.hits[i] / index.sizes[i])} for i, c in zip(found[:3], cosine[:3])])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["_box", "score", "evidence"])

    return run


def rate(docs: DataFrame, index: Index, carry: Column, text_col: str = "text") -> DataFrame:
    """``carry`` as ``_box``, score (0 to 1) and the nearest examples of every row.

    Texts without a known term, empty and null ones too, get the rate of such examples. Texts are read
    whole; repeated rows are scored each; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(carry.alias("_box"), text_bytes(text_col).alias("_text"))
    box = rows.schema["_box"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vars(index))  # plain arrays: executors need no copy of the package
    return rows.mapInArrow(_scorer(shared), f"_box {box}, score double, evidence array<struct<doc_id:bigint,cosine:double,rate:double>>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Score all documents by the labels outside the held-out third (crc32 of the id, mod 3, equal to 1)."""
    prepare(docs.sparkSession)
    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    index = fit(docs.where(~held), labels.where(~held), id_col, text_col, label_col)
    out = rate(docs, index, F.struct(F.col(id_col).alias("id"), held.alias("held_out")), text_col)
    return out.select(F.col("_box.id").alias(id_col), F.col("_box.held_out").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
