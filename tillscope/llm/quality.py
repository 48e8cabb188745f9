"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements and one bit per failed
rule. Policies are versioned lists of rules, applied to the stored bits; which documents a rule alone
decides about (``ablation``) is an aggregation over the bits, without another look at the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillscope.llm.common import prepare, text_bytes

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\r\x0b\x0c"

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_capital_words",
    "n_distinct_words",
)

# rule -> it fails where this holds; integer arithmetic only, so that every engine agrees. The position is the bit.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbol_share": "10 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines >= 5 and 100 * n_dup_lines > 30 * n_lines",
    "capital_share": "100 * n_capital_words > 50 * n_words",
    "mean_word_short": "word_chars < 2 * n_words",
    "mean_word_long": "word_chars > 14 * n_words",
    "few_distinct_words": "n_words >= 50 and 100 * n_distinct_words < 5 * n_words and n_distinct_words < 100",
}
BASE_RULES = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document is rejected when any of them failed."""

    version: int
    rules: tuple[str, ...] = field(default_factory=lambda: tuple(RULES))

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


def mask_of(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


POLICIES = {1: Policy(1, BASE_RULES), 2: Policy(2)}
CURRENT = 2


def _repeat_words(words: list[bytes]) -> tuple[int, int]:
    """Words covered by a window of three words that is found twice or more, and distinct words."""
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(words) < 4:
        return 0, len(index)
    # pairs get dense numbers first, so that a window always fits in 64 bits
    pair = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)[1]
    window = pair[:-1].astype(np.int64) * len(index) + ids[2:]
    _, where, count = np.unique(window, return_inverse=True, return_counts=True)
    again = count[where] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum()), len(index)


def measure(text: bytes) -> tuple[int, ...]:
    words = text.split()  # of bytes: splits at runs of ASCII white space only
    raw = np.frombuffer(text, np.uint8)
    chars = int(((raw & 0xC0) != 0x80).sum())
    white = len(text) - len(text.translate(None, WHITE))
    seen: set[bytes] = set()
    lines = again = 0
    for line in text.split(b"\n"):
        if line.strip(WHITE):
            lines += 1
            if line in seen:
                again += 1
            else:
                seen.add(line)
    repeat, distinct = _repeat_words(words)
    capital = sum(1 for w in words if w.isupper() and len(w) > 1)
    return (len(words), chars - white, len(text) - len(text.translate(None, SYMBOLS)), again, repeat, lines, capital, distinct)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([measure(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(MEASURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(rows[:, i]) for i in range(len(MEASURES))]], ["_box", *MEASURES])


def ledger(docs: DataFrame, carry: Column, text_col: str = "text") -> DataFrame:
    """One row per input row: ``carry`` (as ``_box``), the measurements, and ``failed``, a bit per failed rule.

    Words are runs of anything but ASCII white space; null counts as an empty text. Empty texts fail
    ``too_few_words``. A text is measured whole. Repeated rows are measured each; an empty table gives
    no rows. Only ``carry`` and the text column leave ``docs``, so other names cannot clash.
    """
    prepare(docs.sparkSession)
    rows = docs.select(carry.alias("_box"), text_bytes(text_col).alias("_text"))
    schema = T.StructType([rows.schema["_box"], *[T.StructField(m, T.LongType(), False) for m in MEASURES]])
    measured = rows.mapInArrow(_measure_batches, schema)
    bits = sum((F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())), F.lit(0))
    return measured.withColumn("failed", bits.cast("long"))


def verdict(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", version: int = CURRENT) -> DataFrame:
    """Measurements, ``failed`` bits, ``base_failed`` and ``kept`` under the policy of that version."""
    book = ledger(docs, F.col(id_col), text_col).withColumnRenamed("_box", id_col)
    base = F.col("failed").bitwiseAND(F.lit(mask_of(BASE_RULES))) != 0
    return book.withColumn("base_failed", base).withColumn("kept", ~base & verdict(POLICIES[version]))


def passing(docs: DataFrame, text_col: str = "text", version: int = CURRENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no rule of the policy rejects."""
    return ledger(docs, F.struct("*"), text_col).where(verdict(POLICIES[version])).select("_box.*")


def ablation(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that only it rejects."""
    policy = POLICIES[version]
    failed = F.col("failed").bitwiseAND(F.lit(policy.mask))
    single = {r: mask_of([r]) for r in policy.rules}
    figures = [F.sum((failed.bitwiseAND(F.lit(m)) != 0).cast("long")).alias(f"fails_{r}") for r, m in single.items()]
    figures += [F.sum((failed == m).cast("long")).alias(f"only_{r}") for r, m in single.items()]
    one = book.agg(F.count(F.lit(1)).alias("documents"), *figures)
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(f"fails_{r}", F.lit(0)).alias("fails"), F.coalesce(f"only_{r}", F.lit(0)).alias("fails_alone")) for r in single]))
    return one.select(F.lit(version).alias("version"), "documents", rows.alias("_r")).select("version", "documents", "_r.*")
