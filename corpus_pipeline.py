"""Corpus pipeline: STAGES applied to the documents table, each on all that the one before kept.

Stages 1 to 4 return the columns of documents. Null and empty texts fail the quality rules; an empty
table stays empty; repeated rows are reduced to one by exact dedup. Every stage is a whole operator
with its production parameters.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillscope.llm.bpe import encoded
from tillscope.llm.common import materialize, table
from tillscope.llm.exact_dedup import deduplicated
from tillscope.llm.mixing import mixed
from tillscope.llm.quality import passing
from tillscope.llm.queries import RANKS
from tillscope.llm.simhash import representatives


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the current policy rejects go."""
    return passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest doc_id stays."""
    return deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: three-word shingles, two bits; the smallest doc_id of each component stays."""
    return representatives(docs, words_per_shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: rows as often as the mix takes them."""
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE encoding and decoding: token counts and digests, one row per row of the mix."""
    return encoded(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("simhash near-dedup", near), ("source mixing", mix), ("byte-level bpe", encode)]
# fingerprints, components and token ids have no SQL form; tests/llm compares run() with a plain Python version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
