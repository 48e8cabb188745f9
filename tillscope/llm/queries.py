"""Registered queries of this subpackage: name -> (query, comparison SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillscope.llm.alignment import alignment
from tillscope.llm.bpe import encoded
from tillscope.llm.compression_quality import compression_quality
from tillscope.llm.common import table
from tillscope.llm.exact_dedup import exact_dedup
from tillscope.llm.html_extract import main_text
from tillscope.llm.language import language_id
from tillscope.llm.line_dedup import line_dedup
from tillscope.llm.mixing import mixture
from tillscope.llm.quality import BASE_RULES, CURRENT, POLICIES, RULES, mask_of, quality_rules
from tillscope.llm.simhash import near_dedup
from tillscope.llm.spelling import spelling_variants
from tillscope.llm.suffix_dedup import suffix_dedup
from tillscope.llm.toxicity import toxicity

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (g ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source
), filled AS (
  SELECT *, w * ((1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER before, 0)::DOUBLE) / sum(w) OVER rest::DOUBLE) > cap AS above
  FROM s WINDOW before AS (ORDER BY cap / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                rest AS (ORDER BY cap / w::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE - coalesce(sum(cap) FILTER (above), 0)::DOUBLE) / sum(w) FILTER (NOT above)::DOUBLE AS t FROM filled
), goals AS (
  SELECT source, source_size, CASE WHEN above THEN cap::DOUBLE ELSE w * t END AS target,
         CASE WHEN source_size = 0 THEN 0 ELSE (CASE WHEN above THEN cap::DOUBLE ELSE w * t END) / source_size END AS rate
  FROM filled, level
), drawn AS (
  SELECT doc_id, size, d.source, source_size, target, rate, rate - floor(rate) AS inclusion,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u
  FROM d JOIN goals ON d.source IS NOT DISTINCT FROM goals.source
), ranked AS (
  SELECT *, CASE WHEN inclusion > 0 THEN (u / (1 - u)) / (inclusion / (1 - inclusion)) END AS rank FROM drawn
), cut AS (
  SELECT *, inclusion > 0 AND size > 0
            AND sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id)::DOUBLE - size / 2.0::DOUBLE <= target - floor(rate) * source_size AS taken_once
  FROM ranked
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN taken_once THEN 1 ELSE 0 END))::BIGINT AS taken FROM cut
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


_WORD = r"[^\x20\x09-\x0D]"
_FAILED = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))

OP7_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w FROM documents
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n FROM d, unnest(range(1, len(w) - 1)) AS u(i)
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY rid
), lines AS (
  SELECT rid, count(*) AS n, count(*) - count(DISTINCT l) AS again
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WORD}') GROUP BY rid
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.again, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.n, 0)::BIGINT AS n_lines,
         len(list_filter(w, lambda x: strlen(x) > 1 AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')))::BIGINT AS n_capital_words,
         len(list_distinct(w))::BIGINT AS n_distinct_words
  FROM d LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)
), judged AS (SELECT *, ({_FAILED})::BIGINT AS failed FROM measured)
SELECT *, failed & {mask_of(BASE_RULES)} <> 0 AS base_failed, failed & {mask_of(BASE_RULES) | POLICIES[CURRENT].mask} = 0 AS kept FROM judged
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))



def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(ALIGN_A), public_tokenizers.path(ALIGN_B))


ALIGN_A, ALIGN_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, tuple] = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_simhash_near_dedup": (op2_simhash_near_dedup, None),
    "op3_html_extraction": (op3_html_extraction, None),
    "op4_source_mixing": (op4_source_mixing, OP4_SQL),
    "op5_line_dedup": (op5_line_dedup, None),
    "op6_suffix_array_dedup": (op6_suffix_array_dedup, None),
    "op7_quality_rules": (op7_quality_rules, OP7_SQL),
    "op8_toxicity": (op8_toxicity, None),
    "op9_language_id": (op9_language_id, None),
    "op10_byte_bpe": (op10_byte_bpe, None),
    # token ids have no SQL form; tests/llm/test_alignment.py compares with a whole-text brute force
    "op11_cross_tokenizer_alignment": (op11_cross_tokenizer_alignment, None),
    # compressed sizes have no SQL form; tests/llm/test_compression_quality.py checks a brute force and held-out accuracy
    "op12_quality_classifier": (op12_quality_classifier, None),
    # DuckDB has no crc32; tests/llm/test_spelling.py compares with a brute force over all word pairs
    "op13_spelling_variants": (op13_spelling_variants, None),
}
