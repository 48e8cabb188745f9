"""Spelling variant grouping by finite-state composition.

Words. Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased; a run whose crc32 of
"<doc_id>:<run>" (unsigned; a null doc_id as the empty string) is divisible by 199 loses its code point
h % length. Words are the distinct results with at least ``min_chars`` code points and ``min_count``
occurrences (n). All of this is DataFrame functions; the counts aggregate partially before the shuffle.

Near pairs. V o T o V, where V is the minimised acceptor of the vocabulary and T the transducer of
exactly one insertion, deletion or substitution, accepts exactly the pairs at edit distance one. Its
paths are enumerated per *initial-state partition*: the paths of V that start with the same three
symbols (the state reached from the initial state) form one partition, and within it only edits at
position three or later are taken. An edit in the first three positions leaves the last three symbols
of both words equal (words have six or more), so a second pass does the same over the reversed words;
the union of both passes is every near pair, each found at least once (duplicates are removed). Each
partition builds its own minimised acceptor (a trie with equal sub-trees merged) and walks, for every
word, the one-edit product with it: substitution and insertion follow each arc of the state, deletion
skips a symbol, and the rest of the word must be accepted exactly.

Forms and roots. A word's form is its near word of largest n (ties: smallest in code-point order) when
that n is at least ``factor`` times its own n, else null. Since a form's n is larger than the word's,
following forms ends; roots are found by repeated joins, one per step of the longest chain (at most
log base ``factor`` of the largest n).

Defined results: null texts have no runs; an empty table (or no word that qualifies) gives an empty
result; repeated rows count again (occurrences are counted over all rows); only doc_id and text are
read, so clashing names cannot interfere.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tillscope.llm.common import materialize, prepare

RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DELETE_EVERY = 199
MIN_CHARS, MIN_COUNT, FACTOR = 6, 5, 5
SHARED = 3  # symbols of the initial path that name a partition


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """The vocabulary: word, n (occurrences over all rows), for words of min_chars or more and n >= min_count."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(RUN), F.lit(0))).alias("_run"))
    runs = runs.withColumn("_run", F.translate("_run", UPPER, UPPER.lower()))
    h = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    at = F.pmod(h, F.length("_run")).cast("int")
    cut = F.concat(F.col("_run").substr(F.lit(1), at), F.col("_run").substr(at + 2, F.length("_run")))
    word = F.when(F.pmod(h, F.lit(DELETE_EVERY)) == 0, cut).otherwise(F.col("_run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def minimised(items: list[str]) -> tuple[list[dict[str, int]], list[bool]]:
    """The minimised acceptor of ``items``: arcs and finality per state, state 0 initial (equal sub-tries merged)."""
    arcs: list[dict[str, int]] = [{}]
    final = [False]
    for w in items:
        s = 0
        for c in w:
            nxt = arcs[s].get(c)
            if nxt is None:
                nxt = arcs[s][c] = len(arcs)
                arcs.append({})
                final.append(False)
            s = nxt
        final[s] = True
    # merge bottom-up: children before parents (a trie's states are numbered after their parent)
    canon: dict[tuple, int] = {}
    rename = list(range(len(arcs)))
    for s in range(len(arcs) - 1, -1, -1):
        arcs[s] = {c: rename[t] for c, t in arcs[s].items()}
        sig = (final[s], tuple(sorted(arcs[s].items())))
        rename[s] = canon.setdefault(sig, s)
    keep = sorted(set(rename[s] for s in range(len(arcs))))
    place = {s: i for i, s in enumerate(keep)}
    return [{c: place[rename[t]] for c, t in arcs[s].items()} for s in keep], [final[s] for s in keep]


def _accepts(arcs, final, s: int, rest: str) -> bool:
    for c in rest:
        s = arcs[s].get(c)
        if s is None:
            return False
    return final[s]


def one_edit(arcs, final, word: str, first: int) -> set[str]:
    """The words the acceptor takes that are one insertion, deletion or substitution at position >= first away from ``word``."""
    found: set[str] = set()
    s = 0
    for i in range(len(word) + 1):
        if i >= first:
            for c, t in arcs[s].items():
                if i < len(word) and c != word[i] and _accepts(arcs, final, t, word[i + 1 :]):
                    found.add(word[:i] + c + word[i + 1 :])
                if _accepts(arcs, final, t, word[i:]):
                    found.add(word[:i] + c + word[i:])
            if i < len(word) and _accepts(arcs, final, s, word[i + 1 :]):
                found.add(word[:i] + word[i + 1 :])
        if i == len(word):
            break
        s = arcs[s].get(word[i])
        if s is None:
            break
    found.discard(word)
    return found


def _partition(key, frame: pd.DataFrame) -> pd.DataFrame:
    """All near pairs of one partition (words sharing their first SHARED symbols; reversed in the second pass)."""
    items = sorted(frame["_w"])
    arcs, final = minimised(items)
    reverse = bool(frame["_rev"].iloc[0])
    pairs = [(w, v) for w in items for v in one_edit(arcs, final, w, SHARED)]
    if reverse:
        pairs = [(w[::-1], v[::-1]) for w, v in pairs]
    return pd.DataFrame(pairs, columns=["word", "near"])


def near_pairs(vocab: DataFrame) -> DataFrame:
    """Both orders of every pair of vocabulary words at edit distance one."""
    forward = vocab.select(F.col("word").alias("_w"), F.lit(False).alias("_rev"))
    backward = vocab.select(F.reverse("word").alias("_w"), F.lit(True).alias("_rev"))
    both = forward.unionByName(backward).withColumn("_part", F.substring("_w", 1, SHARED))
    return both.groupBy("_rev", "_part").applyInPandas(_partition, "word string, near string").dropDuplicates()


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, factor: int = FACTOR) -> DataFrame:
    """Per vocabulary word: word, form, root, n, n_near, form_n (see the module text)."""
    prepare(docs.sparkSession)
    vocab = materialize(words(docs, id_col, text_col, min_chars=min_chars, min_count=min_count))
    pairs = near_pairs(vocab).join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    ranked = pairs.withColumn("_k", F.row_number().over(Window.partitionBy("word").orderBy(F.desc("near_n"), "near"))).withColumn("n_near", F.count(F.lit(1)).over(Window.partitionBy("word")))
    best = ranked.where("_k = 1").select("word", "near", "near_n", "n_near")
    linked = vocab.join(best, "word", "left")
    has_form = F.col("near_n") >= factor * F.col("n")
    table = materialize(linked.select("word", F.when(has_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("near_n")).cast("long").alias("form_n")))
    forms = table.where(F.col("form").isNotNull()).select(F.col("word").alias("_at"), F.col("form").alias("_next"))
    roots = table.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        step = materialize(roots.join(forms, roots["root"] == forms["_at"], "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        roots = step.drop("_moved")
        if step.where("_moved").isEmpty():
            break
    return table.join(roots, "word").select("word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n")
