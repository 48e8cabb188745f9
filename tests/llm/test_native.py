"""Exact dedup, quality rules and mixing against plain Python, on the odd cases."""

import hashlib
import re
from collections import Counter, defaultdict

from tillscope.llm import exact_dedup as E, mixing as M, quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least(i):
    return -(10**18) if i is None else i


def test_exact_dedup(odd):
    frame, rows = odd
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    got = E.exact_dedup(frame, salts=3).collect()
    assert len(got) == len(rows)
    assert sum(r.kept for r in got) == len(groups)
    seen = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=least)
        digest = hashlib.sha256(text.encode()).hexdigest()
        seen.update((i, keep, len(ids), digest) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == seen
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    # a bitmap of one cell makes every text a candidate: same result
    assert sorted(map(str, E.exact_dedup(frame, bits=E_CELL).collect())) == sorted(map(str, E.exact_dedup(frame).collect()))


E_CELL = 32_768


def test_deduplicated_keeps_columns(odd, empty):
    frame, rows = odd
    out = E.deduplicated(frame)
    assert out.columns == frame.columns and out.count() == len({r[1] or "" for r in rows})
    assert E.exact_dedup(empty).count() == 0 and E.deduplicated(empty).columns == empty.columns


def plain_measures(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_policies(odd, empty):
    frame, rows = odd
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in Q.quality_rules(frame).collect())
    expected = Counter()
    for r in rows:
        m = plain_measures(r[1] or "")
        expected[(r[0], *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert got == expected
    book = Q.ledger(frame, frame["doc_id"])
    first, last = Q.POLICIES[1], Q.POLICIES[2]
    assert book.where(Q.verdict(first)).count() >= book.where(Q.verdict(last)).count() == Q.passing(frame).count()
    for row in Q.ablation(book).collect():
        bit = Q.mask_of([row.rule])
        assert row.fails == book.where(book.failed.bitwiseAND(bit) != 0).count()
        assert row.fails_alone == book.where(book.failed.bitwiseAND(last.mask) == bit).count()
    assert Q.passing(frame).columns == frame.columns
    assert Q.quality_rules(empty).count() == 0 and {r.fails for r in Q.ablation(Q.ledger(empty, empty["doc_id"])).collect()} == {0}


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, goal = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        level = (goal - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= above


def test_mixture(odd, empty):
    frame, rows = odd
    out = M.mixture(frame).collect()
    sizes, longest = Counter(), Counter()
    for r in rows:
        n = len(WORD.findall(r[1] or ""))
        sizes[r[3]] += n
        longest[r[3]] = max(longest[r[3]], n)
    goal = plain_targets(sizes)
    assert len(out) == len(rows)
    taken = Counter()
    source = {(r[0], len(WORD.findall(r[1] or ""))): r[3] for r in rows}
    for r in out:
        s = source[r.doc_id, r["size"]]
        taken[s] += r.taken
        assert r.source_size == sizes[s] and abs(r.target - goal[s]) < 1e-6 * max(1, goal[s])
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 2 * r["size"]
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 2 * longest[s]
    again = M.mixture(frame.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    rows_out = M.mixed(frame)
    assert rows_out.columns == frame.columns
    assert rows_out.where(M.words("text") > 0).count() == sum(r.taken // r["size"] for r in out if r["size"])
    assert M.mixture(empty).count() == 0 and M.mixed(empty).count() == 0


def test_mixture_cuts_within_half_a_document(shared):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 4}") for i in range(4000)]
    out = M.mixture(shared.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("target").sum("taken").collect()
    assert len(out) >= 2 and all(abs(r["sum(taken)"] % 10**9 - r.target * round(r["sum(taken)"] / r.target)) <= 4 * round(r["sum(taken)"] / r.target) for r in out)
