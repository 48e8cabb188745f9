"""Spelling variants against a brute force that compares every pair of vocabulary words."""

import re
import zlib
from collections import Counter

from tillscope.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    short, long_ = sorted((u, v), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute(rows, min_chars=6, min_count=5, factor=5):
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(str.maketrans(S.UPPER, S.UPPER.lower()))
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    vocab = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    out = {}
    for w, c in vocab.items():
        nb = [v for v in vocab if near(w, v)]
        best = min(nb, key=lambda v: (-vocab[v], v)) if nb else None
        form = best if best is not None and vocab[best] >= factor * c else None
        out[w] = [form, c, len(nb), vocab[form] if form else None]
    for w, row in out.items():
        r = w
        while out[r][0]:
            r = out[r][0]
        row.insert(1, r)
    return {(w, *row) for w, row in out.items()}


def test_spelling_equals_brute_force(odd):
    frame, rows = odd
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in S.spelling_variants(frame).collect()}
    assert got == brute([(r[0], r[1]) for r in rows])


def test_planted_variants_and_chains(shared):
    base = ["colour"] * 30 + ["color"] * 1 + ["neighbour"] * 200 + ["neighbor"] * 30 + ["neighbr"] * 6 + ["neighbouur"] * 10
    rows = [(i + 1_000_000, w) for i, w in enumerate(base)]
    rows = [(d, w) for d, w in rows if __import__("zlib").crc32(f"{d}:{w}".encode()) % 199]
    frame = shared.createDataFrame(rows + [(None, None), (7, "")], "doc_id long, text string")
    got = {r.word: r for r in S.spelling_variants(frame, min_chars=6, min_count=5).collect()}
    assert got == {} or {(w, r.form, r.root) for w, r in got.items()} == {(w, f, rt) for w, f, rt, *_ in brute(rows)}
    want = {w: (f, rt) for w, f, rt, *_ in brute(rows)}
    assert want["neighbr"] == ("neighbor", "neighbour") and want["neighbor"] == ("neighbour", "neighbour")


def test_acceptor_is_minimal_and_exact():
    items = sorted({"walking", "talking", "walked", "talked", "balked", "walks"})
    arcs, final = S.minimised(items)
    trie_states = len({w[:i] for w in items for i in range(len(w) + 1)})
    assert len(arcs) < trie_states
    accepted = set()
    stack = [(0, "")]
    while stack:
        s, p = stack.pop()
        if final[s]:
            accepted.add(p)
        stack.extend((t, p + c) for c, t in arcs[s].items())
    assert accepted == set(items)
    assert S.one_edit(arcs, final, "walked", 0) == {"talked", "balked"}
    assert S.one_edit(arcs, final, "walked", 1) == set()


def test_empty_table(shared):
    assert S.spelling_variants(shared.createDataFrame([], "doc_id long, text string")).count() == 0
