"""Cross-tokenizer alignment against a whole-text brute force, with token bytes taken from another file."""

import base64
from bisect import bisect_left
from itertools import accumulate
import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tillscope.llm import alignment as AL

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(rows):
    """Every row from whole tokens: ends, common ends, groups, all pairs of each group, counts over distinct ids."""
    ranks = {int(i): base64.b64decode(t) for t, i in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    per = []
    for doc, text in rows:
        groups = []
        if text:
            whole = (" " + text).encode("utf-8", "surrogatepass")
            ia = a.encode(" " + text, add_special_tokens=False).ids
            ib = sp.encode(text)
            ba, bb = [ranks[i] for i in ia], [piece(i) for i in ib]
            if b"".join(ba) == whole and b"".join(bb) == whole:
                ea, eb = list(accumulate(map(len, ba))), list(accumulate(map(len, bb)))
                cuts = sorted(set(ea) & set(eb))
                slot = {c: k for k, c in enumerate(cuts)}
                groups = [([], []) for _ in cuts]
                for side, ids, ends in ((0, ia, ea), (1, ib, eb)):
                    for t, e in zip(ids, ends):
                        groups[slot[cuts[bisect_left(cuts, e)]]][side].append(t)
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        per.append((doc, groups, links))
    holders = defaultdict(set)
    for doc, _, links in per:
        for pair in links:
            holders[pair].add(doc)
    count = {pair: len(d) for pair, d in holders.items()}
    best = defaultdict(int)
    for (x, _), c in count.items():
        best[x] = max(best[x], c)
    out = Counter()
    for doc, groups, links in per:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out[(doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else "")] += 1
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("chunk", [211, AL.CHUNK_BYTES])
def test_alignment_equals_brute_force(odd, chunk):
    frame, rows = odd
    got = AL.alignment(frame, A, B, chunk_bytes=chunk).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == brute([(r[0], r[1]) for r in rows])


@pytest.mark.parametrize("hot", [0, 40])
def test_pairs_that_are_not_broadcast(odd, monkeypatch, hot):
    frame, rows = odd
    rows = [(r[0], r[1]) for r in rows] + [(10_005, "one more")] * 3
    monkeypatch.setattr(AL, "HOT_PAIRS", hot)
    frame = frame.select("doc_id", "text").unionByName(frame.sparkSession.createDataFrame([(10_005, "one more")] * 3, "doc_id long, text string"))
    got = AL.alignment(frame, A, B).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abZ01 .,'\n\t\u00a0\u3000\u2581\x85\x1c\u200b\u180e漢é🙂-")) | st.characters(exclude_categories=["Cs"]), min_size=1, max_size=40))
def test_units_give_the_tokens_of_the_whole_text(text):
    cut = AL._splitter(A, B)(text)
    assert " ".join(cut) == text
    (whole,), found = AL.tokens([text], A, B), AL.tokens(cut, A, B)
    assert (whole is None) == any(f is None for f in found)
    if whole is not None:
        assert [i for f in found for i in f[0].tolist()] == whole[0].tolist() and [i for f in found for i in f[2].tolist()] == whole[2].tolist()


def test_a_unit_is_tokenized_once(monkeypatch):
    met = []
    AL._store.cache_clear()
    known = AL._flat
    monkeypatch.setattr(AL, "_flat", lambda texts, *paths: met.extend(u for t in texts for u in t.split(" ")) or known(texts, *paths))
    batch = pa.RecordBatch.from_pydict({"_row": [1, 2], "doc_id": [1, 2], "text": ["to be or not to be, " * 50 + "or", "not to be " * 3000 + "or"]})
    out = [r for b in AL._chunked(iter([batch]), A, B, AL.CHUNK_BYTES) for r in b.to_pylist()]
    assert len(met) == len(set(met)) and sum(map(len, met)) < 100 and {r["_row"] for r in out} == {1, 2}


def test_a_small_store_of_units_gives_the_same(monkeypatch):
    texts = [f"{w} und {w}{i % 7} the {i}, was" for i in range(300) for w in ("one", "two▁", "dré")]
    batch = pa.RecordBatch.from_pydict({"_row": list(range(900)), "doc_id": list(range(900)), "text": texts})
    run = lambda: [r for b in AL._chunked(iter([batch]), A, B, AL.CHUNK_BYTES) for r in b.to_pylist()]
    want = run()
    monkeypatch.setattr(AL, "SLICE_BYTES", 200)
    for chars in (0, 50, 500):
        monkeypatch.setattr(AL, "UNIT_CHARS", chars)
        AL._store.cache_clear()
        assert sorted(run(), key=lambda r: r["_row"]) == want


def test_defined_cases(shared):
    frame = shared.createDataFrame([(1, None), (2, ""), (3, "a  b"), (3, "a  b"), (4, "x"), (5, "<s> hi </s>")], "doc_id long, text string")
    got = {(r.doc_id, r.groups_sha256): r for r in AL.alignment(frame, A, B).collect()}
    assert got[(1, "")].n_a == 0 and got[(2, "")].n_links == 0
    assert len([r for r in AL.alignment(frame, A, B).collect() if r.doc_id == 3]) == 2
    assert AL.alignment(frame.limit(0), A, B).count() == 0


fragments = st.lists(st.tuples(st.booleans(), st.lists(st.integers(0, 9), max_size=3), st.lists(st.integers(0, 9), max_size=3), st.sampled_from(["", "1|2", "3,4|5;6|"]), st.lists(st.integers(0, 9), max_size=2), st.lists(st.integers(0, 9), max_size=2)).map(lambda f: f if f[0] else (False, f[1], f[2], "", [], [])), min_size=3, max_size=3)


@settings(max_examples=200, deadline=None)
@given(fragments)
def test_compose_is_associative(three):
    x, y, z = three
    assert AL.compose(AL.compose(x, y), z) == AL.compose(x, AL.compose(y, z))
