"""SimHash, line dedup and suffix-array dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
import pyarrow as pa
from tillscope.llm import line_dedup as L, simhash as S, suffix_dedup as D, suffix_sort as ss


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            votes[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * votes[i] > len(shingles))


def plain_components(values, bits=2):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def test_near_dedup_equals_brute_force(odd, empty):
    frame, rows = odd
    prints = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_components(prints)
    smallest = {}
    for g, r in zip(groups, rows):
        if r[0] is not None:
            smallest[g] = min(smallest.get(g, r[0]), r[0])
    expected = sorted((str(r[0]), f"{p:016x}", str(smallest.get(g))) for r, p, g in zip(rows, prints, groups))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in S.near_dedup(frame).collect()) == expected
    left = S.representatives(frame)
    assert left.columns == frame.columns and left.count() == len(set(groups))
    assert S.near_dedup(empty).count() == 0 and S.representatives(empty).count() == 0


@pytest.mark.parametrize("crowd", [0, 3, 1000])
def test_links_in_crowded_halves(shared, crowd):
    """Balls round one fingerprint share halves; every link must be found whatever counts as crowded."""
    random.seed(3)
    values = set()
    for centre in (0, 0x0123456789ABCDEF, (1 << 64) - 1):
        for _ in range(60):
            values.add(centre ^ sum(1 << b for b in random.sample(range(64), random.choice((1, 2, 3)))))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {tuple(sorted((r.a, r.b))) for r in S.links(shared.createDataFrame([(v,) for v in signed], "_fp long"), crowd=crowd).collect()}
    expected = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}
    assert got == expected


def shuffled_rows(plan):
    """Rows that the exchanges of an executed plan wrote."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return shuffled_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return shuffled_rows(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return own + sum(shuffled_rows(plan.children().apply(i)) for i in range(plan.children().size()))


@pytest.mark.parametrize("crowd", [0, 32])
def test_probes_without_a_partner_are_not_shuffled(shared, crowd):
    """Where the halves are too many to broadcast, only probes that may meet a fingerprint move."""
    random.seed(8)
    n = 3000
    values = sorted({random.getrandbits(64) - (1 << 63) for _ in range(n)} | {5, 4})
    held = shared.conf.get("spark.sql.autoBroadcastJoinThreshold")
    shared.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = S.links(shared.createDataFrame([(v,) for v in values], "_fp long"), crowd=crowd)
        assert [(r.a, r.b) for r in found.collect()] == [(4, 5)]
        assert shuffled_rows(found._jdf.queryExecution().executedPlan()) < 20 * n  # before: 33 probes of each, and more where halves are crowded
    finally:
        shared.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_bitmap_of_halves_loses_no_link(shared):
    """A full bitmap lets every probe through and changes nothing."""
    values = [(v << 32) + w for v in range(40) for w in (0, 3, 1 << 20)]
    frame = shared.createDataFrame([(v,) for v in values], "_fp long")
    got = sorted((r.a, r.b) for r in S.links(frame, bits=32_768).collect())
    assert got == sorted((a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2)


def test_components_of_a_long_path(shared):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000 + i, 1000) for i in range(1, 40)]
    random.shuffle(edges)
    got = {r.node: r.root for r in S.components(shared.createDataFrame(edges, "a long, b long")).collect()}
    # a root has no row of its own: only nodes that point to another one
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 40)}


def plain_suffix(rows, length=50):
    """Per row in input order: removed mask; ``rows`` are (order key, bytes)."""
    first = {}
    for key, t in rows:
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            first[w] = min(first.get(w, key), key)
    out = []
    for key, t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < key:
                gone[i : i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("buffer, common", [(1 << 21, 10_000), (4000, 1)])
def test_suffix_dedup_equals_brute_force(odd, empty, monkeypatch, buffer, common):
    """Small buffers cut long texts; a limit of one deals every window by its own hash."""
    monkeypatch.setattr(D, "BUFFER", buffer)
    monkeypatch.setattr(D, "COMMON_LEAST", common)
    frame, rows = odd
    order = {None: 1 << 62}
    keyed = [(order.get(r[0], r[0]), (r[1] or "").encode()) for r in rows]
    masks = plain_suffix(keyed)
    expected = sorted((str(r[0]), len(t), int(m.sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest()) for r, (_, t), m in zip(rows, keyed, masks))
    got = D.suffix_dedup(frame, buckets=5).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_bytes - len(r.kept), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == expected
    for r in got:
        assert sum(s.end - s.begin for s in r.spans) == r.n_bytes - len(r.kept)
    assert D.suffix_dedup(empty).count() == 0


def test_windows_are_sorted(shared):
    random.seed(5)
    for trial in range(20):
        texts = [bytes(random.choice(b"ab" if trial % 2 else b"abcdef ") for _ in range(random.choice((0, 49, 50, 180)))) for _ in range(6)]
        texts += [random.choice(texts) + random.choice(texts) for _ in range(6)]
        raw = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        head, number, place, anchor = ss.anchors(raw, starts, ends)
        windows, run = D._windows(head, number)
        assert sorted(windows.tolist()) == [int(s) + i for s, t in zip(starts, texts) for i in range(len(t) - 49)]
        bucket = anchor[run] * np.uint64(64) + (place[run] - windows).astype(np.uint64)
        order, _ = ss.deep_shallow(raw, windows, bucket)
        found = [(bucket[o], raw[windows[o] : windows[o] + 50].tobytes()) for o in order]
        assert found == sorted(found)


def test_line_dedup_equals_brute_force(odd, empty):
    frame, rows = odd
    seen, expected = set(), {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        text = (r[1] or "").encode()
        if (r[0], text) in expected:
            continue
        again = []
        for kind, begin, end, plain in sorted(L.units(text), key=lambda u: (u[1], u[0])):
            if (kind, plain) in seen:
                again.append((begin, end))
            seen.add((kind, plain))
        left, _ = L.cut(text, [a for a, _ in again], [b for _, b in again])
        expected[r[0], text] = (left.decode(), len(again))
    got = [r for r in L.line_dedup(frame).collect() if r.doc_id is not None]
    assert {(r.doc_id, r.text, r.n_removed) for r in got} == {(k[0], *v) for k, v in expected.items()}
    assert len(got) == sum(r[0] is not None for r in rows) and L.line_dedup(empty).count() == 0


def test_units_keep_offsets():
    text = "First line here\nA sentence of more than eight words stands right here. Short one. And another one of more than eight words is here.\n".encode()
    for _, begin, end, plain in L.units(text):
        assert b" ".join(text[begin:end].lower().split()) == plain
    assert L.cut(b"abcdef", [1, 2], [3, 4]) == (b"aef", [(1, 4)])


def test_short_lines_and_scripts_without_spaces_are_units(shared):
    """One-word lines, and sentences that end at other marks than ASCII ones, are met as well."""
    passage = "这是一段在许多网页上反复出现的文字内容。"
    line = "同じ行が何度も出てくる長い文章です"
    rows = [(1, f"Menu\n{line}\n甲。{passage}乙。\n\nend one"), (2, f"MENU\n{line}\n\n丙。{passage}丁。\nend two"), (3, "Menu\nmenu\n")]
    got = {r.doc_id: r.text for r in L.line_dedup(shared.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\n丙。丁。\nend two", 3: ""}


def test_placed_texts_come_back_and_travel_compressed(monkeypatch):
    docs = [7, -3, 2, 7, 12, 1 << 62]
    texts = [b"", b"one two three " * 400, b"x", "é\0".encode() * 500, b"one two three " * 500, b"z" * 60]
    batch = pa.RecordBatch.from_pydict({"_doc": docs, "_tag": [-1, 2, 3, 4, 5, 6], "_space": [0, -9, 1, 1, 1, 1], "_text": pa.array(texts, pa.binary())})
    for limit in (1, 1 << 24):
        monkeypatch.setattr(D, "OFFER_BYTES", limit)
        sent = pa.Table.from_batches(D._place(5)(iter([batch])))
        assert sum(map(len, sent.column("data").to_pylist())) < sum(map(len, texts)) / 4
        back = []
        for key in range(5):
            names, tags, spaces, held = D._placed(sent.filter(pa.array([k == key for k in sent.column("key").to_pylist()])))
            assert all(n % 5 == key for n in names.tolist())
            back += zip(names.tolist(), tags.tolist(), spaces.tolist(), held)
        assert sorted(back) == sorted(zip(docs, [-1, 2, 3, 4, 5, 6], [0, -9, 1, 1, 1, 1], texts))


def test_pairs_travel_as_steps_and_places():
    """Pairs come back whole for any id, and take a good part less than plain arrays of ids and anchors."""
    rng, buckets, n = np.random.default_rng(4), 53, 4000
    bucket = 7
    doc = (rng.integers(-50, 2000, n) * buckets + bucket).astype(np.int64)
    doc[:3] = [(1 << 62) + (bucket - (1 << 62)) % buckets, -(1 << 40) + (bucket + (1 << 40)) % buckets, bucket]
    assert (doc % buckets == bucket).all()
    anchor = np.sort(rng.integers(0, 1 << ss.ANCHOR_BITS, n).astype(np.uint64))
    data = D._pack_pairs(doc.astype(np.uint64), anchor, np.zeros(n), buckets)
    got = D._unpack_pairs(data, bucket, buckets)
    assert (got[0].astype(np.int64) == doc).all() and (got[1] == anchor).all() and not got[2].any()
    assert len(data) < 0.9 * len(D._pack(doc, anchor, np.zeros(n)))
