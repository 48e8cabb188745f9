"""Language, toxicity, BPE and HTML: held-out accuracy, brute force and round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tillscope.llm import bpe as B, html_extract as H, language as G, toxicity as T
from tillscope.llm.html_blocks import blocks

from .conftest import SF

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.ranks_of(PATH), special_tokens={})


def test_bpe_equals_library_and_round_trip(odd, empty):
    frame, rows = odd
    plain, ranks = library(), B.ranks_of(PATH)
    # some texts are longer than a chunk, one has a pre-token longer than the overlap
    got = B.encode(frame, F.struct("doc_id", "text"), ranks, public_tokenizers.PATTERN, chunk=400, overlap=60).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = plain.encode_ordinary(r._box.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (r._box.text or "").encode()
    out = B.encoded(frame, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == len(rows)
    assert out.where("doc_id = 10001").first().ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert B.encoded(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_merge_of_long_pieces():
    plain, ranks = library(), B.ranks_of(PATH)
    random.seed(2)
    for n in (3, 47, 48, 49, 500):
        for _ in range(20):
            piece = "".join(random.choice("abehtioné") for _ in range(n))
            assert B.merge(piece.encode(), ranks) == plain.encode_ordinary(piece)


def test_language(odd, empty, shared):
    frame, rows = odd
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    out = G.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r for r in G.language_id(frame).collect()}
    assert {got[i].lang_pred for i in (10_000, 10_001, 10_002, 10_007)} == {"und"} and len(G.language_id(frame).collect()) == len(rows)
    assert G.language_id(empty).count() == 0
    nobody = G.language_id(frame.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nobody.collect()} == {"und"}


def test_language_counts_equal_brute_force(shared):
    text = "Ab, cÉ d!" * 3
    G_PIECE, G.PIECE = G.PIECE, 7
    try:
        cut = np.concatenate([np.bincount(f, minlength=G.BUCKETS) for p in G._pieces(text) for f in G.grams(p)]).reshape(-1, G.BUCKETS).sum(axis=0)
    finally:
        G.PIECE = G_PIECE
    whole = sum(np.bincount(f, minlength=G.BUCKETS) for f in G.grams(G._codes(text)))
    assert (cut == whole).all() and whole.sum() == sum(len(text) - k for k in range(3))


def test_nearest_is_exact():
    """Block-max search finds the same neighbours as all cosines."""
    random.seed(4)
    terms = {f"t{i}": i for i in range(40)}
    idf = np.linspace(1, 3, 40)
    examples = [{"id": i, "label": i % 2, "terms": sorted(random.sample(range(40), random.randint(1, 5))), "counts": None} for i in range(900)]
    for e in examples:
        e["counts"] = [random.randint(1, 3) for _ in e["terms"]]
    index = T._index(terms, idf, examples)
    dense = np.zeros((len(index.ids), 40))
    for t in range(40):
        span = slice(index.start[t], index.start[t + 1])
        dense[index.example[span], t] = index.weight[span]
    for _ in range(60):
        at, value = index.vector({f"t{i}": random.randint(1, 4) for i in random.sample(range(40), random.randint(1, 6))})
        query = np.zeros(40)
        query[at] = value
        cosines = dense @ query
        found, got = index.nearest(at, value)
        best = np.sort(cosines)[::-1][: T.NEAREST]
        assert np.allclose(got, best[best > 1e-12]) and np.allclose(cosines[found], got)
    assert 0 <= index.rates.min() <= index.rates.max() <= 1 and (np.diff(index.rates) >= -1e-12).all()


def test_toxicity(odd, empty, shared):
    docs, labels = shared.read.parquet("/root/testdata/sf0.01/documents.parquet"), shared.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = T.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    hits = [r for r in out if r.predicted == 1]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert sum(r.toxic for r in hits) >= 0.8 * len(hits) and sum(r.toxic for r in hits) >= 0.25 * sum(r.toxic for r in out)
    frame, rows = odd
    small = shared.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(3, 1, None), (None, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert T.toxicity(frame, small).count() == len(rows)
    assert T.toxicity(empty, small).count() == 0
    assert {r.score for r in T.toxicity(frame, small.limit(0)).collect()} == {0.5}


def test_toxic_terms_of_few_rows_count_at_any_sample_size(shared):
    """A word of five toxic rows only is a term, in a small sample and in a large one."""
    for n in (400, 12_000):
        toxic = [i % 8 == 0 for i in range(n)]
        texts = [f"plain w{'abcdefgh'[i % 7]}" + (" zorgh" if i in range(0, 40, 8) else "") for i in range(n)]
        docs = shared.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        labels = shared.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
        index = T.fit(docs, labels)
        assert "zorgh" in index.terms, n
        assert index.score(b"zorgh")[0] > index.empty_rate, n


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page has-sidebar"><nav><ul><li>Menu</li></ul></nav>
<div class="cookie-notice">We use cookies</div><header>Site</header><main><article><header><h1>Head &amp; <i>line</i></h1></header><p>One<p>Two &eacute; &#x41; &nbsp; x<br>y
<div class="ad-box">Buy</div><form><p>Mail</p></form><ul><li>a<li>b</ul><script>var t="</p>";</script><aside>side</aside><!-- <p>no</p> --><pre>k   v</pre><a title=it's href="/x>y">link</a> 1 < 2
<section id="comments"><article class="comment">first!</article></section></article></main><footer>&copy; x</footer>"""


def test_blocks_of_a_page():
    assert H.page_blocks(PAGE.encode()) == (["Head & line", "One", "Two é A x y", "a", "b", "k v", "link 1 < 2"], True)
    assert H.page_blocks(b"") == ([], False) and H.page_blocks(b"plain <b>text") == (["plain text"], False)
    assert list(blocks("<p>a</p><!-- open")) == [(1, "a")]


def test_main_element_inside_a_form_or_a_named_container():
    """Menus and forms inside stay chrome, and so do articles of a sidebar beside a main article."""
    inner = "<nav>m</nav><{0}><h1>H</h1><p>body</p><form>mail</form><div class='share'>s</div></{1}><div class='ad'>x</div>"
    for start, end in (("<form id=f>", "</form>"), ("<div class='content-with-sidebar'>", "</div>"), ("<form><div class='layout sidebar-right'>", "</div></form>"), ("", "")):
        for first, last in (("article", "article"), ("main", "main"), ("div role=main", "div")):
            assert H.page_blocks((start + inner.format(first, last) + end).encode()) == (["H", "body"], True), (start, first)
    assert H.page_blocks(b"<article>a</article><div class=sidebar><article>b</article></div>") == (["a"], True)
    assert H.page_blocks(b"<div>a</div><div class=related><article>b</article></div>") == (["a"], False)


def test_host_repeats_go_where_structure_is_silent(shared):
    random.seed(8)
    words = ["".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    chrome = "Welcome to this site which greets all of its readers with this very same long line of words"
    rows = []
    for i in range(30):
        own = " ".join(random.choice(words) for _ in range(60))
        rows.append((i, f"http://h{i % 3}.example/p{i}", f"<div>{chrome}</div><div>{own}</div>", own))
    rows.append((30, "http://alone.example/", f"<div>{chrome}</div><div>x</div>", f"{chrome}\nx"))
    rows += [(31, None, f"<div>{chrome}</div>", chrome), (32, "http://h0.example/none", None, ""), (33, "http://h0.example/e", "", "")]
    frame = shared.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").withColumn("_doc", F.lit(1)).withColumn("text", F.lit("t"))
    assert {(r.page_id, r.text) for r in H.main_text(frame).collect()} == {(r[0], r[3]) for r in rows}
    assert H.main_text(frame.limit(0)).count() == 0


def test_every_page_goes_through_the_host_search(shared, monkeypatch):
    """Teasers in <article> do not hide a body outside; repeated lines of a main element that holds the body stay."""
    random.seed(9)
    words = ["".join(random.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    chrome, teaser, line = text(12), text(12), text(12)
    rows = []
    for i in range(6):
        own = text(60)
        rows.append((i, "http://h.example/a", f"<div>{chrome}</div><div>{own}</div><article>{teaser}</article>", own))
    for i in range(6, 12):
        own = text(60)
        rows.append((i, "http://h.example/b", f"<div>{chrome}</div><article><p>{own}</p><p>{line}</p></article>", f"{own}\n{line}"))
    seen, plain = [], H.repeated
    monkeypatch.setattr(H, "repeated", lambda streams, **kw: seen.append(streams.where("length(_text) > 0").count()) or plain(streams, **kw))
    frame = shared.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in H.main_text(frame).collect()} == {r[0]: r[3] for r in rows}
    assert seen == [12]


def test_pages_are_cut_once_and_html_is_never_shuffled(shared, monkeypatch):
    """Repeats cannot change a page whose main element outweighs all blocks outside it; other pages meet their marks by their blocks."""
    assert H.settled(["main text", "side"], [True, False]) and not H.settled(["main", "longer"], [True, False]) and not H.settled(["a"], [False]) and not H.settled([], [])
    for texts, inside in ((["m" * 60, "s" * 60], [True, False]), (["m" * 60, "s" * 61], [True, False]), (["s" * 60], [False])):
        options = {tuple(H.chosen_blocks(texts, inside, f, [1] * len(f))) for f in ([], [0], [0, 61], [61]) if not f or max(f) < sum(map(len, texts)) - 50}
        assert len(options) == 1 or not H.settled(texts, inside)
    own = {i: f"{word} is what page {i} says about {word}" for i, word in enumerate(("apples", "boats", "clouds", "dunes"))}
    rows = [(i, "http://h.example/", f"<div>{'navigation words ' * 5}</div><div>{own[i]}</div><!-- {'x' * 9000} -->") for i in range(4)] + [(9, "http://h.example/", "<main><p>a\nb</p><p>c</p></main>")]
    frame = shared.createDataFrame(rows, "page_id long, url string, html string")
    out = H.main_text(frame)
    assert {r.page_id: r.text for r in out.collect()} == {**own, 9: "a b\nc"}
    assert "html" not in out._jdf.queryExecution().optimizedPlan().toString()
