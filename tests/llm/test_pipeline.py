"""Registered text queries against SQL; the pipeline against a plain Python version of its decisions."""

from collections import Counter

import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline as P
from tests.compare import difference, duck
from tillscope.llm import bpe as B, mixing as M, quality as Q
from tillscope.llm.queries import QUERIES

from .conftest import SF
from .test_near import plain_components, plain_fingerprint


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_equals_sql(shared, name):
    assert difference(contract.queries()[name](shared, SF), duck(SF), contract.oracle_sql()[name]) is None


def test_thirteen_operators_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and "pipeline" in contract.queries()


def test_stages(shared, docs_rows):
    docs = shared.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.columns, []
    for name, stage in P.STAGES:
        docs = P.materialize(stage(shared, docs, SF))
        frames.append(docs)
        assert name == P.STAGES[-1][0] or docs.columns == columns
    rules = {r: compile(e, r, "eval") for r, e in Q.RULES.items()}
    kept = [r for r in docs_rows if not any(eval(e, {}, dict(zip(Q.MEASURES, Q.measure((r[1] or "").encode())))) for e in rules.values())]
    assert sorted(r.doc_id for r in frames[0].collect()) == sorted(r[0] for r in kept)
    last = {}
    for r in kept:
        last[r[1]] = max(last.get(r[1], r[0]), r[0])
    assert sorted(r.doc_id for r in frames[1].collect()) == sorted(last.values())
    ids = sorted(last.values())
    text = {i: t for t, i in last.items()}
    groups = plain_components([plain_fingerprint(text[i]) for i in ids])
    stay = sorted({g: i for i, g in sorted(zip(ids, groups), reverse=True)}.values())
    assert sorted(r.doc_id for r in frames[2].collect()) == stay
    taken = {r.doc_id: r.taken // r["size"] for r in M.mixture(frames[2]).collect()}
    assert Counter(r.doc_id for r in frames[3].collect()) == Counter({i: n for i, n in taken.items() if n})
    codec = B._Codec(B.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    assert Counter((r.doc_id, r.n_tokens) for r in frames[4].collect()) == Counter({(i, len(codec.encode(text[i])) // 4): n for i, n in taken.items() if n})
