"""The mixing SQL and the operator agree on a table with a null source, null and empty texts."""

import duckdb
import pytest

from tillscope.llm import mixing as M
from tillscope.llm.queries import OP4_SQL

ROWS = [(1, "a b c", "src1"), (2, "d e", None), (3, "f", "src2"), (4, None, None), (5, "", "src1"), (6, "g h i j", "src3"), (7, "k l m n o p", None)]


def test_sql_keeps_null_source_and_equals_operator(shared):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", ROWS)
    want = {r[0]: r[1:] for r in con.execute(OP4_SQL).fetchall()}
    assert set(want) == {r[0] for r in ROWS}
    frame = shared.createDataFrame(ROWS, "doc_id long, text string, source string")
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in M.mixture(frame).collect()}
    assert set(got) == set(want)
    for k, (size, source_size, target, taken) in got.items():
        assert (size, source_size, taken) == (want[k][0], want[k][1], want[k][3])
        assert target == pytest.approx(want[k][2])


def test_exact_dedup_sql_keeps_one_of_repeated_rows(shared):
    from collections import Counter

    from tillscope.llm import exact_dedup as E
    from tillscope.llm.queries import OP1_SQL

    rows = [(1, "x"), (1, "x"), (2, "x"), (2, "x"), (None, "y"), (None, "y"), (3, None), (4, ""), (5, "z")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = Counter(tuple(r) for r in con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({OP1_SQL})").fetchall())
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in E.exact_dedup(shared.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == want
