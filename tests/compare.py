"""Run registered queries next to their SQL in DuckDB and report differences.

python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(df, con, sql):
    """None when equal, else a short text."""
    columns, mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if mine else "no rows"
    cur = con.execute(sql)
    expected_columns, theirs = rows_of([c[0] for c in cur.description], cur.fetchall())
    if columns != expected_columns:
        return f"columns {sorted(set(columns) ^ set(expected_columns))}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    if not mine:
        return "no rows"
    kinds = lambda rows: [{type(r[i]).__name__ for r in rows if r[i] is not None} for i in range(len(columns))]
    for c, a, b in zip(columns, kinds(mine), kinds(theirs)):
        if a != b:
            return f"types of {c}: {a} != {b}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {cells[:3]}"
    return None


def main():
    from tillscope.plans.catalog import registered
    from tillscope.session import build_session

    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    args = p.parse_args()
    os.environ.setdefault("PYTHONPATH", ROOT)
    spark = build_session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    failed = 0
    for name, (query, sql) in registered().items():
        if args.names and not any(n in name for n in args.names):
            continue
        start = time.time()
        try:
            problem = difference(query(spark, args.sf), con, sql)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {'' if sql else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
