"""Exact distributed neighbours and the local outlier factor against numpy brute force."""

import numpy as np
import pytest

from tillscope.operators import neighbours as N


def brute(x, keys, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = [sorted(range(len(x)), key=lambda j: (d[i, j], keys[j]))[:k] for i in range(len(x))]
    order = [[j for j in o if np.isfinite(d[i, j])] for i, o in enumerate(order)]
    kd = np.array([d[i, o[-1]] for i, o in enumerate(order)])
    lrd = np.array([1 / (np.mean([max(kd[j], d[i, j]) for j in o]) + 1e-10) for i, o in enumerate(order)])
    lof = np.array([np.mean(lrd[o]) / lrd[i] for i, o in enumerate(order)])
    return order, kd, lrd, lof


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(size=(150, 3)), rng.normal(5, 0.3, size=(40, 3)), [[20, 20, 20], [-9, 3, 0]], np.repeat([[1.0, 1.0, 1.0]], 8, 0)])
    keys = list(range(1000, 1000 + len(x)))
    rows = [(k, *map(float, v)) for k, v in zip(keys, x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double"), x, keys


@pytest.mark.parametrize("cell_rows", [3, 25, 10_000])
def test_nearest_and_lof_equal_brute_force(points, cell_rows):
    frame, x, keys = points
    k = 5
    order, kd, lrd, lof = brute(x, keys, k)
    got = N.nearest(frame, "id", ["a", "b", "c"], k, cell_rows=cell_rows).collect()
    mine = {}
    for r in got:
        mine.setdefault(r.q, []).append((r.rank, r.o))
    assert {q: [o for _, o in sorted(v)] for q, v in mine.items()} == {keys[i]: [keys[j] for j in o] for i, o in enumerate(order)}
    scored = {r.id: r for r in N.local_outlier_factor(frame, "id", ["a", "b", "c"], k, cell_rows=cell_rows).collect()}
    for i, key in enumerate(keys):
        assert scored[key].k_distance == pytest.approx(kd[i], abs=1e-9)
        assert scored[key].lof == pytest.approx(lof[i], rel=1e-6)
    assert max(scored, key=lambda j: scored[j].lof) == keys[int(np.argmax(lof))]


def test_small_tables(spark):
    one = spark.createDataFrame([(1, 0.0, 0.0)], "id long, a double, b double")
    assert [r.lof for r in N.local_outlier_factor(one, "id", ["a", "b"], 3).collect()] == [None]
    assert N.local_outlier_factor(one.limit(0), "id", ["a", "b"], 3).count() == 0
    three = spark.createDataFrame([(1, 0.0, None), (2, 1.0, 0.0), (3, 3.0, 0.0)], "id long, a double, b double")
    got = {r.q: r.o for r in N.nearest(three, "id", ["a", "b"], 1).collect()}
    assert got == {1: 2, 2: 1, 3: 2}


@pytest.mark.parametrize("cell_rows", [4, 10_000])
def test_fill_nearest_equals_the_in_memory_filling(spark, cell_rows):
    from tillscope.operators import cleaning

    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 3))
    x[rng.random(x.shape) < 0.25] = np.nan
    x[5] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    frame = spark.createDataFrame(rows, "id long, a double, b double, c double")
    want = cleaning.impute_nearest(frame, ["a", "b", "c"], neighbours=3).toPandas().set_index("id").sort_index()
    got = N.fill_nearest(frame, "id", ["a", "b", "c"], 3, cell_rows=cell_rows).toPandas().set_index("id").sort_index()
    assert np.allclose(got[["a", "b", "c"]].to_numpy(), want[["a", "b", "c"]].to_numpy(), atol=1e-9)


def test_equal_rows_are_searched_once_and_cells_cut_every_column(spark, monkeypatch):
    """A third of the rows is equal, and the first two columns hold one value: the search stays near linear."""
    rng = np.random.default_rng(11)
    x = np.hstack([np.ones((3000, 2)), rng.normal(size=(3000, 3))])
    x[::3] = [1.0, 1.0, 0.1, 0.2, 0.3]
    frame = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double, d double, e double")
    met = spark.sparkContext.accumulator(0)
    plain = N._found

    def counted(names, k):
        search = plain(names, k)

        def both(table):
            asked = table.column("_loc").null_count
            met.add(asked * (table.num_rows - asked))
            return search(table)

        return both

    monkeypatch.setattr(N, "_found", counted)
    got = {}
    for r in N.nearest(frame, "id", list("abcde"), 4, cell_rows=100).collect():
        got.setdefault(r.q, []).append((r.d, r.o))
    assert met.value < 0.5 * len(x) ** 2  # all pairs before: one cell, since the first two columns cannot be cut
    for i in [*range(0, 3000, 97), 2997]:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        want = sorted((d[j], j) for j in range(len(x)) if j != i)[:4]
        assert [o for _, o in sorted(got[i])] == [j for _, j in want]


def test_filling_meets_few_of_many_equal_donors(spark, monkeypatch):
    """Of rows equal in the shared columns only k + 1 are searched, whatever their number."""
    rows = [(i, float(i % 10), None if i % 2 else float(i % 10) + 0.5) for i in range(4000)]
    frame = spark.createDataFrame(rows, "id long, a double, b double")
    met = spark.sparkContext.accumulator(0)
    plain = N._found

    def counted(names, k):
        search = plain(names, k)
        return lambda table: met.add(table.num_rows) or search(table)

    monkeypatch.setattr(N, "_found", counted)
    got = {r.id: (r.a, r.b) for r in N.fill_nearest(frame, "id", ["a", "b"], 3).collect()}
    assert met.value <= 2 * (5 * (3 + 1) + 5)  # five donor values, five query values; a task may run again for the result
    for i, a, b in rows:
        if b is None:  # the nearest even values are one below and one above; ties go to the smallest ids
            near = sorted((abs(a - r[1]), r[0], r[2]) for r in rows[:60] if r[2] is not None)[:3]
            b = sum(v for _, _, v in near) / 3
        assert got[i] == pytest.approx((a, b))


def test_filling_asks_once_for_rows_that_agree(spark, monkeypatch):
    """Candidates grow with the distinct known values, not with the rows; a repeated key still leaves itself out."""
    rows = [(i, float(i % 10), None if i % 2 else float(i % 10) + 0.5) for i in range(2000)] + [(5000, 3.0, None), (5000, 3.0, 100.0)]
    frame = spark.createDataFrame(rows, "id long, a double, b double")
    sizes = []
    plain = N.materialize

    def counted(df):
        out = plain(df)
        if "_dp" in out.columns:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(N, "materialize", counted)
    got = {}
    for r in N.fill_nearest(frame, "id", ["a", "b"], 3).collect():
        got.setdefault(r.id, []).append(r.b)
    assert sizes and sum(sizes) <= 5 * 3 + 3 + 5  # before: three for each of 1001 rows
    assert got[1] == [pytest.approx((0.5 + 2.5 + 0.5) / 3)]  # rows 0, 2 and 10
    assert sorted(got[5000]) == [pytest.approx((2.5 + 4.5 + 2.5) / 3), pytest.approx(100.0)]  # the other row of the key is no neighbour
