"""The local outlier factor by locations: ties, equal rows, and what it writes."""

import numpy as np
import pytest

from tests.test_neighbours import brute
from tillscope.operators import local_factor, neighbours as N


def scored(frame, columns, k, cell_rows):
    return {r.id: r for r in N.local_outlier_factor(frame, "id", columns, k, cell_rows=cell_rows).collect()}


@pytest.mark.parametrize("cell_rows", [12, 10_000])
def test_ties_and_equal_rows_equal_brute_force(spark, cell_rows):
    """Places on a grid: many equally far rows, of which the smallest keys count, in several rows of a place and across cells."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.integers(0, 7, size=(160, 2)).astype(float), np.repeat([[3.0, 3.0]], 12, 0), [[40.0, -3.0]]])
    keys = [int(v) for v in rng.permutation(len(x)) * 3 + 1]
    frame = spark.createDataFrame([(k, *map(float, v)) for k, v in zip(keys, x)] + [(-1, float("inf"), 0.0)], "id long, a double, b double")
    k = 6
    _, kd, lrd, lof = brute(x, keys, k)
    got = scored(frame, ["a", "b"], k, cell_rows)
    assert len(got) == len(x) + 1 and (got[-1].k_distance, got[-1].lrd, got[-1].lof) == (None, None, None)
    for i, key in enumerate(keys):
        assert (got[key].k_distance, got[key].lrd, got[key].lof) == pytest.approx((kd[i], lrd[i], lof[i]), rel=1e-9)


def test_no_table_of_pairs_is_written(spark, monkeypatch):
    """Every table that is written has at most a row for each row; before, one held k rows for each row."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 3))
    x[300:] = x[rng.integers(0, 300, 300)]
    frame = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double")
    sizes = []
    plain = N.materialize

    def counted(df):
        out = plain(df)
        sizes.append(out.count())
        return out

    for module in (N, local_factor):
        monkeypatch.setattr(module, "materialize", counted)
    got = scored(frame, list("abc"), 20, 100)
    assert len(sizes) == 4 and max(sizes) <= len(x)
    _, kd, _, lof = brute(x, range(600), 20)
    assert all((got[i].k_distance, got[i].lof) == pytest.approx((kd[i], lof[i]), rel=1e-9) for i in range(600))


def test_repeated_keys_and_one_place(spark):
    """Tables with a key on several rows, or none, go by key as before; one place for all rows is a place like others."""
    rows = [(1, 0.0), (2, 1.0), (3, 3.0), (3, 3.1), (None, 7.5)]
    frame = spark.createDataFrame(rows, "id long, a double")
    got = N.local_outlier_factor(frame, "id", ["a"], 1).collect()
    assert sorted(r.id or -1 for r in got) == [-1, 1, 2, 3, 3]
    assert {r.k_distance for r in got if r.id in (1, 2)} == {1.0} and {r.lof for r in got if r.id is None} == {None}
    alone = spark.createDataFrame([(i, 2.0) for i in range(30)], "id long, a double")
    assert [(r.id, r.k_distance, r.lof) for r in N.local_outlier_factor(alone, "id", ["a"], 4).orderBy("id").collect()] == [(i, 0.0, 1.0) for i in range(30)]


def test_blocks_find_what_all_pairs_find():
    """Queries and points of very different scales, with radii: the same pairs as by all distances."""
    rng = np.random.default_rng(8)
    points = np.vstack([rng.normal(size=(900, 4)), rng.normal(1e6, 1e3, size=(300, 4))])
    queries = np.vstack([points[::3], rng.normal(size=(100, 4)) * 50])
    d = np.sqrt(((queries[:, None] - points[None]) ** 2).sum(-1))
    radius = np.where(np.arange(len(queries)) % 2, np.inf, np.sort(d, 1)[:, 5])
    keys = rng.permutation(len(points))
    q, p, found = N._nearest_in(points, keys, queries, radius, 9)
    for i in range(len(queries)):
        want = [j for j in np.lexsort((keys, d[i])) if d[i, j] <= radius[i]][:9]
        assert list(p[q == i]) == want and np.array_equal(found[q == i], d[i, want])
    bound = N._nearest_in(points, keys, queries, radius, 9, distances_only=True)
    assert np.array_equal(bound, np.minimum(radius, np.sort(d, 1)[:, 8]))
