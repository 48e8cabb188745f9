import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillscope.operators import ranking


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 4000
    value = np.where(rng.random(n) < 0.35, 7.0, np.round(rng.gamma(2.0, 20.0, n), 1))
    group = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n))
    return pd.DataFrame({"id": rng.permutation(n).astype("int64"), "g": group.astype("int64"), "v": value})


def test_average_rank_and_quantiles(spark, frame):
    df = spark.createDataFrame(frame)
    dist = ranking.distribution(df, "v").withColumn("r", ranking.average_rank()).toPandas()
    expect = frame.assign(r=frame.v.rank()).drop_duplicates("v")[["v", "r"]]
    merged = dist.merge(expect, on="v", suffixes=("", "_e"))
    assert len(merged) == len(expect)
    assert np.allclose(merged.r, merged.r_e)
    q = ranking.column_quantiles(df, ["v"], [0.0, 0.1, 0.25, 0.5, 0.95, 1.0])["v"]
    assert np.allclose(q, frame.v.quantile([0.0, 0.1, 0.25, 0.5, 0.95, 1.0]))


def test_grouped_quantiles_with_a_hot_group(spark, frame):
    got = ranking.grouped_quantiles(spark.createDataFrame(frame), ["g"], "v", {"m": 0.5, "q": 0.9}).toPandas().set_index("g").sort_index()
    by = frame.groupby("g").v
    assert np.allclose(got.m, by.median()) and np.allclose(got.q, by.quantile(0.9))


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_in_order_with_heavy_values(spark, frame, groups):
    df = spark.createDataFrame(frame)
    got = ranking.in_order(df, "v", "id", groups, previous={"pv": "v", "pid": "id"}, size="size").toPandas().sort_values("id")
    s = frame.sort_values(groups + ["v", "id"])
    by = s.groupby("g") if groups else s.assign(o=0).groupby("o")
    expect = s.assign(p=by.cumcount() + 1, pv=by.v.shift(1), pid=by.id.shift(1), size=by.v.transform("size")).sort_values("id")
    assert (got.position.values == expect.p.values).all()
    assert (got["size"].values == expect["size"].values).all()
    assert np.allclose(got.pv.astype(float), expect.pv, equal_nan=True)
    assert np.allclose(got.pid.astype(float), expect.pid, equal_nan=True)


def test_null_group_keeps_its_rows(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, 1, 6.0), (3, 1, None)], "id long, g long, v double")
    got = {r.id: r.position for r in ranking.in_order(df, "v", "id", ["g"]).collect()}
    assert set(got) == {1, 2, 3} and got[1] is None and got[2] in (1, 2)


def test_count_below_is_exact_at_the_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (9.0,), (None,)], "v double")
    strict = {r.v: r.c for r in ranking.count_below(df, "v", [1.0, 2.0], "c").collect()}
    loose = {r.v: r.c for r in ranking.count_below(df, "v", [1.0, 2.0], "c", strict=False).collect()}
    assert strict == {0.0: 0, 1.0: 0, 1.5: 1, 2.0: 1, 9.0: 2, None: None}
    assert loose == {0.0: 0, 1.0: 1, 1.5: 1, 2.0: 2, 9.0: 2, None: None}


def test_lookup_spreads_hot_keys(spark, frame):
    df = spark.createDataFrame(frame)
    table = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"))
    out = ranking.lookup(df, table, ["g"], "n", len(frame), "id", hot_rows=50).toPandas()
    assert len(out) == len(frame)
    expect = frame.groupby("g").v.mean()
    assert np.allclose(out.m, out.g.map(expect))


@pytest.mark.parametrize("cells", [2048, 64])
def test_quantiles_of_skewed_and_tiny_columns(spark, frame, cells, monkeypatch):
    monkeypatch.setattr(ranking, "CELLS", cells)
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"u": rng.normal(size=5000), "heavy": np.where(rng.random(5000) < 0.6, 3.0, rng.integers(0, 9, 5000).astype(float)), "flat": 1.0})
    pdf["thin"] = np.concatenate((np.zeros(2300), np.full(2300, 1e6), rng.random(400) * 1e6))  # two heavy values with a thin part between
    if cells == 2048:
        pdf["wide"] = 10.0 ** rng.uniform(-250, 250, 5000) * rng.choice([-1, 1], 5000)
    pdf["tiny"] = rng.choice([0.0, 5e-324, 1e-323], 5000)
    probs = [0.0, 0.01, 0.2, 0.25, 0.5, 0.6, 0.95, 1.0]
    got = ranking.column_quantiles(spark.createDataFrame(pdf), list(pdf), probs)
    for c in pdf:
        assert np.allclose(got[c], pdf[c].quantile(probs)), c
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    if cells == 2048:
        ranking.column_quantiles(spark.createDataFrame(pdf[["u", "heavy", "flat", "thin"]]).repartition(3), ["u", "heavy", "flat", "thin"], probs)
        rounds = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before
        assert len(rounds) <= 12, len(rounds)  # a few rounds whatever the columns and levels; the adaptive plan takes a job for each exchange
    small = spark.createDataFrame([(1.0, None), (2.0, None), (10.0, None)], "a double, b double")
    assert ranking.column_quantiles(small, ["a", "b"], [0.25, 0.5]) == {"a": [1.5, 2.0], "b": [None, None]}


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([-0.0, 0.0, -0.0, 1.0, -1.0] * 20)], "id long, v double")
    d = ranking.distribution(df, "v").toPandas()
    assert len(d) == 3 and d.n.sum() == 100
    below = ranking.count_below(df, "v", [-0.0], "c").groupBy("v").agg(F.max("c").alias("hi"), F.min("c").alias("lo")).toPandas()
    assert (below.hi == below.lo).all()
