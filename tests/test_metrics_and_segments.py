import numpy as np
import pandas as pd
import pytest

from tillscope.functions import tails
from tillscope.operators import detector_metrics as dm, distributions, segments
from pyspark.sql import functions as F


def test_counts_and_label_codes(spark):
    rows = [(-1, -1), (-1, 1), (1, 1), (1, 1), (1, -1)]
    r = dm.evaluate(spark.createDataFrame(rows, "y long, pred long")).first()
    assert (r.true_positives, r.false_positives, r.false_negatives, r.true_negatives) == (1, 1, 1, 2)
    assert r.total_samples == 5 and r.accuracy == 0.6
    none = dm.evaluate(spark.createDataFrame([(0, 0), (0, 0)], "y long, pred long").withColumn("score", F.lit(1.0)), score="score").first()
    assert none.precision == 0 and none.auc_roc is None and none.avg_precision is None


def test_areas_and_direction(spark):
    rng = np.random.default_rng(4)
    y = (rng.random(500) < 0.2).astype(int)
    s = np.round(rng.normal(size=500) - y, 1)  # low scores mean fraud: the direction is turned
    df = spark.createDataFrame(pd.DataFrame({"y": y, "score": s}))
    pos, neg = -s[y == 1], -s[y == 0]
    auc = ((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None])).mean()
    r = dm.area_metrics(df).first()
    assert r.auc_roc == pytest.approx(auc)
    order = np.unique(-s)[::-1]
    ap, seen = 0.0, 0.0
    for t in order:
        flagged = -s >= t
        recall = (y[flagged]).sum() / y.sum()
        ap += (recall - seen) * y[flagged].mean()
        seen = recall
    assert r.avg_precision == pytest.approx(ap)
    roc = dm.roc_points(df, drop_collinear=False).orderBy("fpr", "tpr").toPandas()
    assert np.trapezoid(roc.tpr, roc.fpr) == pytest.approx(auc)
    short = dm.roc_points(df).orderBy("fpr", "tpr").toPandas()
    assert len(short) <= len(roc) and np.trapezoid(short.tpr, short.fpr) == pytest.approx(auc)


def test_sweep_equals_a_loop(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"y": (rng.random(300) < 0.3).astype(int), "score": np.round(rng.random(300), 2), "amount": rng.random(300) * 100})
    df = spark.createDataFrame(pdf)
    for direction in ("higher", "lower"):
        got = dm.threshold_metrics(df, steps=21, direction=direction).orderBy("step").toPandas()
        for i, t in enumerate(np.linspace(pdf.score.min(), pdf.score.max(), 21)):
            hit = pdf.score > t if direction == "higher" else pdf.score < t
            assert got.flagged_rate[i] == pytest.approx(hit.mean())
            assert got.recall[i] == pytest.approx(pdf.y[hit].sum() / pdf.y.sum())
    best = dm.best_business_threshold(df, steps=21).first()
    savings = [pdf.amount[(pdf.score > t) & (pdf.y == 1)].sum() - 10 * (pdf.score > t).sum() for t in np.linspace(pdf.score.min(), pdf.score.max(), 21)]
    assert best.net_savings == pytest.approx(max(savings)) and best.step == int(np.argmax(savings))
    with pytest.raises(ValueError):
        dm.best_threshold(df, "accuracy")


def test_tails(spark):
    df = spark.createDataFrame([(3.841458820694124, 1.0), (18.307038053275146, 10.0), (124.34211340400407, 100.0), (0.0, 3.0)], "x double, k double")
    p = df.select(tails.chi2_upper("x", "k").alias("p")).toPandas().p
    assert np.allclose(p, [0.05, 0.05, 0.05, 1.0], atol=1e-9)
    z = spark.createDataFrame([(1.959963984540054,)], "z double")
    assert z.select(tails.normal_two_sided("z").alias("p")).first().p == pytest.approx(0.05)
    assert df.where("k = 10").select(tails.chi2_upper_even(F.col("x"), 10).alias("p")).first().p == pytest.approx(0.05)


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(8)
    n = 600
    seg = np.where(rng.random(n) < 0.4, "a", np.where(rng.random(n) < 0.5, "b", "c"))
    x = np.round(rng.normal(0, 1, n) + (seg == "b") * 1.0, 1)
    return pd.DataFrame({"segment": seg, "x": x, "flat": 2.0})


def test_kruskal_and_drivers(spark, groups):
    df = spark.createDataFrame(groups)
    r = groups.x.rank()
    n = len(groups)
    h = 12 / (n * (n + 1)) * sum(r[groups.segment == s].sum() ** 2 / (groups.segment == s).sum() for s in "abc") - 3 * (n + 1)
    ties = groups.x.value_counts()
    h /= 1 - (ties**3 - ties).sum() / (n**3 - n)
    got = {k.feature: k for k in segments.kruskal_wallis(df, "segment", ["x", "flat"]).collect()}
    assert got["x"].kruskal_h_statistic == pytest.approx(h) and got["x"].significant
    assert got["flat"].kruskal_h_statistic is None
    d = {k.feature: k for k in segments.segment_drivers(df, "segment", ["x", "flat"], "b").collect()}
    a, b = groups.x[groups.segment == "b"], groups.x[groups.segment != "b"]
    u = ((a.values[:, None] > b.values[None]) + 0.5 * (a.values[:, None] == b.values[None])).sum()
    assert d["x"].u_statistic == pytest.approx(u) and d["x"].p_value < 1e-6 and d["flat"].effect_size == 0
    assert d["x"].effect_size == pytest.approx((a.mean() - b.mean()) / np.sqrt((a.var() + b.var()) / 2))


def test_overlap_statistics_and_sizes(spark, groups):
    df = spark.createDataFrame(groups)
    got = {(r.segment_a, r.segment_b): r.overlap for r in segments.segment_overlap(df, "segment", ["x"]).collect()}
    a, b = groups.x[groups.segment == "a"], groups.x[groups.segment == "b"]
    edges = np.linspace(min(a.min(), b.min()), max(a.max(), b.max()), 50)
    p, q = np.histogram(a, edges)[0], np.histogram(b, edges)[0]
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.sqrt(p / p.sum() * q / q.sum()).sum(), abs=0.02)
    assert got["c", "c"] == 1.0 and len(got) == 9
    stats = {r.segment: r for r in segments.segment_statistics(df, "segment", ["x"]).collect()}
    for s in "abc":
        v = groups.x[groups.segment == s]
        assert stats[s].skewness == pytest.approx(v.skew()) and stats[s].kurtosis == pytest.approx(v.kurt()) and stats[s].q75 == pytest.approx(v.quantile(0.75))
    sizes = segments.segment_sizes(df, "segment").toPandas().sort_values("count", ascending=False)
    assert sizes.cumulative_pct.iloc[-1] == pytest.approx(100)
    tiny = segments.segment_statistics(spark.createDataFrame([("a", 1.0), ("a", 2.0)], "segment string, x double"), "segment", ["x"]).first()
    assert tiny.skewness is None and tiny.kurtosis is None
    assert set(segments.analyze(df, "segment", ["x"])) == {"segment_sizes", "segment_statistics", "statistical_tests", "feature_importance", "summary"}


def test_drift_and_histogram(spark):
    rng = np.random.default_rng(3)
    a, b = np.round(rng.normal(0, 1, 800), 2), np.round(rng.normal(0.4, 1, 500), 2)
    left, right = (spark.createDataFrame(pd.DataFrame({"v": v, "same": 1.0})) for v in (a, b))
    got = {r.feature: r for r in distributions.data_drift(left, right).collect()}
    grid = np.unique(np.r_[a, b])
    d = np.abs(np.searchsorted(np.sort(a), grid, "right") / 800 - np.searchsorted(np.sort(b), grid, "right") / 500).max()
    assert got["v"].ks_statistic == pytest.approx(d) and got["v"].is_drifted
    assert got["same"].ks_statistic == 0 and got["same"].p_value == 1.0 and not got["same"].is_drifted
    h = distributions.histogram(left, "v", 10).orderBy("bin").toPandas()
    assert h["count"].sum() == 800 and len(h) == 10
    assert distributions.histogram(left, "same", 5).agg(F.sum("count")).first()[0] == 800
