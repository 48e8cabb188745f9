import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillscope.operators import clustering, detectors, forest
from tillscope.sources import sinks


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    return pd.DataFrame({"id": range(180), "a": x[:, 0], "b": x[:, 1], "true": np.repeat([0, 1, 2], 60)})


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (2000, 3))
    x[:20] += rng.choice([-1, 1], (20, 3)) * 9
    return pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(2000), y=(np.arange(2000) < 20).astype(int))


def test_clusters_and_choice_of_k(spark, blobs, tmp_path):
    df = spark.createDataFrame(blobs)
    m = clustering.fit(df, ["a", "b"], k_range=(2, 5), restarts=3)
    assert m.k == 3 and m.selection_table(spark).count() == 4
    got = m.assign(df).toPandas()
    assert got.groupby("true").cluster.nunique().max() == 1 and got.cluster.nunique() == 3
    q = clustering.quality(m, df).first()
    assert q.silhouette_squared > 0.9 and q.davies_bouldin < 0.3 and q.calinski_harabasz > 500
    centers = m.centers(spark).toPandas()
    assert np.allclose(sorted(centers.a), sorted(blobs.groupby("true").a.mean()), atol=1e-6)
    clustering.save(m, spark, str(tmp_path / "m"))
    again = clustering.load(spark, str(tmp_path / "m")).assign(df).toPandas()
    assert (again.sort_values("id").cluster.values == got.sort_values("id").cluster.values).all()
    p = clustering.project(m, df).toPandas().sort_values("id")
    scaled = (blobs[["a", "b"]] - blobs[["a", "b"]].mean()) / blobs[["a", "b"]].std(ddof=0)
    assert np.isclose(p.PC1.var(), np.linalg.eigvalsh(np.cov(scaled.T))[-1])


def test_elbow():
    assert clustering.elbow([(2, 100.0), (3, 30.0), (4, 25.0), (5, 21.0)]) == 3


def test_forest_finds_planted_rows_and_round_trips(spark, planted, tmp_path):
    df = spark.createDataFrame(planted)
    flagged, model = forest.detect(df, ["a", "b", "c"], "id", trees=50)
    got = flagged.toPandas()
    assert got.is_flagged.sum() == 20 and got[got.is_flagged].y.sum() >= 18
    assert got.fraud_probability.between(0, 1).all() and got.risk_level[got.fraud_probability == 1].eq("Critical").all()
    assert got.risk_level[got.fraud_probability == 0].isna().all()
    again, _ = forest.detect(df.repartition(5), ["a", "b", "c"], "id", trees=50)
    assert np.allclose(got.sort_values("id").anomaly_score, again.toPandas().sort_values("id").anomaly_score)
    sinks.save_model(model.tables(spark), str(tmp_path / "f"))
    back = forest.Forest.from_tables(sinks.load_model(spark, str(tmp_path / "f"), ["nodes", "columns", "figures"]))
    same = forest.flag(back.score(df), back).toPandas()
    assert np.allclose(same.sort_values("id").anomaly_score, got.sort_values("id").anomaly_score)
    assert model.info(spark).first().n_estimators == 50
    assert forest.top_flagged(flagged, "id", 5).count() == 5
    lines = [r.line for r in forest.advice(flagged).collect()]
    assert any(s.startswith("scores_close") for s in lines) and lines[-1] == "compare_with_ensemble"


def test_permutation_importance_prefers_the_telling_column(spark, planted):
    df = spark.createDataFrame(planted.assign(flat=1.0))
    m = forest.fit(df, ["a", "flat"], "id", trees=20)
    rows = {r.feature: r.importance for r in forest.importance(m, df, "id").collect()}
    assert rows["a"] == pytest.approx(1.0) and rows["flat"] == 0


@pytest.mark.parametrize("voting", ["soft", "hard"])
def test_ensemble(spark, planted, voting):
    df = spark.createDataFrame(planted)
    e = detectors.fit_ensemble(df, ["a", "b", "c"], "id", ("isolation_forest", "lof", "ocsvm"))
    got = detectors.vote(e.decisions(df), list(e.models), e.ranges, voting).toPandas()
    for name in e.models:
        worst = got.nsmallest(20, f"_d_{name}")
        assert worst.y.sum() >= 15, name
    if voting == "hard":
        assert got[got.prediction == -1].y.mean() > 0.6


def test_ensemble_scores_its_training_rows_once(spark, planted, monkeypatch):
    df = spark.createDataFrame(planted)
    calls = []
    plain = detectors.ExactLocalFactor.score
    monkeypatch.setattr(detectors.ExactLocalFactor, "score", lambda self, *a: calls.append(1) or plain(self, *a))
    e = detectors.fit_ensemble(df, ["a", "b", "c"], "id", ("lof", "ocsvm"))
    own = {r.id: (r._d_lof, r._d_ocsvm) for r in e.decisions(df).collect()}
    assert calls == [1]
    again = {r.id: (r._d_lof, r._d_ocsvm) for r in e.decisions(df.select("*")).collect()}
    assert calls == [1, 1] and own.keys() == again.keys()
    assert all(own[i] == pytest.approx(again[i]) for i in own)


def test_vote_rules(spark):
    df = spark.createDataFrame([(1, -1.0, 1.0), (2, 1.0, 1.0), (3, -1.0, -1.0)], "id long, _d_a double, _d_b double")
    hard = {r.id: (r.prediction, r.confidence) for r in detectors.vote(df, ["a", "b"], voting="hard").collect()}
    assert hard == {1: (-1, 0.0), 2: (1, 1.0), 3: (-1, 1.0)}
    soft = {r.id: r.prediction for r in detectors.vote(df, ["a", "b"]).collect()}
    assert soft[2] == 1 and soft[3] == -1


def test_scores_equal_a_walk_down_every_tree(spark):
    rng = np.random.default_rng(3)
    x = pd.DataFrame(rng.normal(size=(600, 30)).round(1), columns=[f"c{i}" for i in range(30)]).assign(id=range(600), whole=range(600))
    x.loc[5, "c1"], x.loc[6, "c2"], x.loc[7, "c3"] = np.nan, np.inf, -np.inf
    df = spark.createDataFrame(x)
    names = [c for c in x.columns if c != "id"]
    model = forest.fit(df, names, "id", trees=7, tree_rows=64)
    clean = x[names].where(np.isfinite(x[names]), 0.0)
    assert np.allclose([model.scaler.center[c] for c in names], clean.mean()) and np.allclose([model.scaler.scale[c] for c in names], clean.std(ddof=0))
    scaled = ((clean - pd.Series(model.scaler.center)) / pd.Series(model.scaler.scale))[names].to_numpy()
    lengths = np.zeros(len(x))
    for _, t in model.nodes.groupby("tree"):
        t = t.set_index("node")
        for i, row in enumerate(scaled):
            n = t.loc[0]
            while n.feature >= 0:
                n = t.loc[n.left if row[int(n.feature)] <= n.split else n.right]
            lengths[i] += n.depth + forest.expected_path(n["size"])
    want = -np.exp2(-lengths / 7 / forest.expected_path(64))
    got = model.score(df).toPandas().sort_values("id").raw_score
    assert np.allclose(got, want, rtol=1e-12, atol=0)
    packed = [forest._packed(t) for _, t in model.nodes.groupby("tree")]
    assert all(len(ends) == 2 ** (deepest + 1) - 1 for *_, ends, deepest in packed)
