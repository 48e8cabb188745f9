"""What the ensemble reads for each row."""

import datetime as dt

import numpy as np
import pytest

from tillscope.operators import cleaning, detectors
from tillscope.plans import catalog_models


def test_random_features_equal_numpy():
    rng = np.random.default_rng(1)
    x, directions, phases = rng.normal(size=(700, 5)) * 30, rng.normal(size=(5, 16)), rng.uniform(0, 6.3, 16)
    got = np.vstack([z.copy() for z in detectors._cosine_features(x, directions, phases)])
    assert np.allclose(got, np.cos(x @ directions + phases), rtol=0, atol=1e-12)
    assert list(detectors._cosine_features(x[:0], directions, phases)) == []


def test_one_class_fit_equals_the_steps_on_one_machine(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 3))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double").repartition(5)
    scaler = cleaning.fit_scaler(df, ["a", "b", "c"], "standard")
    model = detectors.fit_one_class(df, ["a", "b", "c"], scaler, nu=0.1, features=32, steps=12)
    scaled = (x - [scaler.center[c] for c in "abc"]) / [scaler.scale[c] for c in "abc"]
    z = np.cos(scaled @ model.directions + model.phases) * np.sqrt(2 / 32)
    weights = z.mean(0)
    margin = weights @ weights
    for step in range(1, 13):
        hit = z @ weights < margin
        rate = 0.5 / step
        weights = weights - rate * (weights - z[hit].sum(0) / 90)
        margin = margin - rate * 0.1 * (hit.sum() / 90 - 1.0)
    assert np.allclose(model.weights, weights, atol=1e-10) and model.margin == pytest.approx(margin, abs=1e-10)
    got = {r.id: r.s for r in model.score(df, "s").collect()}
    assert np.allclose([got[i] for i in range(900)], z @ weights - margin, atol=1e-10)


def test_ensemble_joins_only_what_it_reads(spark, tmp_path, monkeypatch):
    """Before, all features of a row went through the join with its factor."""
    rng = np.random.default_rng(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=int(s)), int(u), "view", float(v), "{}") for i, (s, u, v) in enumerate(zip(rng.integers(0, 10**6, 300), rng.integers(0, 20, 300), rng.gamma(2, 30, 300)))]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    plain = detectors.fit_ensemble
    monkeypatch.setattr(detectors, "fit_ensemble", lambda df, *a: seen.append(df.columns) or plain(df, *a))
    got = catalog_models.q_ensemble(spark, str(tmp_path)).collect()
    assert seen == [["transaction_id", *catalog_models.INPUTS]]
    assert sorted(r.transaction_id for r in got) == list(range(300)) and {r.prediction for r in got} == {-1, 1}
