import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillscope.operators import arima, decomposition as dec, forecast_metrics as fm, series


def _frame(spark, **named):
    parts = [pd.DataFrame({"series_id": k, "ds": pd.date_range("2022-01-01", periods=len(v)), "y": v}) for k, v in named.items()]
    return spark.createDataFrame(pd.concat(parts))


@pytest.fixture(scope="module")
def noise():
    rng = np.random.default_rng(2)
    e = rng.normal(0, 1, 900)
    ar = np.zeros(900)
    for t in range(1, 900):
        ar[t] = 0.7 * ar[t - 1] + e[t]
    return 50 + ar, np.cumsum(e + 0.2), e


def test_arima_recovers_terms(spark, noise):
    df = _frame(spark, ar=noise[0], walk=noise[1])
    d = {r.series_id: r.d for r in arima.differencing_order(df, "series_id").collect()}
    assert d == {"ar": 0, "walk": 1}
    m = arima.fit(df.where("series_id = 'ar'"), order=(1, 0, 0)).first()
    assert m.ar[0] == pytest.approx(0.7, abs=0.07) and m.sigma2 == pytest.approx(1, abs=0.12)
    auto = arima.fit(df)
    f = arima.forecast(df, auto, 10).toPandas()
    assert len(f) == 20 and f.ds.min() == pd.Timestamp("2022-01-01") + pd.Timedelta(days=900)
    assert ((f.yhat_upper - f.yhat_lower) > 0).all()
    ar = f[f.series_id == "ar"].sort_values("ds")
    assert ar.yhat.iloc[-1] == pytest.approx(50, abs=1.5)
    g = arima.diagnostics(df, auto).toPandas().set_index("series_id")
    assert g.ljung_box_pvalue["ar"] > 0.01 and abs(g.residual_mean["ar"]) < 0.2
    b = arima.backtest(df, auto, folds=3, rows_per_fold=20)
    assert b.count() == 2 * 3 * 20 and arima.backtest_metrics(b).count() == 6
    assert arima.info(df, auto).count() == 2


def test_seasonal_lags_help(spark, noise):
    t = np.arange(400)
    y = 100 + 20 * np.sin(2 * np.pi * t / 7) + noise[2][:400]
    df = _frame(spark, s=y, short=y[:15])
    m = arima.fit(df, order=(1, 0, 0), period=7)
    got = {r.series_id: r for r in m.collect()}
    assert got["s"].period == 7
    f = arima.forecast(df, m.where("series_id = 's'"), 14).toPandas().sort_values("ds")
    expect = 100 + 20 * np.sin(2 * np.pi * np.arange(400, 414) / 7)
    assert np.abs(f.yhat - expect).mean() < 3


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_trend_and_season_are_recovered(spark, noise, mode):
    t = np.arange(800)
    trend = 100 + 0.1 * t
    week = 0.1 * np.sin(2 * np.pi * t / 7)
    y = trend * (1 + week) if mode == "multiplicative" else trend + 100 * week
    df = _frame(spark, a=y + noise[2][:800], b=2 * y)
    spec = dec.Spec(mode=mode, yearly=False)
    m = dec.fit(df, spec)
    f = dec.forecast(m, spec, 28).toPandas()
    a = f[f.series_id == "a"].sort_values("ds")
    s = np.arange(800, 828)
    truth = (100 + 0.1 * s) * (1 + 0.1 * np.sin(2 * np.pi * s / 7)) if mode == "multiplicative" else 100 + 0.1 * s + 10 * np.sin(2 * np.pi * s / 7)
    assert np.abs(a.yhat.to_numpy() / truth - 1).max() < 0.03
    assert ((a.yhat_lower < truth) & (truth < a.yhat_upper)).mean() > 0.9
    h = dec.history(df, m, spec)
    assert h.count() == 1600 and set(dec.components(h, spec)) == {"trend", "weekly"}
    assert dec.changepoints(m).count() == 50 and dec.diagnostics(m, spec).first().n_changepoints == 25
    b = dec.backtest(df, spec, initial_days=400, period_days=120, horizon_days=60)
    q = dec.backtest_metrics(b).toPandas().set_index("series_id")
    assert q.mape.max() < 5 and b.select("cutoff").distinct().count() == 3


def test_holidays_regressors_custom_season_and_logistic(spark, noise):
    t = np.arange(500)
    days = pd.date_range("2022-01-01", periods=500)
    promo = (t % 50 == 0).astype(float)
    level = np.where(days.strftime("%m-%d") == "12-25", 40.0, 0.0)
    pdf = pd.DataFrame({"series_id": "x", "ds": days, "y": 100 + 15 * promo + level + 5 * np.cos(2 * np.pi * t / 30.5) + 0.2 * noise[2][:500], "promo": promo})
    df = spark.createDataFrame(pdf)
    spec = dec.Spec(mode="additive", yearly=False, weekly=False, holidays={"xmas": ["2022-12-25"]}, regressors=("promo",)).with_season("monthly", 30.5, 2)
    m = dec.fit(df, spec)
    h = dec.history(df, m, spec).toPandas()
    assert np.abs(h.yhat - h.actual).mean() < 1.5 and h.holidays.max() > 20
    with pytest.raises(ValueError):
        dec.forecast(m, spec, 5)
    future = spark.createDataFrame(pd.DataFrame({"series_id": "x", "ds": pd.date_range("2023-06-01", periods=4), "promo": [0.0, 1.0, 0.0, 1.0]}))
    f = dec.forecast(m, spec, future=future).toPandas().sort_values("ds")
    assert f.yhat.iloc[1] - f.yhat.iloc[0] == pytest.approx(15, abs=3)
    grow = 200 / (1 + np.exp(-(t - 200) / 40))
    spec = dec.Spec(growth="logistic", mode="additive", yearly=False, weekly=False, cap=220.0)
    df = _frame(spark, g=grow)
    f = dec.forecast(dec.fit(df, spec), spec, 100).toPandas()
    assert f.yhat.max() <= 221 and f.yhat.min() > 180


def test_series_shaping(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01", 1.0), ("a", "2024-01-01", 2.0), ("a", "2024-01-04", 9.0), ("b", "2024-01-02", 5.0), ("b", "2024-01-03", None)], "series_id string, date string, v double"
    )
    zero = series.prepare(df, "date", "v", ["series_id"]).toPandas()
    assert zero[zero.series_id == "a"].sort_values("ds").v.tolist() == [3, 0, 0, 9] and len(zero) == 6
    line = series.prepare(df, "date", "v", ["series_id"], freq="D", fill="interpolate").toPandas()
    assert line[line.series_id == "a"].sort_values("ds").v.tolist() == [3, 5, 7, 9]
    back = series.prepare(df, "date", "v", ["series_id"], freq="D", fill="bfill").toPandas()
    assert back[back.series_id == "a"].sort_values("ds").v.tolist() == [3, 9, 9, 9]
    assert series.infer_frequency(spark.createDataFrame([("2024-01-01",), ("2024-01-08",), ("2024-01-15",)], "ds string")) == "W"
    with pytest.raises(ValueError):
        series.prepare(df, "date", "v", ["series_id"], fill="magic")
    with pytest.raises(ValueError):
        series.roll_up(df, "date", ["v"], aggregate="nope")


def test_rolling_blocks_equal_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": "a", "ds": pd.date_range("2024-01-01", periods=120), "v": rng.normal(size=120)})
    got = series.rolling_features(spark.createDataFrame(pdf), "v", [3, 10], "ds", ["mean", "std"], ["k"], block=20).toPandas().sort_values("ds")
    assert len(got) == 120
    for w in (3, 10):
        assert np.allclose(got[f"v_rolling_{w}_mean"], pdf.v.rolling(w, min_periods=1).mean())
        assert np.allclose(got[f"v_rolling_{w}_std"].astype(float), pdf.v.rolling(w, min_periods=1).std(), equal_nan=True)


def test_forecast_edge_cases(spark):
    df = spark.createDataFrame([("z", "2024-01-01", 0.0, 1.0), ("z", "2024-01-02", 0.0, 0.0), ("c", "2024-01-01", 5.0, 5.0), ("c", "2024-01-02", 5.0, 5.0)], "s string, ds string, actual double, predicted double")
    m = {r.s: r for r in fm.forecast_metrics(df, ["s"]).collect()}
    assert m["z"].mape is None and m["z"].coverage_10pct == 0 and m["c"].r2 == 1.0 and m["z"].r2 == 0.0
    assert m["c"].mase is None and m["c"].tracking_signal is None


def test_every_series_has_a_model_and_a_forecast(spark):
    """Short, constant, gappy and empty series fall back instead of vanishing."""
    rng = np.random.default_rng(4)
    day = datetime.datetime(2024, 1, 1)
    rows = [("long", day + datetime.timedelta(days=i), float(v)) for i, v in enumerate(rng.normal(size=100).cumsum())]
    rows += [("gaps", day + datetime.timedelta(days=i), None if i % 9 == 0 else float(i % 7) + rng.normal()) for i in range(80)]
    rows += [("short", day + datetime.timedelta(days=i), float(i)) for i in range(5)]
    rows += [("one", day, 3.0), ("none", day, None), ("none", day + datetime.timedelta(days=1), None)]
    df = spark.createDataFrame(rows, "series_id string, ds timestamp, y double")
    model = arima.fit(df)
    status = {r.series_id: r.status for r in model.collect()}
    assert status == {"long": "fitted", "gaps": "fitted", "short": "mean", "one": "mean", "none": "mean"}
    ahead = arima.forecast(df, model, 3).toPandas()
    assert ahead.groupby("series_id").size().to_dict() == dict.fromkeys(status, 3) and ahead.yhat.notna().all()
    assert (ahead[ahead.series_id == "short"].yhat == 2.0).all()
    folds = arima.backtest(df, model, folds=2, rows_per_fold=20).toPandas()
    assert set(folds.series_id) == {"long", "gaps", "short", "none"} and folds.predicted.notna().all()
    assert set(arima.fit(df, period=7).toPandas().series_id) == set(status)


def test_series_are_fitted_and_forecast_in_batches(spark):
    rng = np.random.default_rng(8)
    rows = [(k, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=i), float(v)) for k in range(6) for i, v in enumerate(rng.normal(size=20 + 9 * k).cumsum())]
    rows = [(k, t, None if i % 17 == 4 else v) for i, (k, t, v) in enumerate(rows)] + [(None, rows[0][1], 1.0), (2, None, 5.0)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "series_id long, ds timestamp, y double")
    model = arima.fit(df, order=(1, 0, 1))
    ahead = arima.forecast(df, model, 3)
    for frame in (model, ahead):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" in plan and "FlatMapGroups" not in plan
    fits = model.where("series_id is not null").toPandas().set_index("series_id")
    got = ahead.toPandas().sort_values(["series_id", "ds"])
    assert len(got) == 18 and set(fits.status) == {"fitted"}
    for k in range(6):
        mine = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1] is None, r[1] or datetime.datetime.min))
        y = arima._filled(np.array([r[2] for r in mine], dtype="float64"))
        want = arima._fit(y, (1, 0, 1, 0, 0, 0, 1))
        assert np.allclose([fits.const[k], *fits.ar[k], *fits.ma[k]], [want["const"], *want["ar"], *want["ma"]])
        mean, half = arima._ahead(y, want["const"], np.array(want["ar"]), np.array(want["ma"]), want["sigma2"], 3, 0.95)
        mine_ahead = got[got.series_id == k]
        assert np.allclose(mine_ahead.yhat, mean) and np.allclose(mine_ahead.yhat_upper, mean + half)
        last = max(r[1] for r in mine if r[1] is not None)
        assert list(mine_ahead.ds) == [last + datetime.timedelta(days=h) for h in (1, 2, 3)]
