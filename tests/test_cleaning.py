import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillscope.operators import cleaning, quality, rfm
from tillscope.sources import readers, sinks


def test_clean_chain(spark):
    rows = [(i, float(i) if i % 25 else None, None, "x") for i in range(1, 101)] + [(7, 7.0, None, "x")]
    df = spark.createDataFrame(rows, "`Order Id` long, `Price ($)` double, empty double, name string")
    out = cleaning.clean(df)
    assert out.columns == ["order_id", "price_", "name"] and out.count() == 100
    p = out.toPandas()
    values = [i for i in range(1, 101) if i % 25]
    assert np.isclose(p[p.order_id == 25].price_.iloc[0], np.median(values))
    with pytest.raises(ValueError):
        cleaning.standard_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_sparse_limit(spark):
    rows = [(None if i < k else 1.0 * i, i) for k in (50,) for i in range(1000)]
    exactly_five = spark.createDataFrame(rows, "v double, i long")
    assert cleaning.clean(exactly_five).where("v is null").count() == 50
    under = exactly_five.withColumn("v", F.when(F.col("i") >= 49, F.coalesce("v", F.lit(1.0))))
    assert cleaning.clean(under).where("v is null").count() == 0


@pytest.mark.parametrize("method", ["zscore", "iqr", "percentile"])
@pytest.mark.parametrize("treatment", ["clip", "remove", "nan"])
def test_outliers(spark, method, treatment):
    rng = np.random.default_rng(1)
    x = np.append(rng.normal(50, 5, 500), [500.0, -300.0])
    pdf = pd.DataFrame({"i": range(len(x)), "v": x})
    out = cleaning.handle_outliers(spark.createDataFrame(pdf), ["v"], method, 3.0, treatment).toPandas()
    if method == "zscore":
        bad = np.abs((x - x.mean()) / x.std()) > 3
        lo, hi = x[~bad].min(), x[~bad].max()
    elif method == "iqr":
        a, b = np.percentile(x, [25, 75])
        lo, hi = a - 3 * (b - a), b + 3 * (b - a)
        bad = (x < lo) | (x > hi)
    else:
        a, b = np.percentile(x, [1, 99])
        bad = (x < a) | (x > b)
        lo, hi = x[~bad].min(), x[~bad].max()
    if treatment == "clip":
        assert np.allclose(out.sort_values("i").v, np.clip(x, lo, hi))
    elif treatment == "remove":
        assert sorted(out.i) == list(np.flatnonzero(~bad))
    else:
        assert out.sort_values("i").v.isna().values.tolist() == bad.tolist()


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_scaling_round_trip(spark, method):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 10.0], "c": [5.0] * 4})
    df = spark.createDataFrame(pdf)
    s = cleaning.fit_scaler(df, ["a", "c"], method)
    out = s.apply(df).toPandas()
    a = pdf.a.to_numpy()
    expect = {"standard": (a - a.mean()) / a.std(), "minmax": (a - 1) / 9, "robust": (a - 2.5) / (np.percentile(a, 75) - np.percentile(a, 25))}
    assert np.allclose(out.a, expect[method]) and np.allclose(out.c, 0)
    assert np.allclose(s.invert(s.apply(df)).toPandas().a, a)


def test_impute_and_encode(spark):
    df = spark.createDataFrame([(1, 1.0, "b"), (2, None, "a"), (3, 4.0, None), (4, 1.0, "b"), (5, 6.0, "a")], "i long, v double, s string")
    fill = cleaning.fit_impute(df, "median", columns=["v", "s"])
    assert fill == {"v": 2.5, "s": "a"}
    codes = {r.i: r.s for r in cleaning.encode(cleaning.impute(df, fill), ["s"], "label", tie="i").collect()}
    assert codes == {1: 1, 2: 0, 3: 0, 4: 1, 5: 0}
    hot = cleaning.encode(cleaning.impute(df, fill), ["s"], "onehot").toPandas()
    assert "s_a" not in hot and hot.sort_values("i").s_b.tolist() == [1, 0, 0, 1, 0]
    with pytest.raises(ValueError):
        cleaning.encode(df, ["s"], "target")


def test_nearest_neighbour_filling(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 10.0), (3, 1.2, None), (4, 9.0, 50.0), (5, None, 49.0)], "i long, a double, b double")
    out = cleaning.impute_nearest(df, ["a", "b"], neighbours=1).toPandas().set_index("i")
    assert out.b[3] == 10.0 and out.a[5] == 9.0
    with pytest.raises(ValueError):
        cleaning.impute_nearest(df, ["a", "b"], max_donors=2)


def test_quality(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1.0, "ab"[i % 2]) for i in range(40)], "i long, v double, s string")
    report = {r["column"]: r for r in quality.validation_report(df).collect()}
    assert report["v"].nulls == 20 and report["v"].too_many_nulls and report["v"].enough_rows
    assert quality.validate(df) and quality.schema_problems(df, "sales") == ["missing column date", "missing column sales"]
    with pytest.raises(ValueError):
        quality.validate(df, ["nope"])
    with pytest.raises(ValueError):
        quality.merge(df, df.unionAll(df), "i", validate="one_to_one")
    assert quality.merge(df, df.select("i"), "i", validate="1:1").count() == 40
    top = quality.text_summary(df, ["s"]).collect()
    assert [(r.value, r["count"], r.distinct_values) for r in sorted(top, key=lambda r: r.place)] == [("a", 20, 2), ("b", 20, 2)]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-05", 2.5), (2, "2024-01-06", float("nan"))], "id long, day string, v double")
    sinks.write_rows(df, str(tmp_path / "r.csv"))
    back = readers.load(spark, str(tmp_path / "r.csv"))
    assert dict(back.dtypes)["day"] in ("timestamp", "date") and back.count() == 2
    sinks.write_summary(df, str(tmp_path / "s.json"))
    assert {r.id: r.v for r in readers.load(spark, str(tmp_path / "s.json")).collect()} == {1: 2.5, 2: None}
    sinks.save_model({"t": df}, str(tmp_path / "m"))
    assert sinks.load_model(spark, str(tmp_path / "m"), ["t"])["t"].count() == 2
    with pytest.raises(ValueError):
        readers.load(spark, "x.xlsx")
    assert readers.rename(df, {"key": "id"}).columns == ["key", "day", "v"]


def test_rfm_small_cases(spark):
    rows = [(1, 1, "2024-01-01", 10.0), (2, 1, "2024-01-01", 30.0), (3, 2, "2024-01-10", 5.0), (4, 3, "2024-01-05", 5.0), (5, 3, "2024-01-09", 8.0), (6, 3, "2024-01-10", 11.0)]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id long, date string, amount double")
    table = rfm.rfm(df)
    got = {r.customer_id: (r.recency, r.frequency, r.monetary) for r in table.collect()}
    assert got == {1: (10, 2, 40.0), 2: (1, 1, 5.0), 3: (1, 3, 24.0)}
    scored = rfm.rfm_segments(rfm.rfm_scores(table)).toPandas().set_index("customer_id")
    assert scored.f_score.to_dict() == {2: 1, 1: 3, 3: 5}
    f = rfm.rfm_features(table, df).toPandas().set_index("customer_id")
    assert np.isclose(f.spending_trend[3], 3.0) and np.isclose(f.spending_trend[1], 20.0) and f.spending_trend[2] == 0
    assert f.avg_days_between[3] == 2.5 and np.isnan(f.avg_days_between[2]) and f.amount_std[2] == 0
    assert f.amount_median[3] == 8.0 and f.min_days_between[1] == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 23, 100])
def test_position_score_equals_quantile_cut(spark, n):
    pdf = pd.DataFrame({"customer_id": np.arange(n), "v": np.arange(n)[::-1] // 3})
    got = rfm._position_score(spark.createDataFrame(pdf), "v", "customer_id", 5, "s").toPandas().sort_values("customer_id").s
    expect = pd.qcut(pdf.v.rank(method="first"), 5, labels=False, duplicates="drop") + 1 if n > 1 else pd.Series([1])
    assert got.tolist() == expect.tolist()
