import numpy as np
import pandas as pd
import pytest

from tillscope.operators import trailing, txn_features as tf


@pytest.fixture(scope="module")
def txns():
    rng = np.random.default_rng(5)
    n = 900
    cust = np.where(rng.random(n) < 0.4, 1, rng.integers(2, 12, n))
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 12 * 24 * 60, n) * 60, unit="s")
    amount = np.round(rng.gamma(2, 30, n), 2)
    amount[:6] = [16.99, 17.99, 10.0, 0.0, 10.0, 20.0]
    # rows exactly one window apart, and two at the same moment
    ts = pd.Series(ts)
    ts[1] = ts[0] + pd.Timedelta(hours=1)
    ts[2] = ts[0] + pd.Timedelta(hours=24)
    ts[3] = ts[0]
    cust[:4] = 1
    return pd.DataFrame({"transaction_id": np.arange(n), "customer_id": cust.astype("int64"), "timestamp": ts, "amount": amount})


def brute(df):
    rows = []
    for r in df.itertuples():
        mine = df[df.customer_id == r.customer_id]
        out = {"transaction_id": r.transaction_id}
        for w in (1, 6, 24, 168):
            x = mine[(mine.timestamp > r.timestamp - pd.Timedelta(hours=w)) & (mine.timestamp <= r.timestamp)].amount
            out |= {f"n{w}": len(x), f"s{w}": x.sum(), f"lo{w}": x.min(), f"hi{w}": x.max(), f"sd{w}": x.std() if len(x) > 1 else 0.0}
        before = mine[(mine.timestamp < r.timestamp) | ((mine.timestamp == r.timestamp) & (mine.transaction_id < r.transaction_id))]
        last = before.sort_values(["timestamp", "transaction_id"]).tail(1)
        out["gap"] = (r.timestamp - last.timestamp.iloc[0]).total_seconds() / 3600 if len(last) else 0.0
        out["chg"] = r.amount - last.amount.iloc[0] if len(last) else 0.0
        rows.append(out)
    return pd.DataFrame(rows).set_index("transaction_id").sort_index()


@pytest.mark.parametrize("cell_rows", [5_000_000, 10])
def test_windows_match_brute_force(spark, txns, cell_rows, monkeypatch):
    monkeypatch.setattr(trailing.choose_cell, "__defaults__", (cell_rows,))
    df = spark.createDataFrame(txns)
    got = tf.with_history(df, tf.fit_amounts(df)).toPandas().set_index("transaction_id").sort_index()
    e = brute(txns)
    assert len(got) == len(txns)
    for w in (1, 6, 24):
        assert (got[f"txn_count_{w}h"] == e[f"n{w}"]).all()
        assert np.allclose(got[f"amount_sum_{w}h"], e[f"s{w}"])
    for w in (1, 24, 168):
        assert (got[f"count_{w}h"] == e[f"n{w}"]).all()
        assert np.allclose(got[f"amount_mean_{w}h"], e[f"s{w}"] / e[f"n{w}"])
        assert np.allclose(got[f"amount_std_{w}h"], e[f"sd{w}"], atol=1e-6)
        assert np.allclose(got[f"amount_min_{w}h"], e[f"lo{w}"]) and np.allclose(got[f"amount_max_{w}h"], e[f"hi{w}"])
    assert np.allclose(got.hours_since_last, e.gap) and np.allclose(got.amount_change, e.chg)
    by = txns.groupby("customer_id").amount
    ids = txns.set_index("transaction_id").customer_id
    assert np.allclose(got.cust_amount_std, ids.map(by.std())) and (got.cust_transaction_count == ids.map(by.count())).all()


def test_cell_shrinks_for_a_busy_key(spark, txns):
    df = spark.createDataFrame(txns)
    wide = trailing.choose_cell(df, "customer_id", "timestamp", [1, 24], len(txns))
    narrow = trailing.choose_cell(df, "customer_id", "timestamp", [1, 24], len(txns), cell_rows=2)
    assert wide == 3_600_000_000 and 0 < narrow < wide and wide % narrow == 0


def test_whole_feature_set(spark, txns):
    df = spark.createDataFrame(txns.assign(category=np.where(txns.transaction_id == 7, "odd", "usual")))
    got = tf.transaction_features(df, categorical=["category"]).toPandas().set_index("transaction_id").sort_index()
    assert set(tf.feature_names()) <= set(got.columns) and len(got) == len(txns)
    assert list(got.amount_cents[:4]) == [99, 99, 0, 0] and list(got.ends_in_99[:2]) == [1, 1]
    assert list(got.is_round_amount[2:6]) == [1, 1, 1, 1]
    t = txns.set_index("transaction_id")
    assert np.allclose(got.amount_percentile, t.amount.rank(pct=True))
    assert np.allclose(got.amount_percentile_customer, t.groupby("customer_id").amount.rank(pct=True))
    bins = pd.qcut(t.amount, 10, labels=False, duplicates="drop")
    assert (got.amount_bin.astype(int) == bins).all()
    assert got.category_is_rare.sum() == 1 and np.isclose(got.category_freq[0], 899 / 900)


def test_baselines(spark, txns):
    df = spark.createDataFrame(txns)
    base = tf.customer_baselines(df)
    b = base.toPandas().set_index("customer_id").sort_index()
    assert np.allclose(b.baseline_median, txns.groupby("customer_id").amount.median())
    hours = txns.assign(h=txns.timestamp.dt.hour).groupby("customer_id").h.agg(lambda s: s.mode().iloc[0])
    assert (b.typical_hour == hours).all()
    out = tf.baseline_deviations(df, base, len(txns)).toPandas()
    m = txns.customer_id.map(txns.groupby("customer_id").amount.mean())
    s = txns.customer_id.map(txns.groupby("customer_id").amount.std())
    assert out.exceeds_baseline.sum() == (((txns.amount - m) / (s + 1)).abs() > 3).sum()


@pytest.mark.parametrize("key_rows", [40, 500])
def test_small_customers_need_no_copies_of_rows(spark, txns, key_rows):
    rows = txns.assign(customer_id=txns.customer_id.astype("Int64").where(txns.transaction_id != 9), timestamp=txns.timestamp.where(txns.transaction_id != 11))
    rows = pd.concat([rows, rows[rows.transaction_id % 50 == 3]])  # repeated rows
    plain = [tuple(None if pd.isna(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r) for r in rows.astype(object).itertuples(index=False)]
    df = spark.createDataFrame(plain, "transaction_id long, customer_id long, timestamp timestamp, amount double")
    busy = trailing.busy_keys(df, "customer_id", "timestamp", len(rows), key_rows)
    sizes, untimed = rows.customer_id.value_counts(), rows.customer_id[rows.transaction_id == 11].iloc[0]
    assert {r[0] for r in busy.collect()} == {None, untimed, *sizes[sizes > key_rows].index}
    args = ("customer_id", "timestamp", "amount", "transaction_id", [1, 6, 24, 168], 60.0, 3_600_000_000)
    got, want = (trailing.trailing_profile(df, *args, b).toPandas() for b in (busy, None))
    # of repeated rows the first has another row before it than the second
    order = ["transaction_id", "_prev_t", "_prev_x"]
    got, want = (f.sort_values(order).reset_index(drop=True)[sorted(f.columns)] for f in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    plan = trailing.trailing_profile(df, *args, busy.limit(0))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_levels_and_sizes_are_counted_in_the_input(spark, txns, monkeypatch):
    df = spark.createDataFrame(txns.assign(category="usual"))
    seen = []
    for module, name in ((tf, "level_frequencies"), (trailing, "busy_keys"), (trailing, "choose_cell")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda frame, *a, _f=plain, **k: seen.append(frame.columns) or _f(frame, *a, **k))
    tf.transaction_features(df, categorical=["category"])
    assert seen and all(c == df.columns for c in seen)  # not the frame with the ranks joined to it
