"""ARIMA with optional seasonal lags for many series: one row of values per (series, candidate).

A series is a table of at most one row per period (see ``series.densify``), so its row is bounded
by the calendar. Many short series share a task and an Arrow batch. Coefficients come from repeated least squares on lagged values and residuals
(Hannan, Rissanen 1982). Seasonal terms enter as extra lags.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.functions.columns import clean_double
from tillscope.operators import forecast_metrics

# Order limits, seasonal candidates (P, D, Q), folds and rows per fold.
MAX_P, MAX_D, MAX_Q = 3, 2, 3
SEASONAL = ((1, 1, 1), (1, 0, 1), (0, 1, 1), (1, 1, 0))
FOLDS, FOLD_ROWS = 5, 30
MIN_ROWS = 12
FORECAST_SERIES = 1000  # series whose forecasts leave a task together
ORDER = "p int, d int, q int, sp int, sd int, sq int, period int"
FITTED = f"{ORDER}, const double, ar array<double>, ma array<double>, sigma2 double, aic double, bic double, n long"
_ORDER_NAMES = [c.split()[0] for c in ORDER.split(", ")]


def _poly(d: int, sd: int, s: int) -> np.ndarray:
    """(1 - L)^d (1 - L^s)^sd as coefficients of 1, L, L^2, ..."""
    out = np.array([1.0])
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    for _ in range(sd):
        out = np.convolve(out, np.r_[1.0, np.zeros(s - 1), -1.0])
    return out


def _lag(x: np.ndarray, k: int) -> np.ndarray:
    return np.r_[np.zeros(k), x[:-k]] if k < len(x) else np.zeros(len(x))


def _filled(y: np.ndarray) -> np.ndarray:
    """Missing values by linear interpolation, the nearest value at the ends, zero where there is none."""
    known = np.isfinite(y)
    if known.all() or not known.any():
        return np.where(known, y, 0.0)
    at = np.arange(len(y))
    return np.interp(at, at[known], y[known])


def _mean_only(y: np.ndarray) -> dict:
    return {"const": float(y.mean()), "ar": [], "ma": [], "sigma2": float(y.var())}


def _fit(y: np.ndarray, order: Sequence[int]) -> dict | None:
    """Level-form coefficients: y_t = const + sum ar_i y_(t-i) + e_t + sum ma_j e_(t-j)."""
    p, d, q, sp, sd, sq, s = order
    diff = _poly(d, sd, s)
    w = np.convolve(y, diff)[len(diff) - 1 : len(y)]
    ar_lags = sorted({*range(1, p + 1), *(s * k for k in range(1, sp + 1))})
    ma_lags = sorted({*range(1, q + 1), *(s * k for k in range(1, sq + 1))})
    start = max([0, *ar_lags, *ma_lags])
    k = 1 + len(ar_lags) + len(ma_lags)
    if len(w) - start < max(MIN_ROWS, 2 * k):
        return None
    long = min(len(w) // 4, start + 10)
    x = np.column_stack([np.ones(len(w)), *[_lag(w, i) for i in range(1, long + 1)]])[long:]
    e = np.r_[np.zeros(long), w[long:] - x @ np.linalg.lstsq(x, w[long:], rcond=None)[0]]
    for _ in range(4 if ma_lags else 1):
        x = np.column_stack([np.ones(len(w)), *[_lag(w, i) for i in ar_lags], *[_lag(e, j) for j in ma_lags]])
        b = np.linalg.lstsq(x[start:], w[start:], rcond=None)[0]
        theta = b[1 + len(ar_lags) :]
        size = np.abs(theta).sum()
        if size > 0.98:  # keep the residual recursion stable
            theta = theta * 0.98 / size
        known = x[:, : 1 + len(ar_lags)] @ b[: 1 + len(ar_lags)]
        fresh = np.zeros(len(w))
        for t in range(start, len(w)):
            fresh[t] = w[t] - known[t] - sum(c * fresh[t - j] for c, j in zip(theta, ma_lags))
        if not np.isfinite(fresh).all():
            return None
        e = fresh
    used = e[start:]
    n = len(used)
    sigma2 = float(used @ used / n)
    like = n * (math.log(max(sigma2, 1e-300)) + 1 + math.log(2 * math.pi))
    phi = np.r_[1.0, np.zeros(max(ar_lags, default=0))]
    for c, i in zip(b[1:], ar_lags):
        phi[i] = -c
    ma = np.zeros(max(ma_lags, default=0))
    for c, j in zip(theta, ma_lags):
        ma[j - 1] = c
    return {
        "const": float(b[0]),
        "ar": (-np.convolve(phi, diff)[1:]).tolist(),
        "ma": ma.tolist(),
        "sigma2": sigma2,
        "aic": like + 2 * (k + 1),
        "bic": like + math.log(n) * (k + 1),
        "n": n,
    }


def _residuals(y: np.ndarray, const: float, ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    e = np.zeros(len(y))
    for t in range(len(ar), len(y)):
        e[t] = y[t] - const - ar @ y[t - len(ar) : t][::-1]
        if len(ma):
            past = e[max(0, t - len(ma)) : t][::-1]
            e[t] -= ma[: len(past)] @ past
    return e


def _ahead(y: np.ndarray, const: float, ar: np.ndarray, ma: np.ndarray, sigma2: float, steps: int, level: float) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts and half widths; the width grows with the psi weights."""
    values, e = list(y), list(_residuals(y, const, ar, ma))
    psi = np.zeros(steps)
    for h in range(steps):
        past = np.array(values[len(values) - len(ar) :][::-1]) if len(ar) else np.zeros(0)
        shocks = np.array(e[len(e) - len(ma) :][::-1]) if len(ma) else np.zeros(0)
        values.append(const + float(ar @ past) + float(ma @ shocks))
        e.append(0.0)
        psi[h] = 1.0 if h == 0 else (ma[h - 1] if h <= len(ma) else 0.0) + sum(ar[i] * psi[h - 1 - i] for i in range(min(h, len(ar))))
    half = NormalDist().inv_cdf(0.5 + level / 2) * np.sqrt(sigma2 * np.cumsum(psi**2))
    return np.array(values[len(y) :]), half


def _adf(y: np.ndarray) -> float:
    """Dickey-Fuller statistic with a constant; the lag count is chosen by AIC."""
    dy = np.diff(y)
    most = int(min(12 * (len(y) / 100) ** 0.25, len(dy) // 2 - 3))
    best = (math.inf, 0.0)
    for k in range(max(most, 0) + 1):
        x = np.column_stack([np.ones(len(dy)), y[:-1], *[_lag(dy, i) for i in range(1, k + 1)]])[most:]
        target = dy[most:]
        b, *_ = np.linalg.lstsq(x, target, rcond=None)
        r = target - x @ b
        s2 = float(r @ r) / max(len(r) - x.shape[1], 1)
        spread = math.sqrt(max(s2 * np.linalg.pinv(x.T @ x)[1, 1], 1e-300))
        aic = len(r) * math.log(max(float(r @ r) / len(r), 1e-300)) + 2 * x.shape[1]
        best = min(best, (aic, float(b[1]) / spread))
    return best[1]


def differencing_order(df: DataFrame, key: str, date: str = "ds", value: str = "y", most: int = MAX_D) -> DataFrame:
    """(key, d): the first d in 0..most whose d-th difference looks stationary at 5 %, else 1."""

    def choose(y: np.ndarray) -> int:
        for d in range(most + 1):
            z = np.diff(y, d)
            if len(z) < MIN_ROWS or np.ptp(z) == 0:
                continue
            if _adf(z) < -2.8621 - 2.738 / len(z) - 8.36 / len(z) ** 2:  # 5 % critical value (MacKinnon 2010)
                return d
        return 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({key: pdf[key], "d": [choose(y) for y in map(_values, pdf["_y"])]})

    return _spread(_packed(df, key, date, value).select(key, "_y"), key).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, d int")


def _packed(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """(key, _y, _last): the values of a series in order of their dates, rows without one at the end, and the last date."""
    when = F.col(date)
    item = F.struct(when.isNull().alias("u"), when.alias("d"), clean_double(value).alias("v"))
    rows = df.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_s"), F.max(when.cast("timestamp")).alias("_last"))
    return rows.select(key, F.col("_s.v").alias("_y"), "_last")


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows over all tasks: they are few and small, but each is a fit, so their bytes must not decide the number of tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _values(y: Sequence[float | None]) -> np.ndarray:
    return _filled(np.asarray(y, dtype="float64"))


def fit_candidates(df: DataFrame, key: str, candidates: DataFrame, date: str = "ds", value: str = "y") -> DataFrame:
    """Fit every (series, order) row of ``candidates``; orders that cannot be fitted give no row."""
    kind = df.schema[key].dataType.simpleString()
    names = [key, *[c.split()[0] for c in FITTED.split(", ")]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for k, y, *order in zip(*[pdf[c] for c in (key, "_y", *_ORDER_NAMES)]):
                order = [int(v) for v in order]
                found = _fit(_values(y), order)
                if found is not None:
                    out.append({key: k, **dict(zip(_ORDER_NAMES, order)), **found})
            if out:
                yield pd.DataFrame(out)[names]

    rows = _packed(df, key, date, value).select(key, "_y").join(candidates.select(key, *_ORDER_NAMES), key)
    return _spread(rows, key, *_ORDER_NAMES).mapInPandas(run, f"{key} {kind}, {FITTED}")


def _orders(orders: Sequence[Sequence[int]]) -> Column:
    names = [n for n in _ORDER_NAMES if n != "d"]
    return F.explode(F.array(*[F.struct(*[F.lit(int(v)).alias(n) for n, v in zip(names, o)]) for o in orders])).alias("_o")


def _best(fits: DataFrame, key: str, criterion: str) -> DataFrame:
    names = [c for c in fits.columns if c != key]
    ties = [F.col(c) for c in _ORDER_NAMES]
    return fits.groupBy(key).agg(F.min_by(F.struct(*names), F.struct(F.col(criterion), *ties)).alias("_b")).select(key, "_b.*")


def fit(
    df: DataFrame,
    key: str = "series_id",
    date: str = "ds",
    value: str = "y",
    order: tuple[int, int, int] | None = None,
    auto_order: bool = True,
    seasonal_order: tuple[int, int, int] | None = None,
    period: int | None = None,
    criterion: str = "aic",
) -> DataFrame:
    """One row of coefficients per series. Without an order the best of the p, q grid is taken;
    with a ``period`` a seasonal order is chosen next, keeping (p, d, q). Missing values are
    interpolated. ``status`` is "fitted", or "mean" for a series that no order fits (too short, say):
    it is described by its mean and variance, so every series has a row."""
    if criterion not in ("aic", "bic"):
        raise ValueError(f"unknown criterion: {criterion}")
    keys = df.select(key).distinct()
    if order is not None:
        base = keys.withColumn("d", F.lit(order[1]))
        grid = [(order[0], order[2], 0, 0, 0, 1)]
    else:
        base = differencing_order(df, key, date, value)
        pairs = [(p, q) for p in range(MAX_P + 1) for q in range(MAX_Q + 1) if p + q] if auto_order else [(1, 1)]
        grid = [(p, q, 0, 0, 0, 1) for p, q in pairs]
    candidates = base.select(key, "d", _orders(grid)).select(key, "d", "_o.*").select(key, *_ORDER_NAMES)
    plain = _best(fit_candidates(df, key, candidates, date, value), key, criterion).withColumn("status", F.lit("fitted"))
    v = clean_double(value)
    flat = df.groupBy(key).agg(F.coalesce(F.avg(v), F.lit(0.0)).alias("const"), F.coalesce(F.var_pop(v), F.lit(0.0)).alias("sigma2"), F.count(F.lit(1)).alias("n"))
    none = F.array().cast("array<double>")
    zeros = [F.lit(1 if n == "period" else 0).alias(n) for n in _ORDER_NAMES]
    flat = flat.select(key, *zeros, "const", none.alias("ar"), none.alias("ma"), "sigma2", F.lit(None).cast("double").alias("aic"), F.lit(None).cast("double").alias("bic"), "n", F.lit("mean").alias("status"))
    names = [c for c in plain.columns if c != key]
    plain = flat.select(key, F.struct(*names).alias("_f")).join(plain.select(key, F.struct(*names).alias("_p")), key, "left").select(key, F.coalesce("_p", "_f").alias("_m")).select(key, "_m.*")
    if not period or period < 2:
        return plain
    seasonal = [seasonal_order] if seasonal_order else SEASONAL
    options = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("sp", "sd", "sq", "period"), (*o, period))]) for o in seasonal]))
    more = plain.select(key, "p", "d", "q", options.alias("_o")).select(key, "p", "d", "q", "_o.*").select(key, *_ORDER_NAMES)
    richer = _best(fit_candidates(df, key, more.where("p + q + d > 0"), date, value), key, criterion).withColumn("status", F.lit("fitted"))
    # a series too short for seasonal lags keeps its plain model
    names = [c for c in plain.columns if c != key]
    a, b = plain.select(key, F.struct(*names).alias("_a")), richer.select(key, F.struct(*names).alias("_b"))
    return a.join(b, key, "left").select(key, F.coalesce("_b", "_a").alias("_m")).select(key, "_m.*")


def forecast(df: DataFrame, model: DataFrame, horizon: int = 30, level: float = 0.95, key: str = "series_id", date: str = "ds", value: str = "y", step: str = "1 day") -> DataFrame:
    """ds, yhat, yhat_lower, yhat_upper for the periods after each series' last date."""
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for part in (pdf.iloc[i : i + FORECAST_SERIES] for i in range(0, len(pdf), FORECAST_SERIES)):
                ahead = [
                    _ahead(_values(y), const, np.array(ar), np.array(ma), sigma2, horizon, level)
                    for y, const, ar, ma, sigma2 in zip(*[part[c] for c in ("_y", "const", "ar", "ma", "sigma2")])
                ]
                mean, half = (np.concatenate(x) for x in zip(*ahead))
                at = part[[key, "_last"]].loc[part.index.repeat(horizon)].reset_index(drop=True)
                yield at.assign(_h=np.tile(np.arange(1, horizon + 1), len(part)), yhat=mean, yhat_lower=mean - half, yhat_upper=mean + half)

    rows = _packed(df, key, date, value).join(model.select(key, "const", "ar", "ma", "sigma2"), key)
    out = _spread(rows, key).mapInPandas(run, f"{key} {kind}, _last timestamp, _h int, yhat double, yhat_lower double, yhat_upper double")
    when = F.col("_last") + F.col("_h") * F.expr(f"interval {step}")
    return out.select(key, when.alias("ds"), "yhat", "yhat_lower", "yhat_upper")


def in_sample(df: DataFrame, model: DataFrame, key: str = "series_id", date: str = "ds", value: str = "y") -> DataFrame:
    """(key, ds, actual, predicted): one-step predictions; the first rows, without enough past, are left out."""
    kind = df.schema[key].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        first = pdf.iloc[0]
        y = _filled(pdf[value].to_numpy("float64"))
        skip = len(first.ar)
        e = _residuals(y, first.const, np.array(first.ar), np.array(first.ma))
        return pd.DataFrame({key: first[key], "ds": pdf[date], "actual": y, "predicted": y - e}).iloc[skip:]

    rows = df.select(key, F.col(date).cast("timestamp").alias(date), clean_double(value).alias(value)).join(model.select(key, "const", "ar", "ma"), key)
    return rows.groupBy(key).applyInPandas(run, f"{key} {kind}, ds timestamp, actual double, predicted double")


def diagnostics(df: DataFrame, model: DataFrame, key: str = "series_id", date: str = "ds", value: str = "y") -> DataFrame:
    """Order, AIC, BIC, rows, residual mean and spread, Ljung-Box p-value."""
    tests = forecast_metrics.residual_diagnostics(in_sample(df, model, key, date, value), [key])
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_observations"))
    wanted = tests.select(key, F.col("mean").alias("residual_mean"), F.col("std").alias("residual_std"), "ljung_box_pvalue")
    return model.select(key, "status", *_ORDER_NAMES, "aic", "bic").join(rows, key).join(wanted, key, "left")


def info(df: DataFrame, model: DataFrame, key: str = "series_id") -> DataFrame:
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_observations"))
    kind = F.when(F.col("sp") + F.col("sd") + F.col("sq") > 0, "SARIMA").otherwise("ARIMA")
    return model.select(key, kind.alias("type"), *_ORDER_NAMES, "aic", "bic").join(rows, key)


def backtest(df: DataFrame, model: DataFrame, folds: int = FOLDS, rows_per_fold: int = FOLD_ROWS, key: str = "series_id", date: str = "ds", value: str = "y") -> DataFrame:
    """(key, fold, ds, actual, predicted): refit before each trailing fold with the chosen orders.

    Each fold is a group of its own, so folds of one series run side by side. A series under two folds
    of rows is tested on its last third, and a training part that cannot be fitted predicts its mean;
    only a series of a single row has nothing to test.
    """
    kind = df.schema[key].dataType.simpleString()
    base = df.select(key, F.col(date).cast("timestamp").alias("ds"), clean_double(value).alias("y"))
    each = Window.partitionBy(key)  # one row per period
    numbered = base.withColumn("_i", F.row_number().over(each.orderBy("ds"))).withColumn("_n", F.count(F.lit(1)).over(each))
    size = F.when(F.col("_n") >= 2 * rows_per_fold, F.lit(rows_per_fold)).otherwise(F.greatest(F.lit(1), F.floor(F.col("_n") / 3))).cast("int")
    allowed = F.least(F.lit(folds), F.greatest(F.lit(1), F.floor(F.col("_n") / rows_per_fold).cast("int") - 1))
    spread = numbered.withColumn("fold", F.explode(F.sequence(F.lit(0), allowed - 1)))
    end = F.col("_n") - F.col("fold") * size
    spread = spread.where((F.col("_i") <= end) & (end >= 2 * size)).withColumn("_test", F.col("_i") > end - size)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        y, test = _filled(pdf.y.to_numpy("float64")), pdf._test.to_numpy(bool)
        found = _fit(y[~test], [int(pdf[c].iloc[0]) for c in _ORDER_NAMES]) or _mean_only(y[~test])
        mean, _ = _ahead(y[~test], found["const"], np.array(found["ar"]), np.array(found["ma"]), found["sigma2"], int(test.sum()), 0.95)
        return pd.DataFrame({key: pdf[key].iloc[0], "fold": pdf.fold.iloc[0], "ds": pdf.ds[test], "actual": y[test], "predicted": mean})

    joined = spread.drop("_i", "_n").join(model.select(key, *_ORDER_NAMES), key)
    return joined.groupBy(key, "fold").applyInPandas(run, f"{key} {kind}, fold int, ds timestamp, actual double, predicted double")


def backtest_metrics(folds: DataFrame, key: str = "series_id") -> DataFrame:
    """MAPE, RMSE and MAE per fold."""
    return forecast_metrics.forecast_metrics(folds, [key, "fold"], advanced=False).select(key, "fold", "mape", "rmse", "mae")
