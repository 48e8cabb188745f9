"""Trend + seasonality + holidays for many series (after Taylor, Letham 2018), one Spark group per series.

The trend is piecewise linear (or logistic) with hinge points, seasonality is a Fourier basis, and
all coefficients come from ridge regression with the priors as penalties. A series has one row per
period, so a group is bounded by the calendar. A fitted model is one row per series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillscope.functions.columns import clean_double

# Hinge points, share of the history that holds them, Fourier orders, day lengths.
HINGES = 25
HINGE_SHARE = 0.8
SEASONS = {"yearly": (365.25, 10), "weekly": (7.0, 3), "daily": (1.0, 4)}
CAP_FACTOR = 1.5
SAMPLES = 200
STEPS = {"H": pd.DateOffset(hours=1), "D": pd.DateOffset(days=1), "W": pd.DateOffset(weeks=1), "MS": pd.DateOffset(months=1), "M": pd.DateOffset(months=1)}


@dataclass(frozen=True)
class Season:
    """A periodic component: period in days, Fourier order, prior."""

    name: str
    period: float
    order: int
    prior: float = 10.0


@dataclass(frozen=True)
class Spec:
    """What a decomposition contains."""

    growth: str = "linear"
    mode: str = "multiplicative"
    yearly: bool = True
    weekly: bool = True
    daily: bool = False
    trend_prior: float = 0.05
    season_prior: float = 10.0
    holiday_prior: float = 10.0
    level: float = 0.95
    custom: tuple[Season, ...] = ()
    holidays: Mapping[str, Sequence[str]] = field(default_factory=dict)
    regressors: tuple[str, ...] = ()
    cap: float | None = None
    floor: float = 0.0
    seed: int = 42

    def with_season(self, name: str, period: float, order: int, prior: float = 10.0) -> "Spec":
        return replace(self, custom=(*self.custom, Season(name, period, order, prior)))

    def seasons(self) -> list[Season]:
        built_in = [Season(n, *SEASONS[n], self.season_prior) for n in SEASONS if getattr(self, n)]
        return [*built_in, *self.custom]

    def parts(self) -> list[str]:
        return [s.name for s in self.seasons()] + (["holidays"] if self.holidays else []) + (["regressors"] if self.regressors else [])


MODEL = "first timestamp, last timestamp, scale double, cap double, n long, trend array<double>, effects array<double>, sigma double, hinges array<double>, centers array<double>, spreads array<double>"
_NAMES = [c.split()[0] for c in MODEL.split(", ")]


def _effect_columns(spec: Spec, ds: pd.Series, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[str, int]]]:
    """Seasonal, holiday and regressor columns with their priors and widths."""
    days = (ds - pd.Timestamp("1970-01-01")).dt.total_seconds().to_numpy() / 86400
    blocks, priors, widths = [], [], []
    for s in spec.seasons():
        angle = 2 * np.pi * np.outer(days / s.period, np.arange(1, s.order + 1))
        blocks += [np.sin(angle), np.cos(angle)]
        priors += [s.prior] * (2 * s.order)
        widths.append((s.name, 2 * s.order))
    if spec.holidays:
        dates = ds.dt.strftime("%Y-%m-%d")
        blocks.append(np.column_stack([dates.isin(list(v)).to_numpy(float) for v in spec.holidays.values()]))
        priors += [spec.holiday_prior] * len(spec.holidays)
        widths.append(("holidays", len(spec.holidays)))
    if spec.regressors:
        blocks.append(extra)
        priors += [spec.holiday_prior] * extra.shape[1]
        widths.append(("regressors", extra.shape[1]))
    x = np.column_stack(blocks) if blocks else np.zeros((len(ds), 0))
    return x, np.array(priors), widths


def _trend_columns(t: np.ndarray, hinges: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(t)), t, np.maximum(t[:, None] - hinges[None], 0)])


def _ridge(x: np.ndarray, y: np.ndarray, priors: np.ndarray, sigma2: float) -> np.ndarray:
    penalty = np.where(np.isfinite(priors), sigma2 / np.maximum(priors, 1e-9) ** 2, 0.0)
    return np.linalg.solve(x.T @ x + np.diag(penalty + 1e-9), x.T @ y) if x.shape[1] else np.zeros(0)


def _level(spec: Spec, line: np.ndarray, cap: float) -> np.ndarray:
    """Trend on the scaled value axis: the line itself, or a logistic curve between floor and cap."""
    return line if spec.growth == "linear" else cap / (1 + np.exp(-np.clip(line, -30, 30)))


def _solve(spec: Spec, pdf: pd.DataFrame) -> dict:
    pdf = pdf.sort_values("ds")
    y = pdf.y.interpolate(limit_direction="both").fillna(0.0).to_numpy("float64") - (spec.floor if spec.growth == "logistic" else 0.0)
    first, last = pdf.ds.iloc[0], pdf.ds.iloc[-1]
    seconds = max((last - first).total_seconds(), 1.0)
    t = (pdf.ds - first).dt.total_seconds().to_numpy() / seconds
    scale = max(np.abs(y).max(), 1e-12)
    z = y / scale
    cap = ((spec.cap - spec.floor) / scale if spec.cap is not None else CAP_FACTOR * z.max()) if spec.growth == "logistic" else 0.0
    count = min(HINGES, max(0, int(len(t) * HINGE_SHARE) - 1))
    hinges = t[np.linspace(0, int(len(t) * HINGE_SHARE) - 1, count + 1).round().astype(int)[1:]] if count else np.zeros(0)
    raw = pdf[list(spec.regressors)].to_numpy("float64") if spec.regressors else np.zeros((len(t), 0))
    centers, spreads = raw.mean(0), np.where(raw.std(0) > 0, raw.std(0), 1.0)
    trend_x = _trend_columns(t, hinges)
    trend_prior = np.r_[5.0, 5.0, np.full(len(hinges), spec.trend_prior)]
    effect_x, effect_prior, _ = _effect_columns(spec, pdf.ds, (raw - centers) / spreads)
    effects, sigma2 = np.zeros(effect_x.shape[1]), 0.01
    multiply = spec.mode == "multiplicative"
    for _ in range(6):  # alternate trend, effects and noise level
        season = effect_x @ effects
        if spec.growth == "linear":
            weight = (1 + season) if multiply else np.ones(len(t))
            trend = _ridge(trend_x * weight[:, None], z if multiply else z - season, trend_prior, sigma2)
        else:
            base = z / np.maximum(1 + season, 0.05) if multiply else z - season
            share = np.clip(base / cap, 0.01, 0.99)
            trend = _ridge(trend_x, np.log(share / (1 - share)), np.full(len(trend_prior), 5.0), sigma2)
        level = _level(spec, trend_x @ trend, cap)
        effects = _ridge(effect_x * (level[:, None] if multiply else 1.0), z - level, effect_prior, sigma2)
        fitted = level * (1 + effect_x @ effects) if multiply else level + effect_x @ effects
        sigma2 = max(float(np.mean((z - fitted) ** 2)), 1e-10)
    values = (first, last, scale, cap, len(t), trend, effects, float(np.sqrt(sigma2)), hinges, centers, spreads)
    return {n: v.tolist() if isinstance(v, np.ndarray) else v for n, v in zip(_NAMES, values)}


def _evaluate(spec: Spec, m: Mapping, ds: pd.Series, raw: np.ndarray) -> pd.DataFrame:
    """Trend, components, value and interval at the given dates."""
    seconds = max((m["last"] - m["first"]).total_seconds(), 1.0)
    t = (ds - m["first"]).dt.total_seconds().to_numpy() / seconds
    hinges, trend, effects = (np.array(m[k], dtype=float) for k in ("hinges", "trend", "effects"))
    extra = (raw - np.array(m["centers"])) / np.array(m["spreads"]) if spec.regressors else raw
    x, _, widths = _effect_columns(spec, ds, extra)
    line = _trend_columns(t, hinges) @ trend
    level = _level(spec, line, m["cap"])
    multiply = spec.mode == "multiplicative"
    out, at, season = {"trend": level * m["scale"]}, 0, np.zeros(len(t))
    for name, width in widths:
        part = x[:, at : at + width] @ effects[at : at + width]
        out[name] = part if multiply else part * m["scale"]
        season += part
        at += width
    value = level * (1 + season) if multiply else level + season
    # future slope changes: as many per unit of time and as large as in the history
    rng = np.random.default_rng(spec.seed)
    beyond = t > 1
    drift = np.zeros((SAMPLES, len(t)))
    size = float(np.abs(trend[2:]).mean()) if len(hinges) else 0.0
    if beyond.any() and size > 0:
        times = t[beyond]
        chance = np.clip(len(hinges) * np.diff(np.r_[1.0, times]), 0, 1)
        slopes = np.cumsum(rng.laplace(0, size, (SAMPLES, len(times))) * (rng.random((SAMPLES, len(times))) < chance), axis=1)
        drift[:, beyond] = np.cumsum(slopes * np.diff(np.r_[1.0, times]), axis=1)
    paths = _level(spec, line[None] + drift, m["cap"])
    paths = paths * (1 + season) if multiply else paths + season
    width = paths.std(0) if beyond.any() else np.zeros(len(t))
    half = NormalDist().inv_cdf(0.5 + spec.level / 2) * np.sqrt(m["sigma"] ** 2 + width**2)
    base = spec.floor if spec.growth == "logistic" else 0.0
    out |= {"yhat": value * m["scale"] + base, "yhat_lower": (value - half) * m["scale"] + base, "yhat_upper": (value + half) * m["scale"] + base}
    return pd.DataFrame({"ds": ds.to_numpy(), **out})


def _rows(df: DataFrame, spec: Spec, key: str, date: str, value: str) -> DataFrame:
    return df.select(key, F.col(date).cast("timestamp").alias("ds"), clean_double(value).alias("y"), *[clean_double(r).alias(r) for r in spec.regressors])


def fit(df: DataFrame, spec: Spec = Spec(), key: str = "series_id", date: str = "ds", value: str = "y") -> DataFrame:
    """One row of parameters per series."""
    kind = df.schema[key].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{key: pdf[key].iloc[0], **_solve(spec, pdf)}])

    return _rows(df, spec, key, date, value).groupBy(key).applyInPandas(run, f"{key} {kind}, {MODEL}")


def _schema(spec: Spec, key: str, kind: str, extra: str = "") -> str:
    return f"{key} {kind}, ds timestamp, {extra}trend double, " + "".join(f"{p} double, " for p in spec.parts()) + "yhat double, yhat_lower double, yhat_upper double"


def forecast(model: DataFrame, spec: Spec = Spec(), horizon: int = 30, freq: str = "D", key: str = "series_id", future: DataFrame | None = None) -> DataFrame:
    """Values, components and intervals for the periods after each series' last date.

    With regressors their future values are needed: ``future`` has (key, ds, regressors).
    """
    kind = model.schema[key].dataType.simpleString()
    if spec.regressors:
        if future is None:
            raise ValueError("future values of the regressors are required")
        return history(future.withColumn("y", F.lit(None).cast("double")), model, spec, key).drop("actual")
    if freq not in STEPS:
        raise ValueError(f"unknown frequency: {freq}")

    def run(frames):
        for models in frames:
            for _, m in models.iterrows():
                ds = pd.Series([m["last"] + STEPS[freq] * h for h in range(1, horizon + 1)])
                out = _evaluate(spec, m, ds, np.zeros((horizon, 0)))
                out.insert(0, key, m[key])
                yield out

    return model.mapInPandas(run, _schema(spec, key, kind))


def history(df: DataFrame, model: DataFrame, spec: Spec = Spec(), key: str = "series_id", date: str = "ds", value: str = "y") -> DataFrame:
    """Fitted values and components at the dates of ``df``, next to the actual value."""
    kind = df.schema[key].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds", ignore_index=True)
        raw = pdf[list(spec.regressors)].to_numpy("float64") if spec.regressors else np.zeros((len(pdf), 0))
        out = _evaluate(spec, pdf.iloc[0], pdf.ds, raw)
        out.insert(0, key, pdf[key].iloc[0])
        out.insert(2, "actual", pdf.y)
        return out

    joined = _rows(df, spec, key, date, value).join(model, key)
    return joined.groupBy(key).applyInPandas(run, _schema(spec, key, kind, "actual double, "))


def components(fitted: DataFrame, spec: Spec, key: str = "series_id") -> dict[str, DataFrame]:
    """One (key, ds, value) frame per component of a forecast or history frame."""
    return {p: fitted.select(key, "ds", F.col(p)) for p in ("trend", *spec.parts())}


def changepoints(model: DataFrame, key: str = "series_id") -> DataFrame:
    """(key, ds, delta): hinge dates and slope changes."""
    pairs = F.explode(F.arrays_zip("hinges", F.slice("trend", 3, F.greatest(F.size("hinges"), F.lit(1))).alias("deltas"))).alias("_h")
    span = F.unix_micros("last") - F.unix_micros("first")
    at = F.timestamp_micros((F.unix_micros("first") + F.col("_h.hinges") * F.col("_span")).cast("long"))
    rows = model.where(F.size("hinges") > 0).select(key, "first", "last", "scale", span.alias("_span"), pairs)
    return rows.select(key, at.alias("ds"), (F.col("_h.deltas") * F.col("scale")).alias("delta"))


def diagnostics(model: DataFrame, spec: Spec, key: str = "series_id") -> DataFrame:
    return model.select(
        key,
        F.lit(spec.growth).alias("growth"),
        F.lit(spec.mode).alias("seasonality_mode"),
        F.lit(spec.trend_prior).alias("changepoint_prior_scale"),
        F.lit(spec.season_prior).alias("seasonality_prior_scale"),
        F.size("hinges").alias("n_changepoints"),
        F.col("n").alias("n_observations"),
        F.lit(",".join(s.name for s in spec.seasons())).alias("components"),
        F.lit(spec.level * 100).alias("confidence_interval"),
    )


def backtest(df: DataFrame, spec: Spec = Spec(), initial_days: int = 730, period_days: int = 180, horizon_days: int = 365, key: str = "series_id", date: str = "ds", value: str = "y") -> DataFrame:
    """(key, cutoff, ds, actual, yhat, yhat_lower, yhat_upper) for cutoffs going back from the end.

    Every (series, cutoff) is a group of its own: fit on the rows up to the cutoff, predict the rest.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = _rows(df, spec, key, date, value)
    day = F.expr("interval 1 day")
    span = rows.groupBy(key).agg(F.min("ds").alias("_a"), F.max("ds").alias("_b"))
    newest, oldest = F.col("_b") - day * horizon_days, F.col("_a") + day * initial_days
    steps = F.floor((F.unix_micros(newest) - F.unix_micros(oldest)) / (86_400_000_000 * period_days)).cast("int")
    cutoffs = span.where(newest >= oldest).select(key, newest.alias("_newest"), F.explode(F.sequence(F.lit(0), steps)).alias("_i"))
    cutoffs = cutoffs.select(key, (F.col("_newest") - day * (F.col("_i") * period_days)).alias("cutoff"))
    spread = rows.join(cutoffs, key).where(F.col("ds") <= F.col("cutoff") + day * horizon_days)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds", ignore_index=True)
        past = pdf.ds <= pdf.cutoff
        m, rest = _solve(spec, pdf[past]), pdf[~past].reset_index(drop=True)
        raw = rest[list(spec.regressors)].to_numpy("float64") if spec.regressors else np.zeros((len(rest), 0))
        out = _evaluate(spec, m, rest.ds, raw)[["ds", "yhat", "yhat_lower", "yhat_upper"]]
        return out.assign(**{key: rest[key], "cutoff": rest.cutoff, "actual": rest.y})[[key, "cutoff", "ds", "actual", "yhat", "yhat_lower", "yhat_upper"]]

    return spread.groupBy(key, "cutoff").applyInPandas(run, f"{key} {kind}, cutoff timestamp, ds timestamp, actual double, yhat double, yhat_lower double, yhat_upper double")


def backtest_metrics(results: DataFrame, key: str = "series_id") -> DataFrame:
    """Mean absolute percentage error, RMSE, MAE and interval coverage per series."""
    e = F.col("actual") - F.col("yhat")
    inside = (F.col("actual") >= F.col("yhat_lower")) & (F.col("actual") <= F.col("yhat_upper"))
    return results.groupBy(key).agg(
        (F.avg(F.when(F.col("actual") != 0, F.abs(F.try_divide(e, F.col("actual"))))) * 100).alias("mape"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(inside.cast("double")).alias("coverage"),
    )
