"""How good is a forecast: errors, intervals, model comparison and residual tests.

Rows are (keys, ds, actual, predicted); every figure is a grouped aggregate. Where the row before
is needed, rows are numbered by ``ranking.in_order``, which also copes with one dominant series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.functions.columns import micros, safe_div
from tillscope.functions.tails import chi2_upper, chi2_upper_even, normal_two_sided
from tillscope.operators import ranking
from tillscope.operators.series import lagged

TOLERANCE = 0.1
LJUNG_BOX_LAGS = 10


def _base(actual: str, predicted: str) -> dict[str, Column]:
    a, p = F.col(actual), F.col(predicted)
    e = a - p
    n = F.count(e)
    sse = F.sum(e * e)
    sst = n * F.var_pop(a)
    size = F.abs(a) + F.abs(p)
    return {
        "n": n,
        "mse": F.avg(e * e),
        "rmse": F.sqrt(F.avg(e * e)),
        "mae": F.avg(F.abs(e)),
        "r2": F.when(sst > 0, 1 - sse / F.nullif(sst, F.lit(0.0))).when(sse == 0, 1.0).otherwise(0.0),
        "mape": F.avg(F.when(a != 0, F.abs(F.try_divide(e, a)))) * 100,
        "smape": F.avg(F.when(size != 0, F.try_divide(2 * F.abs(e), size))) * 100,
    }


def _steps(df: DataFrame, keys: Sequence[str], date: str, previous: dict[str, str]) -> DataFrame:
    timed = df.withColumn("_t", micros(date))
    return ranking.in_order(timed, "_t", "_t", keys, previous=previous)


def forecast_metrics(df: DataFrame, keys: Sequence[str] = (), date: str = "ds", actual: str = "actual", predicted: str = "predicted", advanced: bool = True) -> DataFrame:
    """Error metrics per key; with ``advanced`` also scaled error, bias, Theil's U and tolerance share."""
    base = _base(actual, predicted)
    if not advanced:
        return df.groupBy(*keys).agg(*[c.alias(n) for n, c in base.items()])
    steps = _steps(df, keys, date, {"_a0": actual, "_p0": predicted})
    a, p = F.col(actual), F.col(predicted)
    e = a - p
    da, dp = F.try_divide(a, F.col("_a0")) - 1, F.try_divide(p, F.col("_p0")) - 1
    both = da.isNotNull() & dp.isNotNull()
    mean = lambda c: F.avg(F.when(both, c))
    theil = F.try_divide(F.sqrt(mean((da - dp) * (da - dp))), F.sqrt(mean(da * da)) + F.sqrt(mean(dp * dp)))
    mad = F.avg(F.abs(e))
    more = {
        "mase": F.try_divide(mad, F.avg(F.abs(a - F.col("_a0")))),
        "tracking_signal": F.try_divide(F.sum(e), mad),
        "bias": F.avg(-e),
        "theils_u": theil,
        "coverage_10pct": F.coalesce(F.avg(F.when(a != 0, (F.abs(F.try_divide(e, a)) <= TOLERANCE).cast("double"))), F.lit(0.0)) * 100,
    }
    return steps.groupBy(*keys).agg(*[c.alias(n) for n, c in {**base, **more}.items()])


def interval_metrics(df: DataFrame, keys: Sequence[str] = (), actual: str = "actual", lower: str = "lower", upper: str = "upper", target: float = 0.95) -> DataFrame:
    """Coverage, width and Winkler score of prediction intervals."""
    a, lo, hi = F.col(actual), F.col(lower), F.col(upper)
    width = hi - lo
    penalty = 2 / (1 - target)
    score = width + F.when(a < lo, penalty * (lo - a)).when(a > hi, penalty * (a - hi)).otherwise(0.0)
    covered = F.avg(((a >= lo) & (a <= hi)).cast("double"))
    return df.groupBy(*keys).agg(
        (covered * 100).alias("actual_coverage"),
        F.lit(target * 100).alias("target_coverage"),
        ((covered - target) * 100).alias("coverage_gap"),
        F.avg(width).alias("mean_interval_width"),
        (F.avg(width / F.when(a != 0, a).otherwise(1.0)) * 100).alias("relative_width"),
        F.avg(score).alias("winkler_score"),
    )


def naive_forecast(df: DataFrame, keys: Sequence[str] = (), date: str = "ds", actual: str = "actual", output: str = "naive") -> DataFrame:
    """Yesterday's value; the first row repeats itself."""
    steps = _steps(df, keys, date, {output: actual})
    return steps.withColumn(output, F.coalesce(F.col(output), F.col(actual))).drop("_t", "position")


def value_added(df: DataFrame, keys: Sequence[str] = (), date: str = "ds", actual: str = "actual", predicted: str = "predicted", naive: str | None = None) -> DataFrame:
    """Gain of a model over a naive forecast."""
    if naive is None:
        df, naive = naive_forecast(df, keys, date, actual, "_naive"), "_naive"
    model, plain = _base(actual, predicted), _base(actual, naive)
    t = df.groupBy(*keys).agg(*[d[m].alias(f"{n}_{m}") for n, d in (("model", model), ("naive", plain)) for m in ("mape", "rmse")])
    out = [*keys]
    for m in ("mape", "rmse"):
        gain = F.col(f"naive_{m}") - F.col(f"model_{m}")
        out += [f"model_{m}", f"naive_{m}", gain.alias(f"fva_{m}"), (safe_div(gain, F.col(f"naive_{m}"), 0.0) * 100).alias(f"fva_{m}_pct")]
    return t.select(*out)


def compare_models(df: DataFrame, model: str = "model", keys: Sequence[str] = (), date: str = "ds", actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Metrics per model with average ranks of MAPE and RMSE; one row per (keys, model)."""
    m = forecast_metrics(df, [*keys, model], date, actual, predicted)

    def average_rank(c: str) -> Column:
        by = Window.partitionBy(*keys)
        return F.rank().over(by.orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy(*keys, c)) - 1) / 2.0

    ranked = m.withColumns({"mape_rank": average_rank("mape"), "rmse_rank": average_rank("rmse")})
    return ranked.withColumn("overall_rank", (F.col("mape_rank") + F.col("rmse_rank")) / 2).orderBy(*keys, "overall_rank", model)


def diebold_mariano(df: DataFrame, keys: Sequence[str] = (), date: str = "ds", actual: str = "actual", first: str = "pred1", second: str = "pred2", horizon: int = 1, criterion: str = "MSE") -> DataFrame:
    """Equal-accuracy test of two forecasts; autocovariances up to the horizon less one."""
    a = F.col(actual)
    loss = (lambda e: e * e) if criterion == "MSE" else F.abs
    d = df.withColumn("_d", loss(a - F.col(first)) - loss(a - F.col(second)))
    gamma = F.lit(0.0)
    if horizon > 1:
        d = ranking.in_order(d.withColumn("_t", micros(date)), "_t", "_t", keys)
        d = lagged(d, keys, "position", {f"_d{k}": ("_d", k) for k in range(1, horizon)})
        for k in range(1, horizon):
            pair = F.col(f"_d{k}").isNotNull()
            gamma = gamma + F.covar_samp(F.when(pair, F.col("_d")), F.when(pair, F.col(f"_d{k}")))
    t = d.groupBy(*keys).agg(F.avg("_d").alias("m"), F.count("_d").alias("n"), ((F.var_pop("_d") + 2 * gamma) / F.count("_d")).alias("v"))
    stat = F.when(F.col("v") > 0, F.col("m") / F.sqrt(F.when(F.col("v") > 0, F.col("v"))))
    return t.select(*keys, stat.alias("dm_statistic")).withColumn("p_value", normal_two_sided("dm_statistic")).withColumn("model1_better", F.col("dm_statistic") < 0)


def residual_diagnostics(df: DataFrame, keys: Sequence[str] = (), date: str = "ds", actual: str = "actual", predicted: str = "predicted", lags: int = LJUNG_BOX_LAGS) -> DataFrame:
    """Moments, normality, autocorrelation and changing variance of the residuals."""
    e = df.withColumn("_e", F.col(actual) - F.col(predicted)).where(F.col("_e").isNotNull())
    numbered = ranking.in_order(e.select(*keys, "_e", micros(date).alias("_t")), "_t", "_t", keys)
    shifted = lagged(numbered, keys, "position", {f"_e{k}": ("_e", k) for k in range(1, lags + 1)})
    e0, x = F.col("_e"), F.col("position").cast("double")
    sums = [F.count(e0).alias("n"), F.avg(e0).alias("mean"), F.stddev_pop(e0).alias("std"), F.skewness(e0).alias("skewness"), F.kurtosis(e0).alias("kurtosis")]
    # lag products around the mean, from plain sums: sum(xy) - m sum(x) - m sum(y) + k m^2
    for k in range(1, lags + 1):
        lag, pair = F.col(f"_e{k}"), F.col(f"_e{k}").isNotNull()
        sums += [F.sum(e0 * lag).alias(f"xy{k}"), F.sum(F.when(pair, e0)).alias(f"x{k}"), F.sum(F.when(pair, lag)).alias(f"y{k}"), F.count_if(pair).alias(f"c{k}")]
    stats = shifted.groupBy(*keys).agg(*sums)
    # auxiliary regression of the squared residuals on time
    squares = e0 * e0
    bp = shifted.groupBy(*keys).agg(F.regr_r2(squares, x).alias("_r2"))
    n, m = F.col("n"), F.col("mean")
    total = n * F.col("std") * F.col("std")
    box = F.lit(0.0)
    for k in range(1, lags + 1):
        c = F.col(f"xy{k}") - m * F.col(f"x{k}") - m * F.col(f"y{k}") + F.col(f"c{k}") * m * m
        box = box + F.when(n > k, F.pow(F.try_divide(c, total), 2) / F.nullif(n - k, F.lit(0)))
    jb = n / 6.0 * (F.col("skewness") * F.col("skewness") + F.col("kurtosis") * F.col("kurtosis") / 4.0)
    if keys:
        joined = stats.join(bp, list(keys))
    else:
        joined = stats.withColumn("_one", F.lit(1)).join(bp.withColumn("_one", F.lit(1)), "_one")
    out = joined.select(
        *keys, "mean", "std", "skewness", "kurtosis", jb.alias("jarque_bera_stat"), (n * (n + 2) * box).alias("ljung_box_stat"), (n * F.col("_r2")).alias("breusch_pagan_stat")
    )
    half = chi2_upper_even(F.col("ljung_box_stat"), lags) if lags % 2 == 0 else chi2_upper(F.col("ljung_box_stat"), F.lit(float(lags)))
    return out.withColumns(
        {
            "jarque_bera_pvalue": F.exp(-F.col("jarque_bera_stat") / 2),
            "ljung_box_pvalue": half,
            "breusch_pagan_pvalue": normal_two_sided(F.sqrt("breusch_pagan_stat")),
        }
    ).withColumns(
        {
            "is_normal": F.col("jarque_bera_pvalue") > 0.05,
            "has_autocorrelation": F.col("ljung_box_pvalue") < 0.05,
            "is_homoscedastic": F.col("breusch_pagan_pvalue") > 0.05,
        }
    )


def evaluation_report(df: DataFrame, keys: Sequence[str], date: str = "ds", actual: str = "actual", predicted: str = "predicted", lower: str | None = None, upper: str | None = None) -> DataFrame:
    """Metrics, residual tests, value added and (if given) interval figures, one wide row per key."""
    keys = list(keys)
    out = forecast_metrics(df, keys, date, actual, predicted)
    out = out.join(residual_diagnostics(df, keys, date, actual, predicted), keys, "left")
    out = out.join(value_added(df, keys, date, actual, predicted), keys, "left")
    if lower and upper:
        out = out.join(interval_metrics(df, keys, actual, lower, upper), keys, "left")
    return out
