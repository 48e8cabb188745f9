"""Upper tails of the normal and chi-square distributions for small result frames."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """P(|Z| > |z|)."""
    return z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0)))


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: power series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 1000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


@F.pandas_udf(T.DoubleType())
def chi2_upper(x: pd.Series, df: pd.Series) -> pd.Series:
    """P(chi-square with df degrees of freedom > x)."""
    return pd.Series(
        [None if pd.isna(v) or pd.isna(k) or k <= 0 else _gamma_upper(k / 2, v / 2) for v, k in zip(x, df)],
        dtype="float64",
    )


def chi2_upper_even(x: Column, df: int) -> Column:
    """Same tail for an even number of degrees of freedom: a finite sum, no Python."""
    half = x / 2
    terms = [F.pow(half, F.lit(float(k))) / math.factorial(k) for k in range(df // 2)]
    return F.exp(-half) * sum(terms[1:], terms[0])


def kolmogorov_upper(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 t^2)."""
    t2 = d * d * n * m / (n + m)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * t2),
    )
    return F.when(t2 < 0.04, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
