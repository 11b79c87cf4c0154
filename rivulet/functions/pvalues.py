"""Survival functions of chi-square and Student's t for the handful of rows that hold a test."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - total * front
    b = x + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or _TINY)
        c = (b + an / c) or _TINY
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def _beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or _TINY)
    h = d
    for m in range(1, 10_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + top * d) or _TINY)
            c = (1 + top / c) or _TINY
            h *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return front * h


def chi2_survival(x: float, df: float) -> float:
    return _gamma_upper(df / 2, x / 2)


def t_two_sided(t: float, df: float) -> float:
    return _beta(df / 2, 0.5, df / (df + t * t))


@F.pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_survival(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(x, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_sf2(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(t, df)], dtype="float64")
