"""Tail probabilities Spark has no function for."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 300):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + top / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return value


def _beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


@F.pandas_udf(T.DoubleType())
def f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Probability above `f` for d1 and d2 degrees of freedom; meant for result rows, not data."""
    return pd.Series([_beta(b / 2, a / 2, b / (b + a * x)) for x, a, b in zip(f, d1, d2)])


# Coefficients of the rational fit below, constant term first.
ERFC_TERMS = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]


def erfc(x: Column) -> Column:
    """Complementary error function by a rational fit (relative error below 1.2e-7)."""
    t = 1 / (1 + F.abs(x) / 2)
    poly = F.lit(ERFC_TERMS[-1])
    for c in reversed(ERFC_TERMS[:-1]):
        poly = poly * t + c
    y = t * F.exp(-x * x + poly)
    return F.when(x >= 0, y).otherwise(2 - y)
