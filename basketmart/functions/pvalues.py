"""Two-sided p-values of statistics that are already one row each."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"incomplete beta fraction does not settle at a={a}, b={b}, x={x}")


def _log_gamma_step(a: float) -> float:
    """log(gamma(a + 1/2) / gamma(a)); the series keeps the digits that a difference of large logarithms loses."""
    if a < 50.0:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    return 0.5 * math.log(a) + math.log1p(-1 / (8 * a) + 1 / (128 * a**2) + 5 / (1024 * a**3) - 21 / (32768 * a**4))


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom.

    Above a million degrees of freedom by the normal distribution at a corrected t, whose error is of the order 1/df^2.
    """
    if df > 1e6:
        return normal_two_sided(t * (1 - 1 / (4 * df)) / math.sqrt(1 + t * t / (2 * df)))
    a, y = df / 2.0, t * t / (df + t * t)
    if y <= 0.0 or y >= 1.0:
        return 1.0 if y <= 0.0 else 0.0
    front = math.exp(_log_gamma_step(a) - 0.5 * math.log(math.pi) + a * math.log1p(-y) + 0.5 * math.log(y))
    if y < 1.5 / (a + 2.5):
        return 1.0 - front * _beta_fraction(0.5, a, y) / 0.5
    return front * _beta_fraction(a, 0.5, 1.0 - y) / a


def normal_two_sided(z: float) -> float:
    """P(|Z| >= |z|) for the standard normal."""
    return min(1.0, 2.0 * NormalDist().cdf(-abs(z)))


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([student_two_sided(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(t, df)])


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(a) if pd.notna(a) else None for a in z])
