"""Two-sided normal and t tails and the upper chi-square tail.

Spark SQL has no error function, so these are vectorised pandas UDFs. They run
on aggregate rows (one per test), never on raw data. Series and fractions run
until they stop changing; large degrees of freedom use normal-based forms.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

_TINY = 1e-300
#: from here on the normal-based forms are exact to more digits than a double sum would keep
_LARGE = 1e5


def _nonzero(x: float) -> float:
    return x if abs(x) > _TINY else _TINY


def _excess(m: float) -> float:
    """m - log(1 + m) without cancellation near 0."""
    if abs(m) > 0.01:
        return m - math.log1p(m)
    total, power, k = 0.0, m * m, 2
    while abs(power) > 1e-18 * abs(total) * k:
        total += power / k if k % 2 == 0 else -power / k
        power *= m
        k += 1
    return total


def _gamma_q_large(a: float, x: float) -> float:
    """Upper regularised incomplete gamma by its uniform expansion in 1/a, first correction included."""
    m = (x - a) / a
    if m <= -1:
        return 1.0
    eta = math.copysign(math.sqrt(2 * _excess(m)), m)
    if abs(eta) < 0.02:
        first = -1 / 3 + eta * (1 / 12 + eta * (-2 / 135 + eta / 864))
    else:
        first = 1 / m - 1 / eta
    tail = 0.5 * math.erfc(eta * math.sqrt(a / 2))
    return min(1.0, max(0.0, tail + math.exp(-a * eta * eta / 2) / math.sqrt(2 * math.pi * a) * first))


def _gamma_q(a: float, x: float) -> float:
    """Upper regularised incomplete gamma: series below a + 1, continued fraction above."""
    if not (a > 0) or math.isnan(x):
        return math.nan
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    if a > _LARGE:
        return _gamma_q_large(a, x)
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = acc = 1.0 / a
        k = 0
        while term > acc * 1e-17:
            k += 1
            term *= x / (a + k)
            acc += term
        return max(0.0, 1.0 - front * acc)
    b = x + 1 - a
    c, d = 1.0 / _TINY, 1.0 / _nonzero(b)
    frac = d
    k = 0
    while True:
        k += 1
        num = -k * (k - a)
        b += 2
        d = 1.0 / _nonzero(num * d + b)
        c = _nonzero(b + num / c)
        frac *= c * d
        if abs(c * d - 1) < 1e-15:
            return front * frac


def _beta_i(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta by the continued fraction on its fast side."""
    if math.isnan(x) or math.isnan(a) or math.isnan(b):
        return math.nan
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_i(1 - x, b, a)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    c = 1.0
    d = 1.0 / _nonzero(1.0 - (a + b) * x / (a + 1))
    frac = d
    m = 0
    while True:
        m += 1
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / _nonzero(1.0 + num * d)
            c = _nonzero(1.0 + num / c)
            frac *= c * d
        if abs(c * d - 1) < 1e-15:
            return front * frac / a


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def student_two_sided(t: float, df: float) -> float:
    if math.isinf(t) and df > 0:
        return 0.0
    if df > _LARGE:
        # the normal quantile of a t value, to second order in 1 / df
        return normal_two_sided(math.sqrt(df * math.log1p(t * t / df)) * (8 * df + 1) / (8 * df + 3))
    return _beta_i(df / (df + t * t), df / 2, 0.5) if df > 0 else math.nan


def chi2_upper(x: float, df: float) -> float:
    return _gamma_q(df / 2, x / 2)


def _series(fn, *cols: pd.Series) -> pd.Series:
    rows = zip(*[c.astype("float64") for c in cols])
    made = [math.nan if np.isnan(r).any() else fn(*r) for r in rows]
    return pd.Series([None if math.isnan(p) else p for p in made], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _series(normal_two_sided, z)


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _series(student_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return _series(chi2_upper, x, df)
