"""Aggregate and closed-form statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .columns import double, ratio

# Two-sided 5 % normal quantile and the matching chi-square (1 df) limit.
Z_95 = 1.96
CHI2_1_95 = 3.841
ALPHA = 0.05


def adjusted_skewness(c: Column | str) -> Column:
    """Sample skewness with the small-sample adjustment (NULL below three values)."""
    x = double(c)
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def adjusted_kurtosis(c: Column | str) -> Column:
    """Sample excess kurtosis with the small-sample adjustment (NULL below four values)."""
    x = double(c)
    n = F.count(x).cast("double")
    return F.when(
        n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6)
    )


def total(c: Column | str) -> Column:
    """Sum that is 0, not NULL, when there is nothing to add."""
    return F.coalesce(F.sum(c), F.lit(0))


def share_where(cond: Column) -> Column:
    """Share of rows for which ``cond`` holds; rows where it is NULL leave the base."""
    return F.avg(F.when(cond, 1.0).when(~cond, 0.0))


def mean_se(sd: Column, n: Column) -> Column:
    return ratio(sd, F.sqrt(double(n)))


def proportion_se(p: Column, n: Column) -> Column:
    return F.sqrt(F.try_divide(p * (1 - p), double(n)))


def welch_t(m1: Column, v1: Column, n1: Column, m2: Column, v2: Column, n2: Column) -> Column:
    return F.try_divide(m1 - m2, F.sqrt(v1 / n1 + v2 / n2))


def welch_df(v1: Column, n1: Column, v2: Column, n2: Column) -> Column:
    a, b = v1 / n1, v2 / n2
    return F.try_divide((a + b) * (a + b), a * a / (n1 - 1) + b * b / (n2 - 1))


def pooled_z(x1: Column, n1: Column, x2: Column, n2: Column) -> Column:
    """Two-proportion z of sample 2 against sample 1 with a pooled variance."""
    p = ratio(x1 + x2, n1 + n2)
    se = F.sqrt(p * (1 - p) * (F.try_divide(F.lit(1.0), double(n1)) + F.try_divide(F.lit(1.0), double(n2))))
    return F.try_divide(ratio(x2, n2) - ratio(x1, n1), se)


def chi2_2x2(a: Column, b: Column, c: Column, d: Column, yates: bool = True) -> Column:
    """Chi-square of the table [[a, b], [c, d]]; NULL when a margin is empty.

    The correction is limited to the distance itself, so it never turns past zero.
    """
    a, b, c, d = (double(x) for x in (a, b, c, d))
    n = a + b + c + d
    gap = F.abs(a * d - b * c)
    if yates:
        gap = gap - F.least(n / 2, gap)
    return F.try_divide(n * gap * gap, (a + b) * (c + d) * (a + c) * (b + d))
