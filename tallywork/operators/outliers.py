"""Fences, sigma flags and threshold rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import double, ratio
from .ordered import quantiles, value_groups
from .profile import with_scalars
from .tables import with_group_stats

# Fence and sigma multipliers.
FENCE = 1.5
SIGMAS = 3


def fences(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact quartiles and the fences one and a half ranges beyond them."""
    q = quantiles(df, value, {"q1": 0.25, "q3": 0.75}, by)
    reach = FENCE * (F.col("q3") - F.col("q1"))
    return q.withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach})


def fence_outliers(df: DataFrame, value: str) -> DataFrame:
    """Rows outside the fences."""
    x = double(value)
    marked = with_scalars(df, fences(df, value).select("lower", "upper"))
    return marked.where((x < F.col("lower")) | (x > F.col("upper"))).drop("lower", "upper")


def fence_summary(df: DataFrame, value: str) -> DataFrame:
    """Fences with how many rows lie above and below, their share, and the largest value."""
    x, n = double(value), F.col("n")
    counts = value_groups(df, value)
    marked = with_scalars(counts, fences(df, value).drop("n"))
    rows_where = lambda cond: F.sum(F.when(cond, n).otherwise(F.lit(0)))
    return marked.agg(
        *[F.max(c).alias(c) for c in ("q1", "q3", "lower", "upper")],
        F.sum(n).alias("n"),
        rows_where(x > F.col("upper")).alias("n_high"),
        rows_where(x < F.col("lower")).alias("n_low"),
        F.max(x).alias("largest"),
    ).withColumn("high_share", ratio("n_high", "n"))


def sigma_flags(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "is_outlier") -> DataFrame:
    """Rows further than three standard deviations from their group's mean."""
    x = double(value)
    mean, sd = F.avg(x), F.stddev_samp(x)
    if by:
        stats = with_group_stats(df, by, mean=mean, sd=sd)
    else:
        stats = with_scalars(df, df.agg(mean.alias("mean"), sd.alias("sd")))
    far = F.coalesce(F.abs(x - F.col("mean")) > SIGMAS * F.col("sd"), F.lit(False))
    return stats.withColumn(out, far)


def threshold_rule(
    df: DataFrame, flag: str, measures: Sequence[str]
) -> DataFrame:
    """Precision and recall of "every measure above its median among the flagged rows"."""
    positives = df.where(F.col(flag) == 1)
    marked = df
    for m in measures:
        marked = with_scalars(marked, quantiles(positives, m, {f"cut_{m}": 0.5}).select(f"cut_{m}"))
    rule = F.lit(True)
    for m in measures:
        rule = rule & (F.coalesce(double(m) > F.col(f"cut_{m}"), F.lit(False)))
    return (
        marked.agg(
            *[F.max(f"cut_{m}").alias(f"cut_{m}") for m in measures],
            F.count_if(rule).alias("hits"),
            F.count_if(rule & (F.col(flag) == 1)).alias("true_hits"),
            F.count_if(F.col(flag) == 1).alias("positives"),
        )
        .withColumn("precision", ratio("true_hits", "hits"))
        .withColumn("recall", ratio("true_hits", "positives"))
    )
