"""Approximate distinct counts and quantiles from sketches that are stored and merged.

A sketch has a fixed size whatever it has seen, and sketches of parts (days, files, regions) merge to the sketch of
the whole, so a question about a month reads thirty small rows instead of the month. Exact results are the default
everywhere else in the library; these are asked for by name or with ``approx=True``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import double

LG_BUCKETS = 14  # HyperLogLog: 2 ** 14 buckets of 4 to 8 bits
KLL_K = 800  # KLL: about this many values are kept on the lowest level


def distinct_error(lg_buckets: int = LG_BUCKETS, deviations: float = 4.0) -> float:
    """Relative error that a distinct count stays within, but for about one in 15,000 (four deviations)."""
    return deviations * 1.04 / 2 ** (lg_buckets / 2)


def rank_error(k: int = KLL_K, slack: float = 2.0) -> float:
    """Part of all rows by which the rank of a quantile may be off: the published 99 % bound times ``slack``."""
    return slack * 2.296 / k**0.9723


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = (), lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """One HyperLogLog sketch per column and group; NULL is no value. Map-side aggregation leaves one row per task and group.

    Values go in as 64 bits of hash, so every type will do (the sketch itself would pass over empty texts).
    """
    told = [F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))) for c in columns]
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(x, F.lit(lg_buckets)).alias(c) for x, c in zip(told, columns)])


def merged_distinct(sketches: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
    """Distinct counts of the union of all sketches of a group, under the names of the columns."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(F.col(f"`{c}`"))).alias(c) for c in columns])


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str | Column] = (), k: int = KLL_K) -> DataFrame:
    """One KLL sketch (column ``sketch``) and the number of values (``n``) per group."""
    x = double(value)
    kept = df.where(x.isNotNull())
    return kept.groupBy(*by).agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch"), F.count("*").alias("n"))


def merged_quantiles(sketches: DataFrame, probs: Mapping[str, float], by: Sequence[str | Column] = ()) -> DataFrame:
    """``n`` and one value per named probability, of the union of all sketches of a group.

    A value is one that occurs, and its rank is within ``rank_error`` of the wanted one.
    """
    one = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    told = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(name) for name, p in probs.items()]
    return one.select(*[c for c in one.columns if c != "sketch"], *told)
