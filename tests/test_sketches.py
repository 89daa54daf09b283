"""Sketches of parts that are stored and merged, against exact figures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywork.operators import ordered, sketches


@pytest.fixture(scope="module")
def skewed(spark):
    """Sixty thousand rows over ten days; one user and one value hold a third of them."""
    hot = F.col("id") % 3 == 0
    return spark.range(60_000).select(
        (F.col("id") % 10).alias("day"),
        F.when(hot, -1).otherwise(F.xxhash64("id") % 20_000).alias("user"),
        F.when(hot, 7.5).when(F.col("id") % 50 == 1, None).otherwise(F.abs(F.xxhash64("id", F.lit(1)) % 10_000) / 10).alias("v"),
    )


def test_distinct_counts_of_days_merge(skewed, tmp_path):
    path = str(tmp_path / "daily")
    sketches.distinct_sketches(skewed, ["user", "v"], ["day"]).write.parquet(path)
    daily = skewed.sparkSession.read.parquet(path)
    assert daily.count() == 10
    got = sketches.merged_distinct(daily, ["user", "v"]).first()
    want = skewed.agg(F.count_distinct("user").alias("user"), F.count_distinct("v").alias("v")).first()
    for c in ("user", "v"):
        assert abs(got[c] - want[c]) <= sketches.distinct_error() * want[c]
    # a user who comes on two days is one user: sketches are merged, not added
    assert got.user < 0.8 * sum(r.user for r in sketches.merged_distinct(daily, ["user"], ["day"]).collect())


def test_quantiles_of_days_merge(skewed, tmp_path):
    path = str(tmp_path / "daily")
    sketches.quantile_sketches(skewed, "v", ["day"]).write.parquet(path)
    probs = {"p1": 0.01, "p50": 0.5, "p99": 0.99}
    got = sketches.merged_quantiles(skewed.sparkSession.read.parquet(path), probs).first()
    x = np.sort([r.v for r in skewed.where("v IS NOT NULL").select("v").collect()])
    assert got.n == len(x)
    for name, p in probs.items():
        low, high = np.searchsorted(x, got[name], "left") / len(x), np.searchsorted(x, got[name], "right") / len(x)
        assert low - sketches.rank_error() <= p <= high + sketches.rank_error()


def test_approximate_quantiles_by_group(skewed):
    got = {r.day: r for r in ordered.quantiles(skewed, "v", {"m": 0.5}, ["day"], approx=True).collect()}
    want = {r.day: r for r in ordered.quantiles(skewed, "v", {"m": 0.5}, ["day"]).collect()}
    assert got.keys() == want.keys() and all(got[d].n == want[d].n for d in got)


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([], "day int, v double")
    assert sketches.merged_quantiles(sketches.quantile_sketches(none, "v", ["day"]), {"m": 0.5}, ["day"]).count() == 0
    assert ordered.quantiles(none, "v", {"m": 0.5}, approx=True).first().m is None
    holes = spark.createDataFrame([(1, None)], "day int, v double")
    assert sketches.merged_distinct(sketches.distinct_sketches(holes, ["v"], ["day"]), ["v"]).first().v == 0
