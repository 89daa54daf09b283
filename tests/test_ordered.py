"""Ordered operators against pandas and NumPy, on data where one group or value is a third of all."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywork.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "g": np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcde"), n)),
            "at": np.where(rng.random(n) < 0.35, 50, rng.integers(0, 100, n)),  # one crowded time
            "v": np.where(rng.random(n) < 0.34, 7.0, np.round(rng.gamma(2, 30, n), 2)),  # one crowded value
        }
    )
    pdf["holed"] = pdf["v"].where(rng.random(n) > 0.3)
    return pdf, spark.createDataFrame(pdf).withColumn("holed", F.nanvl("holed", F.lit(None).cast("double"))).cache()


PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def test_quantiles_whole_and_grouped(skewed):
    pdf, df = skewed
    row = ordered.quantiles(df, "v", PROBS).first()
    assert row.n == len(pdf)
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(pdf["v"].quantile(p))
    want = pdf.groupby("g")["holed"].quantile(list(PROBS.values())).unstack()
    for r in ordered.quantiles(df, "holed", PROBS, ["g"]).collect():
        assert [r[k] for k in PROBS] == pytest.approx(list(want.loc[r.g]))


def test_quantile_of_few_values(spark):
    df = spark.createDataFrame([(400.0,), (420.0,), (450.0,), (480.0,), (9000.0,)], "v double")
    assert ordered.quantiles(df, "v", {"m": 0.5, "q": 0.9}).first()[1:] == pytest.approx((450.0, 5592.0))
    one = spark.createDataFrame([(3.0,)], "v double")
    assert ordered.quantiles(one, "v", {"a": 0.25, "b": 1.0}).first()[1:] == (3.0, 3.0)
    none = one.where("v > 5")
    assert ordered.quantiles(none, "v", {"a": 0.25}).first().a is None


@pytest.mark.parametrize("fraction", [0.0001, 0.1, 0.2, 0.5, 1.0])
def test_top_share_reaches_into_ties(skewed, fraction):
    pdf, df = skewed
    ranked = pdf["v"].sort_values(ascending=False).reset_index(drop=True)
    k = max(1, int(len(ranked) * fraction))
    row = ordered.top_share(df, "v", [fraction]).first()
    assert row.head_rows == k
    assert row.head_sum == pytest.approx(ranked.head(k).sum())
    assert row.total_sum == pytest.approx(ranked.sum())


def test_ladder_counts(skewed):
    pdf, df = skewed
    got = {(r.g, r.v): (r.n, r.n_below, r.n_total) for r in ordered.value_ladder(df, "v", ["g"]).collect()}
    for (g, v), part in pdf.groupby(["g", "v"]):
        same = pdf[pdf["g"] == g]["v"]
        assert got[(g, v)] == (len(part), int((same < v).sum()), len(same))


def test_ranges_rise_and_split_a_crowded_time(skewed):
    pdf, df = skewed
    rows = ordered.with_ranges(df, ["at", "id"]).orderBy("at", "id").collect()
    buckets = [r.bucket for r in rows]
    assert buckets == sorted(buckets)
    sizes = pd.Series(buckets).value_counts()
    assert sizes.max() < 0.2 * len(pdf)  # the crowded time alone holds more than a third
    assert len({r.bucket for r in rows if r["at"] == 50}) > 2


def test_running_position_and_sum(skewed):
    pdf, df = skewed
    out = ordered.running(ordered.with_ranges(df, ["at", "id"]), ["g"], ["at", "id"], "bucket", {"s": "holed"})
    want = pdf.sort_values(["g", "at", "id"])
    want = want.assign(p=want.groupby("g").cumcount() + 1, s=want["holed"].fillna(0).groupby(want["g"]).cumsum())
    want = want.set_index("id")
    rows = out.collect()
    assert len(rows) == len(pdf)
    for r in rows:
        assert r.position == want.loc[r.id, "p"]
        assert r.s == pytest.approx(want.loc[r.id, "s"])


def test_running_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, at int")
    out = ordered.running(ordered.with_ranges(df, ["at"]), ["g"], ["at"], "bucket")
    assert sorted((str(r.g), r.position) for r in out.collect()) == [("None", 1), ("None", 2), ("a", 1)]


@pytest.mark.parametrize("groups", [["g"], []])
def test_interpolate_and_fill_like_pandas(skewed, groups):
    pdf, df = skewed
    ranged = ordered.with_ranges(df, ["at", "id"])
    want = pdf.sort_values([*groups, "at", "id"])
    series = want.groupby(groups)["holed"] if groups else want["holed"]
    straight = series.transform(lambda s: s.interpolate(method="linear"))
    carried = series.ffill()
    for name, fn, expect in (
        ("line", ordered.interpolate, straight),
        ("carry", ordered.forward_fill, carried),
    ):
        expect = dict(zip(want["id"], expect))
        for r in fn(ranged, groups, ["at", "id"], "bucket", "holed", name).collect():
            e = expect[r.id]
            assert (r[name] is None and np.isnan(e)) or r[name] == pytest.approx(e)


def test_interpolate_edges(spark):
    rows = [(0, None), (1, 1.0), (2, None), (3, None), (4, 4.0), (5, None)]
    df = ordered.with_ranges(spark.createDataFrame(rows, "at int, v double"), ["at"])
    got = {r["at"]: r.f for r in ordered.interpolate(df, [], ["at"], "bucket", "v", "f").collect()}
    assert [got[i] for i in range(6)] == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


@pytest.mark.parametrize("block", [3, 7, 100_000])
def test_trailing_over_blocks(skewed, block):
    pdf, df = skewed
    numbered = ordered.running(ordered.with_ranges(df, ["at", "id"]), ["g"], ["at", "id"], "bucket")
    out = ordered.trailing(
        numbered, ["g"], "position", 7,
        {
            "m": lambda w: F.avg("holed").over(w.rowsBetween(-6, 0)),
            "p": lambda w: F.lag("v").over(w),
        },
        block_rows=block,
    )
    want = pdf.sort_values(["g", "at", "id"])
    mean = want.groupby("g")["holed"].transform(lambda s: s.rolling(7, min_periods=1).mean())
    back = want.groupby("g")["v"].shift()
    mean, back = dict(zip(want["id"], mean)), dict(zip(want["id"], back))
    rows = out.collect()
    assert len(rows) == len(pdf)
    for r in rows:
        assert (r.m is None and np.isnan(mean[r.id])) or r.m == pytest.approx(mean[r.id])
        assert (r.p is None and np.isnan(back[r.id])) or r.p == back[r.id]


def test_rows_without_a_first_value_are_cut_by_the_second(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("at"), "id")
    rows = ordered.with_ranges(df, ["at", "id"]).orderBy("at", "id").collect()
    assert [r.bucket for r in rows] == sorted(r.bucket for r in rows)
    assert len({r.bucket for r in rows if r["at"] is None}) > 3


def spread_of(df, order):
    """Rows per range."""
    return sorted(r["count"] for r in ordered.with_ranges(df, order).groupBy("bucket").count().collect())


def test_ranges_of_a_first_column_without_values(spark):
    n = 4000
    df = spark.range(n).repartition(4).select(F.lit(None).cast("double").alias("a"), (F.col("id") * 0.5).alias("b"))
    sizes = spread_of(df, ["a", "b"])
    assert sum(sizes) == n and max(sizes) < n / 4


def test_ranges_where_one_task_has_no_values(spark):
    empty = spark.range(0, 1000, 1, 1).select(F.lit(None).cast("double").alias("a"), F.col("id").alias("b"))
    full = spark.range(0, 3000, 1, 3).select(F.col("id").cast("double").alias("a"), F.col("id").alias("b"))
    df = empty.unionByName(full)
    made = ordered.with_ranges(df, ["a", "b"])
    holes = [r["count"] for r in made.where("a IS NULL").groupBy("bucket").count().collect()]
    assert sum(holes) == 1000 and max(holes) <= 700 and len(holes) > 2


def test_ranges_of_one_value_with_nine_tenths_of_the_rows(spark):
    n = 5000
    df = spark.range(n).repartition(4).select(F.when(F.col("id") % 10 > 0, 7.0).otherwise(F.col("id") * 0.1).alias("a"), F.col("id").alias("b"))
    sizes = spread_of(df, ["a", "b"])
    assert sum(sizes) == n and max(sizes) < n / 3
    got = ordered.running(ordered.with_ranges(df, ["a", "b"]), [], ["a", "b"], "bucket").select("position").collect()
    assert sorted(r.position for r in got) == list(range(1, n + 1))

