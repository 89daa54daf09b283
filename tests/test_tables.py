import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywork.operators import regression, series, tables
from tallywork.plans import activity


def cells(spark):
    return spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, "x", 4), ("b", None, 5)], "r string, c string, n int"
    )


def test_wide_fills_and_drops_null_keys(spark):
    got = tables.wide(cells(spark), ["r"], "c", {"x": "cx", "y": "cy"}, "sum", fill=0, value="n").collect()
    assert {tuple(r) for r in got} == {("a", 1, 2), ("b", 3, 0)}
    counted = tables.wide(cells(spark), ["r"], "c", {"x": "cx", "y": "cy"}, "count", fill=0)
    assert {tuple(r) for r in counted.collect()} == {("a", 1, 1), ("b", 1, 0)}


def test_to_wide_refuses_repeated_cells(spark):
    df = spark.createDataFrame([("d", "t", 1.0), ("d", "u", 2.0)], "d string, t string, v double")
    assert tuple(tables.to_wide(df, "d", "t", {"t": "t", "u": "u"}, "v").first()) == ("d", 1.0, 2.0)
    with pytest.raises(PySparkException, match="repeated"):
        tables.to_wide(df.union(df.limit(1)), "d", "t", {"t": "t", "u": "u"}, "v").collect()


def test_a_level_without_a_name_is_an_error(spark):
    names = {"x": "cx"}
    for agg in ("sum", "count"):
        with pytest.raises(PySparkException, match="level without a name: y"):
            tables.wide(cells(spark), ["r"], "c", names, agg, fill=0, value="n").collect()
    df = spark.createDataFrame([("d", "t", 1.0), ("d", "u", 2.0)], "d string, t string, v double")
    with pytest.raises(PySparkException, match="level without a name: u"):
        tables.to_wide(df, "d", "t", {"t": "t"}, "v").collect()
    with pytest.raises(PySparkException, match="level without a name: u"):
        df.withColumns(regression.dummy_columns("t", ["s", "t"], "t")).collect()


def test_spread_join_gives_every_row_once(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7 == 0).alias("k"))
    few = spark.createDataFrame([(True, 1), (False, 2)], "k boolean, v int")
    got = tables.spread_join(rows, few, ["k"]).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {1: 143, 2: 857}


@pytest.fixture
def shuffled(spark):
    """Plain shuffles: no broadcast, and nothing that adaptive execution would mend."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield 32
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_key_with_nine_tenths_of_the_rows_is_spread(spark, shuffled):
    n = 64_000
    rows = spark.range(n).select("id", F.when(F.col("id") % 10 > 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") % 13).alias("v"))
    got = tables.with_group_stats(rows, ["k"], mean=F.avg("v"), n=F.count("*"))
    sizes = got.groupBy(F.spark_partition_id().alias("task")).count().collect()
    # a fair share is 2,000 rows
    assert sum(r["count"] for r in sizes) == n and max(r["count"] for r in sizes) < 4 * n / shuffled
    assert {r.n for r in got.select("k", "n").distinct().collect()} == {1, 9 * n // 10}
    # a light key is not copied
    needs = got.select("k").distinct().select(tables.salts(rows.withColumn("one", F.lit(1)), ["k"], "one").alias("s"), "k")
    told = {r.k: r.s for r in needs.collect()}
    assert told.pop(-1) in (29, 30) and set(told.values()) <= {1, 29, 30} and sum(s > 1 for s in told.values()) < 3


def test_group_stats_of_skewed_tiny_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1.0)] * 50 + [("b", 3.0), (None, 4.0), ("c", None)], "k string, v double")
    got = tables.with_group_stats(df, ["k"], mean=F.avg("v"), sd=F.stddev_samp("v"))
    assert sorted((r.k, r.v, r.mean) for r in got.collect() if r.v is not None) == [("a", 1.0, 1.0)] * 50 + [("b", 3.0, 3.0)]
    assert tables.with_group_stats(df.limit(0), ["k"], mean=F.avg("v")).count() == 0


def test_a_pivot_follows_the_levels_of_the_data(spark, tmp_path, monkeypatch):
    from tallywork.plans import queries_tables
    from tallywork.sources.activity import events

    one = events(spark, "/root/testdata/sf0.001")
    new = one.limit(1).withColumn("kind", F.lit("refund"))
    monkeypatch.setattr(queries_tables, "events", lambda *_: one.unionByName(new))
    got = queries_tables.long_to_wide(spark, "")
    assert set(got.columns) == {"day", "click", "error", "purchase", "refund", "signup", "view"}
    assert got.agg(F.sum("refund")).first()[0] == 1 and got.agg(F.sum("view")).first()[0] == one.where("kind = 'view'").count()


def test_margins(spark):
    got = {(r.r, r.c): r.s for r in tables.with_margins(cells(spark), "r", "c", [F.sum("n").alias("s")]).collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 2, ("b", "x"): 3, ("a", "total"): 3, ("b", "total"): 3,
                   ("total", "x"): 4, ("total", "y"): 2, ("total", "total"): 6}


def test_shares_add_up(spark):
    df = cells(spark).na.drop()
    assert tables.share_within(df, ["r"], "n").groupBy("r").agg(F.sum("share")).agg(F.min("sum(share)")).first()[0] == 1
    assert tables.share_of_all(df, "n").agg(F.sum("share")).first()[0] == pytest.approx(1)


def test_levels_are_sorted_and_bounded(spark):
    assert tables.levels(cells(spark), "c", 2) == ["x", "y"]
    with pytest.raises(ValueError, match="more than 1 levels"):
        tables.levels(cells(spark), "c", most=1)


def test_fan_out_matches_real_joins(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (2,), (4,)], "k int")
    r = tables.fan_out(left, right, "k").first()
    for how, got in (("inner", r.inner_rows), ("left", r.left_join_rows), ("right", r.right_join_rows), ("full", r.full_join_rows)):
        assert got == left.join(right, "k", how).count(), how
    assert (r.left_only_keys, r.right_only_keys, r.repeated_right_keys) == (2, 1, 1)


def test_group_stats_match_rows(spark):
    out = tables.with_group_stats(cells(spark), ["r"], top=F.max("n")).collect()
    assert {(r.r, r.n, r.top) for r in out} == {("a", 1, 2), ("a", 2, 2), ("b", 3, 5), ("b", 5, 5)}


def test_top_per_group(spark):
    out = tables.top_per_group(cells(spark).na.drop(), ["r"], [F.desc("n")], 1).collect()
    assert {(r.r, r.n) for r in out} == {("a", 2), ("b", 3)}


def test_month_totals_list_empty_months(spark):
    days = [dt.date(2024, 1, 31), dt.date(2024, 4, 1)]
    df = spark.createDataFrame([(d, 1) for d in days], "d date, n int")
    got = series.month_totals(df, "d", {"n": F.col("n")}).orderBy("period").collect()
    assert [(r.period.month, r.n) for r in got] == [(1, 1), (2, 0), (3, 0), (4, 1)]
    assert series.calendar(df, "d", "day").count() == 62


def test_returns_and_growth(spark):
    rows = [("t", 1, 100.0), ("t", 2, 110.0), ("t", 3, 99.0), ("u", 1, 50.0), ("u", 2, 55.0), ("u", 3, 49.5), ("w", 1, 5.0), ("w", 3, 6.0)]
    df = spark.createDataFrame(rows, "s string, d int, p double")
    r = series.returns(df, "s", "d", "p")
    assert {(x.s, x.d): round(x.r, 9) for x in r.where("s = 't'").collect()} == {("t", 2): 0.1, ("t", 3): -0.1}
    last = {(x.s, x.d): x.growth for x in series.growth_index(r, "s", "d").collect()}
    assert last[("t", 3)] == pytest.approx(0.99)
    both = series.complete_periods(r, "s", "d")
    assert {x.d for x in both.collect()} == {3}  # w has no return in period 2
    pair = series.pair_correlations(r.where("s <> 'w'"), "s", "d", ["t", "u"]).first()
    assert (pair.a, pair.b) == ("t", "u") and pair.r == pytest.approx(1)


def test_change_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (2, 5), (3, 10)], "t int, v int")
    got = [r.c for r in series.change(df, [], "t", "v", "c").orderBy("t").collect()]
    assert got == [None, None, 1.0]


def test_funnel_divides_totals(spark):
    rows = [("x", 100, 10, 1, 10, 30), ("x", 900, 10, 9, 30, 10), ("y", 100, 0, 0, 5, 0)]
    df = spark.createDataFrame(rows, "channel string, impressions int, clicks int, conversions int, cost int, revenue int")
    got = {r.channel: r for r in activity.funnel(df).collect()}
    assert (got["x"].ctr, got["x"].cvr, got["x"].cpc, got["x"].cpa, got["x"].roas) == (0.02, 0.5, 2.0, 4.0, 1.0)
    assert got["y"].cvr is None and got["y"].roas == 0
    advice = activity.funnel_advice(activity.funnel(df)).first()
    assert (advice.move_from, advice.move_to) == ("y", "x")
