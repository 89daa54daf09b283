import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywork.functions import columns as C
from tallywork.operators import charts


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


@pytest.mark.parametrize(
    "raw, want",
    [(" 東京都 ", "東京都"), ("山本 悠人　", "山本 悠人"), ("　a　b　", "ab"), ("\t x\n", "x"), ("", ""), (None, None)],
)
def test_trim(spark, raw, want):
    assert one(spark, C.trim_all("x"), raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [("2024-01-02", dt.date(2024, 1, 2)), ("2024/06/04", dt.date(2024, 6, 4)), ("bad", None), ("", None), ("2024/13/40", None), (None, None)],
)
def test_dates_of_two_spellings(spark, raw, want):
    assert one(spark, C.parse_date("x"), raw) == want


def test_recode(spark):
    m = {"F": "女性", "女性": "女性"}
    assert one(spark, C.recode("x", m, "回答なし"), "F") == "女性"
    assert one(spark, C.recode("x", m, "回答なし"), "??") == "回答なし"
    assert one(spark, C.recode("x", m, "回答なし"), None) == "回答なし"
    assert one(spark, C.recode("x", m), "??") is None


@pytest.mark.parametrize("x, want", [(17, None), (18, "a"), (29, "a"), (30, "b"), (120, "b"), (121, None), (None, None)])
def test_right_closed_bins(spark, x, want):
    assert one(spark, C.bands_upto("x", (17, 29, 120), ("a", "b")), x, "int") == want


@pytest.mark.parametrize("x, want", [(19, "u20"), (20, "20s"), (29, "20s"), (30, "30+"), (None, "30+")])
def test_left_closed_bands_with_else(spark, x, want):
    assert one(spark, C.bands_below("x", (20, 30), ("u20", "20s", "30+")), x, "int") == want


@pytest.mark.parametrize("x, want", [(-1.0, None), (0.0, 0.0), (120.0, 120.0), (999.0, None), (None, None)])
def test_range_rule_keeps_zero(spark, x, want):
    assert one(spark, C.null_outside("x", 0, 120), x, "double") == want


def test_ratio_of_zero(spark):
    assert one(spark, C.ratio("x", F.lit(0)), 5, "int") is None
    assert one(spark, C.ratio("x", F.lit(2)), 5, "int") == 2.5


def test_month_and_weekday(spark):
    day = dt.date(2024, 1, 1)  # a Monday
    row = spark.createDataFrame([(day,)], "x date").select(
        C.year_month("x"), C.month_start("x"), F.weekday("x")
    ).first()
    assert tuple(row) == ("2024-01", day, 0)


def test_thousands(spark):
    assert one(spark, C.thousands("x"), 1234567, "bigint") == "1,234,567"


def test_histogram_top_edge_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (9.99,), (10.0,), (None,)], "x double")
    rows = charts.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 0, 0, 0, 2]
    assert rows[0].left_edge == 0 and rows[-1].right_edge == 10


def test_histogram_of_one_value(spark):
    rows = charts.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert sum(r.n for r in rows) == 2
