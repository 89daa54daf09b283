"""The shape of the plans: what is read, what is joined how, what is shared."""

import re

import pytest
from conftest import SMALL

from tallywork.plans import catalog

QUERIES = catalog.load()[0]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_cross_join_and_no_row_udf(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ExistingRDD"):
        assert bad not in text


def test_flagship_reads_only_what_it_needs(spark):
    text = plan(QUERIES["sales_by_category"](spark, SMALL))
    scans = dict(re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?(PushedFilters: \[[^\n]*?\], ReadSchema)", text))
    by_table = {re.sub(r"#\d+L?", "", cols): f for cols, f in scans.items()}
    assert set(by_table) == {
        "l_orderkey,l_partkey,l_extendedprice", "o_orderkey,o_orderstatus", "p_partkey,p_type",
    }
    assert "EqualTo(o_orderstatus,F)" in by_table["o_orderkey,o_orderstatus"]


def test_quantile_shares_its_shuffle(spark):
    df = QUERIES["pareto_share"](spark, SMALL)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan(df) and final.count("FileScan") <= 2


def test_top_n_is_cut_before_the_shuffle(spark):
    assert plan(QUERIES["top_n_per_group"](spark, SMALL)).count("WindowGroupLimit") == 2


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_customers"](spark, SMALL))


def test_bounds_do_not_depend_on_the_number_of_runs(spark):
    df = QUERIES["nth_event"](spark, SMALL)
    assert df.exceptAll(QUERIES["nth_event"](spark, SMALL)).isEmpty()
