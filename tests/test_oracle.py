"""Every registered query gives the rows of its SQL on DuckDB."""

import pytest
from check import compare, oracle
from conftest import SMALL

from __spark_entry__ import entry
from tallywork.plans import catalog

QUERIES, SQL = catalog.load()


@pytest.fixture(scope="module")
def con():
    return oracle(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert name in SQL
    assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["category", "revenue", "lines"]
    revenue = [r.revenue for r in df.collect()]
    assert revenue and revenue == sorted(revenue, reverse=True)


def test_names_are_the_same_set():
    assert set(SQL) == set(QUERIES)
