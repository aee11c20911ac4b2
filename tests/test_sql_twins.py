"""Every query with a SQL twin gives the same rows on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference, type_differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, con, SQL[name]) is None
    assert type_differences(df, con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_model_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_gives_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
