"""Every registered query runs; those with SQL give DuckDB's values."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(SQL) - set(entry_points.LLM_REGISTRY)))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert "CartesianProduct" not in df._jdf.queryExecution().executedPlan().toString()
    assert compare(df, con, SQL[name]) is None


def test_queries_without_sql_belong_to_the_subpackage():
    assert set(QUERIES) - set(SQL) <= set(entry_points.LLM_REGISTRY)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
