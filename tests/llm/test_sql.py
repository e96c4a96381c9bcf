"""Queries that SQL can express, against DuckDB."""

import pytest
from oracle import compare, connect

from textforge.llm.queries import ORACLES, REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(REGISTRY[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None
