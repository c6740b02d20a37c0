"""Queries of the folder that SQL can express, against DuckDB on the smallest tables."""

import pytest

from broadsheet.llm import queries
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, name):
    problem, _, _ = compare(spark, connect(SF), name, queries.queries()[name], queries.oracle_sql()[name], SF)
    assert problem is None
