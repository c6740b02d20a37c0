"""Every registered query with an oracle, compared with DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    problem, _, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert problem is None


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() == 1
