"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_points
from oracle.check import connect, difference

# Those of the llm subpackage have tests of their own.
QUERIES = {k: q for k, q in entry_points.queries().items() if k not in entry_points.LLM}
SQL = {k: q for k, q in entry_points.oracle_sql().items() if k not in entry_points.LLM}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), SQL[name], con) is None
