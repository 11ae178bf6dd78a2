"""Queries of the llm operators that SQL can express, value by value."""

import pytest

from oracle.check import connect, difference
from shopgrain.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", SQL)
def test_same_as_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), SQL[name], connect(sf_dir)) is None
