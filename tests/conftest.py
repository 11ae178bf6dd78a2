import os

import pytest

from shopgrain import build_session
from shopgrain.schemas import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shopgrain-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def make(spark):
    """Rows (dicts, absent columns NULL) of a sales table as a DataFrame."""

    def build(name, *rows):
        schema = TABLES[name].schema
        filled = [tuple(r.get(c) for c in schema.names) for r in rows]
        return spark.createDataFrame(filled, schema)

    return build


@pytest.fixture
def star(make):
    """All eight tables from keyword lists of dicts, empty by default."""

    def build(**rows):
        return {name: make(name, *rows.get(name, [])) for name in TABLES}

    return build


@pytest.fixture
def text(spark):
    """String rows: text(["a", "b"], ("1", "2"), ...)."""

    def build(columns, *rows):
        schema = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame(list(rows), schema)

    return build


def rows_of(df, key):
    """Rows as dicts by one column; the key must be unique."""
    out = {r[key]: r.asDict() for r in df.collect()}
    return out
