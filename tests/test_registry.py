"""Every registered query against its SQL in another engine, on the smallest tables."""

import duckdb
import pytest
from check import compare, connect
from conftest import TABLES

from __spark_entry__ import entry, oracle_sql, queries
from pictolytics.plans.oracles import ORACLES
from pictolytics.plans.registry import REGISTRY


@pytest.fixture(scope="module")
def db() -> duckdb.DuckDBPyConnection:
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, TABLES, name).startswith("equal")


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"emoji", "usage"}
