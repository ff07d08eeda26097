"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import importlib

import pytest
from conftest import SMALL

from stopwise_testbed.compare import check, connect
from stopwise_testbed.oracle import ORACLE
from stopwise_testbed.queries import REGISTRY


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(spark, connection, name):
    assert check(spark, connection, name, SMALL) is None


def test_every_query_has_its_sql():
    assert sorted(REGISTRY) == sorted(ORACLE)


def test_entry_points(spark):
    entry = importlib.import_module("__spark_entry__")
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"event_type", "n"}
    assert REGISTRY.keys() <= entry.queries().keys()
    assert ORACLE.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()
