"""Every registered query against its SQL in a second engine."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import compare
from tillroll.catalog import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

REGISTERED = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(REGISTERED) and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, con, name):
    assert compare.differences(REGISTERED[name](spark, FOLDER), con, SQL[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["order_dow", "day", "users", "reorder_rate"]
