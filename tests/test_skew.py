"""The same results when one user, one order and one product hold a third of the rows."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
import compare

SOURCE = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SOURCE.exists(), reason="no test tables")

NAMES = [
    "stg_orders", "stg_order_products", "fct_orders", "dim_users", "dim_products", "product_funnel",
    "user_retention", "department_performance", "department_dow_cohorts", "daily_product_metrics",
    "derive_reordered", "derive_order_sequence", "scd2_as_of", "upsert_fact", "health_daily",
    "health_top_reorder", "health_department_share", "funnel_cart_composition", "retention_reorder_windows",
    "api_top_products", "product_penetration", "dq_scorecard",
]

# Shuffle joins only, and partitions so small that hot ones are split.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    con.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey)
                  FROM '{SOURCE}/orders.parquet') TO '{out}/orders.parquet' (FORMAT parquet)"""
    )
    con.execute(
        f"""COPY (SELECT * EXCLUDE (pos)
                         REPLACE (CASE WHEN pos % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
                                  CASE WHEN pos % 3 = 1 THEN 11 ELSE l_partkey END AS l_partkey)
                  FROM (SELECT *, row_number() OVER () AS pos FROM '{SOURCE}/lineitem.parquet'))
            TO '{out}/lineitem.parquet' (FORMAT parquet)"""
    )
    con.execute(f"COPY (SELECT * FROM '{SOURCE}/part.parquet') TO '{out}/part.parquet' (FORMAT parquet)")
    return str(out)


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


@pytest.fixture()
def strained(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name in SETTINGS:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", NAMES)
def test_same_result_under_skew(spark, strained, folder, con, name):
    df = entry_points.queries()[name](spark, folder)
    assert compare.differences(df, con, entry_points.oracle_sql()[name]) == []


def test_hot_partitions_are_split(spark, strained, folder):
    df = entry_points.queries()["fct_orders"](spark, folder)
    df.collect()
    assert "skewed" in df._jdf.queryExecution().executedPlan().toString()
