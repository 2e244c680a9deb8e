"""The shape of the plans: what must not appear in them at scale."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from tillroll.catalog import Store

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# Queries that write files while they are built are covered by their parts.
LAZY = [
    "fct_orders", "dim_users", "dim_products", "dim_departments", "dim_aisles", "dim_time", "product_funnel",
    "user_retention", "department_performance", "department_dow_cohorts", "daily_product_metrics", "scd2_merge",
    "scd2_as_of", "derive_reordered", "derive_order_sequence", "upsert_fact", "health_daily",
    "health_top_reorder", "health_department_share", "funnel_cart_composition", "api_metrics", "api_top_products",
    "product_penetration", "test_accepted_range", "dq_scorecard", "pii_scan", "validate_tables",
]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """What a large catalogue would get: shuffle joins wherever no bound is proven."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


@pytest.mark.parametrize("name", LAZY)
def test_no_product_joins_and_no_python(spark, no_broadcast, name):
    plan = executed(entry_points.queries()[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in plan


def test_nothing_is_broadcast_by_hint(spark, no_broadcast):
    assert "Broadcast" not in executed(entry_points.queries()["fct_orders"](spark, FOLDER))


def test_columns_and_filters_reach_the_scan(spark):
    plan = executed(Store(spark, FOLDER).fct_orders.groupBy("order_dow").count())
    scans = [line for line in plan.splitlines() if "FileScan" in line and "p_partkey" not in line]
    wanted = ("order_id:bigint,product_id:bigint", "order_id:bigint,order_dow:int")
    assert len(scans) == 2 and all(any(f"struct<{w}>" in line for w in wanted) for line in scans)
    assert all("IsNotNull(order_id)" in line for line in scans)


def test_drilldown_filter_reaches_the_scan(spark):
    store = Store(spark, FOLDER)
    plan = executed(store.daily_product_metrics.where("product_id = 7").select("order_date", "daily_orders"))
    assert "EqualTo(product_id,7)" in plan


def test_unused_dimension_work_is_dropped(spark):
    plan = executed(Store(spark, FOLDER).dim_products.select("product_id", "product_name"))
    assert "reordered" not in plan


def test_marts_share_one_join_of_orders_and_lines(spark):
    """Over the shared table no mart joins orders with lines, and none multiplies lines to count distincts."""
    shared = spark.createDataFrame([], Store(spark, FOLDER).order_lines.schema)
    marts = Store(spark, FOLDER)
    marts.__dict__["order_lines"] = shared
    for name in ("fct_orders", "dim_users", "product_funnel", "department_performance", "department_dow_cohorts"):
        plan = getattr(marts, name)._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Relation" in line and "user_id#" in line and "parquet" in line], name
        assert "Expand" not in plan, name
    for name in ("health_daily", "health_department_share", "funnel_department", "api_metrics", "daily_product_metrics"):
        plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan, name
