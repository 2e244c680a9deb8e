import datetime as dt

import pytest

from conftest import LINES, ORDERS, PRODUCTS, day
from tillroll.functions.labels import basket_bucket, gap_bucket, user_cohort, user_segment
from tillroll.plans import dashboards, headlines, marts, star
from pyspark.sql import functions as F


def test_fact_grain_and_date_key(shop, by):
    fct = star.fct_orders(**shop)
    rows = by(fct, "order_id", "product_id")
    assert len(rows) == fct.count() == 6
    assert rows[(2, 30)]["department_id"] == 5 and rows[(2, 30)]["order_date_id"] == 20240115


def test_fact_drops_lines_without_order_or_product(spark, shop):
    extra = shop["order_products"].union(spark.createDataFrame([(99, 10, 1, 0), (1, 999, 3, 0)], LINES))
    assert star.fct_orders(shop["orders"], extra, shop["products"]).count() == 6


def test_dim_users(shop, by):
    users = by(star.dim_users(shop["orders"], shop["order_products"]), "user_id")
    assert users[100]["total_orders"] == 2
    assert users[100]["reorder_rate"] == pytest.approx(2 / 3)
    assert users[100]["avg_days_between_orders"] == 8
    assert users[100]["days_since_first_order"] == 1
    # An order without lines keeps its user; no product means no rate.
    assert users[300]["total_orders"] == 1 and users[300]["reorder_rate"] is None
    assert users[300]["avg_days_between_orders"] is None
    assert users[200]["reorder_rate"] == 0


def test_average_gap_is_weighted_by_lines(spark, shop, by):
    orders = spark.createDataFrame(
        [(1, 1, 1, 0, 0, 2, day(0)), (2, 1, 2, 0, 0, 10, day(1)), (3, 1, 3, 0, 0, 30, day(2))], ORDERS
    )
    lines = spark.createDataFrame([(1, 10, 1, 0), (1, 20, 2, 0), (1, 30, 3, 0), (2, 10, 1, 0)], LINES)
    # (2*3 + 10*1 + 30*1) / 5 = 9.2
    assert by(star.dim_users(orders, lines), "user_id")[1]["avg_days_between_orders"] == 9


def test_users_without_an_id_form_a_group(spark, shop, by):
    orders = shop["orders"].union(spark.createDataFrame([(9, None, 1, 0, 0, None, day(0))], ORDERS))
    lines = shop["order_products"].union(spark.createDataFrame([(9, 10, 1, 1)], LINES))
    assert by(star.dim_users(orders, lines), "user_id")[None]["reorder_rate"] == 1


@pytest.mark.parametrize("orders,segment", [(1, "low_frequency"), (4, "low_frequency"), (5, "medium"), (9, "medium"), (10, "high_frequency")])
def test_segments(spark, orders, segment):
    assert spark.range(1).select(user_segment(F.lit(orders))).first()[0] == segment


@pytest.mark.parametrize(
    "orders,cohort",
    [(1, "single_order"), (2, "light_user"), (5, "light_user"), (6, "medium_user"), (20, "medium_user"), (21, "heavy_user")],
)
def test_cohorts(spark, orders, cohort):
    assert spark.range(1).select(user_cohort(F.lit(orders))).first()[0] == cohort


def test_gap_buckets(spark):
    cases = {0: "1-7 days", 7: "1-7 days", 8: "8-14 days", 14: "8-14 days", 15: "15-30 days", 30: "15-30 days", 31: "30+ days", None: "First Order"}
    df = spark.createDataFrame([(d,) for d in cases], "d int").select("d", gap_bucket(F.col("d")).alias("b"))
    assert {r.d: r.b for r in df.collect()} == cases


def test_basket_buckets(spark):
    cases = {1: "1 item", 2: "2-5 items", 5: "2-5 items", 6: "6-10 items", 10: "6-10 items", 11: "11-20 items", 20: "11-20 items", 21: "20+ items"}
    df = spark.createDataFrame([(d,) for d in cases], "d int").select("d", basket_bucket(F.col("d")).alias("b"))
    assert {r.d: r.b for r in df.collect()} == cases


def test_dim_products(shop, by):
    products = by(star.dim_products(shop["products"], shop["order_products"]), "product_id")
    assert products[10]["reorder_count"] == 1 and products[10]["reorder_rate"] == pytest.approx(1 / 3)
    assert products[40]["reorder_count"] == 0 and products[40]["reorder_rate"] == 0
    assert products[40]["aisle_name"] == "Aisle_3" and products[40]["department_name"] == "Department_9"


def test_dim_products_with_real_names(spark, shop, by):
    aisles = spark.createDataFrame([(1, "fruit")], "aisle_id int, aisle_name string")
    departments = spark.createDataFrame([(5, "produce")], "department_id int, department_name string")
    products = by(star.dim_products(shop["products"], shop["order_products"], aisles, departments), "product_id")
    assert products[10]["aisle_name"] == "fruit" and products[10]["department_name"] == "produce"
    assert products[20]["aisle_name"] == "Aisle_2"


def test_dim_departments_and_aisles(spark, shop, by):
    departments = spark.createDataFrame([(5, "a"), (6, "b"), (9, "c"), (11, "d")], "department_id int, department_name string")
    got = by(star.dim_departments(departments, shop["products"], shop["order_products"]), "department_id")
    assert (got[5]["total_products"], got[5]["total_orders"]) == (2, 3)
    assert (got[9]["total_products"], got[9]["total_orders"]) == (1, 0)
    assert (got[11]["total_products"], got[11]["total_orders"]) == (0, 0)
    split = spark.createDataFrame([(1, "x", 1, 8), (2, "y", 1, 3), (3, "z", 2, 4)], PRODUCTS)
    aisles = spark.createDataFrame([(1, "one"), (2, "two"), (3, "bare")], "aisle_id int, aisle_name string")
    homes = by(star.dim_aisles(aisles, split), "aisle_id")
    assert [homes[i]["department_id"] for i in (1, 2, 3)] == [3, 4, None]


def test_dim_time(shop, by):
    days = by(star.dim_time(shop["orders"]), "date_id")
    assert len(days) == 9
    sunday = days[20240107]
    assert (sunday["order_dow"], sunday["day_of_week_name"], sunday["is_weekend"]) == (0, "Sunday", 1)
    assert (sunday["week_of_year"], sunday["quarter"]) == (1, 1)


def test_product_funnel(shop, by):
    funnel = by(marts.product_funnel(**shop), "metric_date", "order_dow")
    first = funnel[(day(6), 0)]
    assert (first["daily_users"], first["daily_orders"], first["daily_products_added"]) == (2, 2, 2)
    second = funnel[(day(14), 1)]
    assert second["orders_with_reorders"] == 1 and second["reorder_rate"] == pytest.approx(2 / 3)
    bare = funnel[(day(8), 2)]
    assert (bare["daily_orders"], bare["daily_products_added"], bare["reorder_rate"]) == (1, 0, 0)


def test_funnel_counts_unknown_products_in_the_rate_only(spark, shop, by):
    lines = shop["order_products"].union(spark.createDataFrame([(4, 777, 1, 1)], LINES))
    row = by(marts.product_funnel(shop["orders"], lines, shop["products"]), "metric_date")[day(8)]
    assert row["daily_products_added"] == 0 and row["reorder_rate"] == 1 and row["daily_reordered_items"] == 1


def test_anchored_funnel(shop, by):
    got = by(marts.product_funnel(**shop, anchor=dt.date(2024, 6, 1)), "metric_date")
    assert set(got) == {dt.date(2024, 6, d) for d in (2, 3, 4, 5)}


def test_user_retention(shop, by):
    got = by(marts.user_retention(shop["orders"]), "user_id")
    assert got[100]["user_cohort"] == "light_user" and got[100]["order_span"] == 1


def test_department_performance(shop, by):
    got = by(marts.department_performance(**shop), "department_id")
    assert (got[5]["total_orders"], got[5]["unique_users"], got[5]["unique_products"]) == (3, 2, 2)
    assert got[5]["orders_with_reorders_pct"] == pytest.approx(1 / 3)
    assert got[9]["total_orders"] == 0 and got[9]["reorder_rate"] == 0 and got[9]["orders_with_reorders_pct"] == 0
    assert [got[d]["order_volume_rank"] for d in (5, 6, 9)] == [1, 2, 3]
    assert [got[d]["reorder_rank"] for d in (5, 6, 9)] == [1, 1, 2]


def test_rank_ties_and_tiers(spark, by):
    # Departments 1..12 with 12..1 orders, departments 4 and 5 tied.
    orders, lines, products = [], [], []
    n = 0
    for dept in range(1, 13):
        products.append((dept, f"p{dept}", 1, dept))
        for _ in range(8 if dept in (4, 5) else 13 - dept):
            n += 1
            orders.append((n, n, 1, 0, 0, None, day(0)))
            lines.append((n, dept, 1, 0))
    got = by(
        marts.department_performance(
            spark.createDataFrame(orders, ORDERS), spark.createDataFrame(lines, LINES), spark.createDataFrame(products, PRODUCTS)
        ),
        "department_id",
    )
    assert [got[d]["order_volume_rank"] for d in (3, 4, 5, 6, 7)] == [1 + 2, 4, 4, 5, 6]
    assert got[6]["performance_tier"] == "top_tier" and got[7]["performance_tier"] == "mid_tier"
    assert got[12]["order_volume_rank"] == 11 and got[12]["performance_tier"] == "emerging"


def test_department_dow_keeps_unsold_products(shop, by):
    got = by(marts.department_dow_cohorts(**shop), "department_id", "order_dow")
    assert got[(9, None)]["orders_by_dow"] == 0 and got[(9, None)]["reorder_rate_by_dow"] is None
    assert got[(5, 1)]["users_by_dow"] == 1 and got[(5, 1)]["reorder_rate_by_dow"] == pytest.approx(0.5)


def test_daily_metrics_sum_back_to_the_fact(shop):
    fct = star.fct_orders(**shop)
    daily = marts.daily_product_metrics(fct, star.dim_products(shop["products"], shop["order_products"]))
    assert daily.agg(F.sum("daily_orders")).first()[0] == fct.count()
    one = marts.product_day_drilldown(daily, 10, day(6)).first()
    assert (one.daily_orders, one.daily_unique_users, one.daily_reorder_rate) == (2, 2, 0)


def test_empty_tables(empty, spark):
    fct = star.fct_orders(**empty)
    users = star.dim_users(empty["orders"], empty["order_products"])
    products = star.dim_products(empty["products"], empty["order_products"])
    for df in (
        fct,
        users,
        products,
        star.dim_time(empty["orders"]),
        marts.product_funnel(**empty),
        marts.user_retention(empty["orders"]),
        marts.department_performance(**empty),
        marts.department_dow_cohorts(**empty),
        marts.daily_product_metrics(fct, products),
        dashboards.health_daily(fct),
        dashboards.health_user_segments(users),
        dashboards.funnel_cart_composition(fct),
        headlines.product_penetration(fct),
    ):
        assert df.count() == 0
    assert headlines.api_metrics(fct).first().reorder_rate is None
    assert headlines.reorder_rate_overall(fct).first().reordered_items == 0


def test_shares_sum_to_one_hundred(shop):
    fct = star.fct_orders(**shop)
    users = star.dim_users(shop["orders"], shop["order_products"])
    for df, column in (
        (dashboards.retention_reorder_windows(fct), "pct_of_orders"),
        (dashboards.health_user_segments(users), "pct_of_users"),
    ):
        assert sum(r[column] for r in df.collect()) == pytest.approx(100, abs=0.05)


def test_bucket_rows_come_in_reporting_order(shop):
    fct = star.fct_orders(**shop)
    assert [r.reorder_window for r in dashboards.retention_reorder_windows(fct).collect()] == ["First Order", "8-14 days"]
    assert [r.order_size for r in dashboards.funnel_cart_composition(fct).collect()] == ["1 item", "2-5 items"]


def test_habit_products_need_every_line_reordered(spark, by):
    products = spark.createDataFrame([(1, "always", 1, 1), (2, "mostly", 1, 1)], PRODUCTS)
    orders = spark.createDataFrame([(i, i, 1, 0, 0, None, day(0)) for i in range(1, 13)], ORDERS)
    lines = spark.createDataFrame(
        [(i, 1, 1, 1) for i in range(1, 13)] + [(i, 2, 2, int(i > 1)) for i in range(1, 13)], LINES
    )
    fct = star.fct_orders(orders, lines, products)
    assert headlines.habit_products(fct).first().asDict() == {"products": 1, "avg_orders": 12.0}
    assert [r.product_id for r in headlines.sticky_products(fct).collect()] == [1, 2]


def test_peak_day_takes_the_earlier_of_equals(shop):
    fct = star.fct_orders(**shop)
    peak = headlines.peak_day(fct).first()
    assert (peak.order_dow, peak.day, peak.users) == (0, "Sunday", 2)
