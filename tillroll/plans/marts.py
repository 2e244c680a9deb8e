"""Metric marts over the staging tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.labels import performance_tier, user_cohort
from tillroll.functions.numbers import join_groups, per_order, percent, ratio, reordered_items, rows
from tillroll.plans.star import baskets, order_lines, sold
from tillroll.sources.staging import anchored_dates


def _zero(column: str):
    return F.coalesce(F.col(column), F.lit(0))


def product_funnel(
    orders: DataFrame,
    order_products: DataFrame,
    products: DataFrame,
    anchor: dt.date | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Users, orders and products per (day, day of week).

    The day is the order date, or with ``anchor`` the anchor day plus order_id modulo 365.
    Order counts come from one row per order, product counts from one row per (day, product):
    a single pass counting all five distincts would multiply the lines sixfold.
    """
    if anchor is not None:
        orders, lines = anchored_dates(orders, anchor), None
    day = ["metric_date", "order_dow"]
    lines = order_lines(orders, order_products) if lines is None else lines
    dated = lines.withColumnRenamed("order_date", "metric_date")
    activity = (
        baskets(dated, "user_id", *day)
        .groupBy(*day)
        .agg(
            F.countDistinct("user_id").alias("daily_users"),
            rows().alias("daily_orders"),
            F.count(F.when(F.col("again") > 0, 1)).alias("orders_with_reorders"),
        )
    )

    picks = sold(dated).groupBy(*day, "product_id").agg(reordered_items().alias("again"))
    known = products.select("product_id").distinct().withColumn("known", F.lit(True))
    choice = (
        picks.join(known, "product_id", "left")
        .groupBy(*day)
        .agg(
            F.count("known").alias("known_products"),
            F.count("product_id").alias("any_products"),
            F.sum("again").alias("again"),
        )
    )
    return join_groups(activity, choice, day).select(
        *day,
        "daily_users",
        "daily_orders",
        _zero("known_products").alias("daily_products_added"),
        _zero("again").alias("daily_reordered_items"),
        "orders_with_reorders",
        ratio(F.col("daily_orders"), F.col("daily_users")).alias("orders_per_user"),
        ratio(_zero("known_products"), F.col("daily_orders")).alias("avg_items_per_order"),
        F.coalesce(ratio(F.col("again"), F.col("any_products")), F.lit(0.0)).alias("reorder_rate"),
    )


def user_retention(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("user_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            (F.max("order_number") - F.min("order_number")).alias("order_span"),
        )
        .withColumn("user_cohort", user_cohort(F.col("total_orders")))
    )


def order_departments(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines and reordered ones per order and department: what M7 and M8 ask of orders, a small part of the lines."""
    shelf = products.select("product_id", "department_id")
    on_shelf = lines.where(F.col("product_id").isNotNull()).join(shelf, "product_id")
    return per_order(on_shelf, "department_id", "order_dow", "known_order")


def product_days(lines: DataFrame) -> DataFrame:
    """Lines and reordered ones per product and day of week: what M7 and M8 ask of products, a few rows each."""
    known = lines.where(F.col("product_id").isNotNull())
    return known.groupBy("product_id", "order_dow").agg(rows().alias("lines"), reordered_items().alias("again"))


def department_performance(
    orders: DataFrame,
    order_products: DataFrame,
    products: DataFrame,
    lines: DataFrame | None = None,
    by_order: DataFrame | None = None,
    by_product: DataFrame | None = None,
) -> DataFrame:
    """Totals, rates and ranks per department.

    Line totals are summed per product before they meet the catalogue. The ranks sort
    one row per department.
    """
    lines = order_lines(orders, order_products) if lines is None else lines
    by_order = order_departments(products, lines) if by_order is None else by_order
    by_product = product_days(lines) if by_product is None else by_product
    sales = by_product.groupBy("product_id").agg(F.sum("again").alias("again"), F.sum("lines").alias("lines"))
    volume = (
        products.select("product_id", "department_id").join(sales, "product_id", "left")
        .groupBy("department_id")
        .agg(
            F.countDistinct(F.when(F.col("lines").isNotNull(), F.col("product_id"))).alias("unique_products"),
            F.coalesce(F.sum("again"), F.lit(0)).alias("reordered_items"),
        )
    )
    reach = (
        by_order.where("known_order")
        .groupBy("department_id")
        .agg(
            rows().alias("total_orders"),
            F.countDistinct("user_id").alias("unique_users"),
            F.count(F.when(F.col("again") > 0, 1)).alias("orders_again"),
        )
    )
    totals = join_groups(volume, reach, ["department_id"]).select(
        "department_id",
        _zero("total_orders").alias("total_orders"),
        _zero("unique_users").alias("unique_users"),
        "unique_products",
        "reordered_items",
        F.col("unique_products").alias("total_items_added"),
        F.coalesce(ratio(F.col("reordered_items"), F.col("unique_products")), F.lit(0.0)).alias("reorder_rate"),
        F.coalesce(ratio(F.col("orders_again"), F.col("total_orders")), F.lit(0.0)).alias(
            "orders_with_reorders_pct"
        ),
    )
    ranked = totals.withColumns(
        {
            "order_volume_rank": F.dense_rank().over(Window.orderBy(F.desc("total_orders"))).cast("long"),
            "reorder_rank": F.dense_rank().over(Window.orderBy(F.desc("reordered_items"))).cast("long"),
        }
    )
    return ranked.withColumn("performance_tier", performance_tier(F.col("order_volume_rank")))


def department_dow_cohorts(
    orders: DataFrame,
    order_products: DataFrame,
    products: DataFrame,
    lines: DataFrame | None = None,
    by_order: DataFrame | None = None,
    by_product: DataFrame | None = None,
) -> DataFrame:
    """Users, orders and reorder rate per department and day of week.

    Products nobody ordered put their department in the group without a day. They are
    added from the catalogue, which keeps the line join an inner one that AQE can split.
    """
    shelf = products.select("product_id", "department_id")
    lines = order_lines(orders, order_products) if lines is None else lines
    by_order = order_departments(products, lines) if by_order is None else by_order
    by_product = product_days(lines) if by_product is None else by_product
    group = ["department_id", "order_dow"]
    orders_of = by_order.withColumn("known_order", F.when(F.col("known_order"), F.col("order_id")))
    choice = by_product.join(shelf, "product_id").select(*group, "product_id").distinct().groupBy(*group).agg(F.count("product_id").alias("products"))
    sold = by_product.select("product_id").distinct()
    unsold = shelf.join(sold, "product_id", "left_anti").select(
        "department_id", F.lit(None).cast("int").alias("order_dow")
    )
    nothing = F.lit(None).cast("long")
    activity = (
        orders_of.select(*group, "known_order", "user_id", "again")
        .unionByName(
            unsold.distinct().select(
                *group, nothing.alias("known_order"), nothing.alias("user_id"), F.lit(0).cast("long").alias("again")
            )
        )
        .groupBy(*group)
        .agg(
            F.countDistinct("user_id").alias("users_by_dow"),
            F.count("known_order").alias("orders_by_dow"),
            F.sum("again").alias("again"),
        )
    )
    return join_groups(activity, choice, group).select(
        *group, "users_by_dow", "orders_by_dow", ratio(F.col("again"), F.col("products")).alias("reorder_rate_by_dow")
    )


def daily_product_metrics(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Sales per day and product, aggregated before the product names are joined."""
    day = ["order_date", "product_id"]
    daily = (
        per_order(fct, *day)
        .groupBy(*day)
        .agg(
            F.sum("lines").alias("daily_orders"),
            F.countDistinct("user_id").alias("daily_unique_users"),
            percent(F.sum("again"), F.sum("lines")).alias("daily_reorder_rate"),
            rows().alias("daily_distinct_orders"),
        )
    )
    names = dim_products.select("product_id", "product_name", "department_id")
    return daily.join(names, "product_id").select(
        "order_date",
        "product_id",
        "product_name",
        "department_id",
        "daily_orders",
        "daily_unique_users",
        "daily_reorder_rate",
        "daily_distinct_orders",
    )


def product_day_drilldown(daily: DataFrame, product_id, day) -> DataFrame:
    """Metrics of one product on one day; both filters reach the scan."""
    return daily.where((F.col("product_id") == product_id) & (F.col("order_date") == day))
