"""Dashboard queries: product health, retention and the funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.labels import (
    BASKET_LABELS,
    GAP_LABELS,
    basket_bucket,
    gap_bucket,
    label_position,
)
from tillroll.functions.numbers import join_groups, per_order, percent, ratio, reorder_share, reordered_items, round_to, rows


# The least orders and numbers of rows (10, 20, 5, 25, 30) by which the dashboards rank.


def share_of_total(n: str):
    """Percent of the column's total. Only for aggregates with one row per label,
    department or order count: the window puts them in a single partition."""
    return percent(F.col(n), F.sum(n).over(Window.partitionBy()))


def product_sales(fct: DataFrame) -> DataFrame:
    return fct.groupBy("product_id").agg(
        F.countDistinct("order_id").alias("times_ordered"),
        reordered_items().alias("reorder_count"),
        round_to(reorder_share(), 3).alias("reorder_rate"),
    )


# --- product health ---------------------------------------------------------


def health_daily(fct: DataFrame) -> DataFrame:
    """Activity by day of week; the items figure is distinct products per distinct order."""
    lines = fct.withColumnRenamed("order_dow", "day_of_week")
    activity = (
        per_order(lines, "day_of_week")
        .groupBy("day_of_week")
        .agg(
            F.countDistinct("user_id").alias("daily_active_users"),
            rows().alias("daily_orders"),
            round_to(ratio(F.sum("again"), F.sum("lines")), 2).alias("reorder_rate"),
        )
    )
    choice = (
        lines.select("day_of_week", "product_id")
        .distinct()
        .groupBy("day_of_week")
        .agg(F.count("product_id").alias("unique_products_ordered"))
    )
    return (
        join_groups(activity, choice, ["day_of_week"])
        .select("day_of_week", "daily_active_users", "daily_orders", "unique_products_ordered", "reorder_rate")
        .withColumn(
            "avg_items_per_order",
            round_to(ratio(F.col("unique_products_ordered"), F.col("daily_orders")), 2),
        )
        .orderBy("day_of_week")
    )


def health_top_reorder(fct: DataFrame, dim_products: DataFrame, min_orders: int = 10, k: int = 20) -> DataFrame:
    return (
        product_sales(fct)
        .where(F.col("times_ordered") >= min_orders)
        .join(dim_products.select("product_id", "product_name", "department_name"), "product_id")
        .select("product_id", "product_name", "times_ordered", "reorder_rate", "department_name")
        .orderBy(F.desc("reorder_rate"), "product_id")
        .limit(k)
    )


def health_department_share(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    group = ["department_id", "department_name"]
    shelf = dim_products.select("product_id", *group)
    demand = (
        fct.select("order_id", "product_id")
        .join(shelf, "product_id")
        .select(*group, "order_id")
        .distinct()
        .groupBy(*group)
        .agg(rows().alias("total_orders"))
    )
    sold = fct.select("product_id").distinct().join(shelf.distinct(), "product_id")
    choice = sold.groupBy(*group).agg(rows().alias("unique_products"))
    return (
        join_groups(demand, choice, group)
        .withColumn("pct_of_orders", share_of_total("total_orders"))
        .orderBy(F.desc("total_orders"), "department_id")
    )


def health_user_segments(dim_users: DataFrame) -> DataFrame:
    return (
        dim_users.groupBy("user_segment")
        .agg(
            F.countDistinct("user_id").alias("user_count"),
            round_to(F.avg("total_orders"), 1).alias("avg_orders"),
            round_to(F.avg("reorder_rate"), 3).alias("avg_reorder_rate"),
            rows().alias("members"),
        )
        .withColumn("pct_of_users", share_of_total("members"))
        .drop("members")
        .orderBy(F.desc("user_count"), "user_segment")
    )


# --- retention --------------------------------------------------------------


def retention_cohorts(user_retention: DataFrame) -> DataFrame:
    return (
        user_retention.groupBy("user_cohort")
        .agg(
            F.countDistinct("user_id").alias("user_count"),
            round_to(F.avg("total_orders"), 1).alias("avg_orders_per_user"),
            round_to(F.avg("order_span"), 1).alias("avg_order_span"),
            rows().alias("members"),
        )
        .withColumn("pct_of_users", share_of_total("members"))
        .drop("members")
        .orderBy(F.desc("user_count"), "user_cohort")
    )


def retention_order_frequency(user_retention: DataFrame, k: int = 30) -> DataFrame:
    """Users by number of orders. N orders have at most sqrt(2N) different counts."""
    return (
        user_retention.groupBy("total_orders")
        .agg(F.countDistinct("user_id").alias("user_count"), rows().alias("members"))
        .withColumn("pct_of_users", share_of_total("members"))
        .drop("members")
        .orderBy("total_orders")
        .limit(k)
    )


def retention_reorder_windows(fct: DataFrame) -> DataFrame:
    """Fact rows by gap since the user's previous order."""
    return (
        fct.groupBy(gap_bucket(F.col("days_since_prior_order")).alias("reorder_window"))
        .agg(rows().alias("order_count"))
        .withColumn("pct_of_orders", share_of_total("order_count"))
        .orderBy(label_position(F.col("reorder_window"), GAP_LABELS))
    )


def retention_segment_rate(dim_users: DataFrame) -> DataFrame:
    return (
        dim_users.groupBy("user_segment")
        .agg(
            round_to(F.avg("reorder_rate"), 3).alias("avg_reorder_rate"),
            F.countDistinct("user_id").alias("user_count"),
            F.stddev_samp("reorder_rate").alias("reorder_rate_variance"),
        )
        .orderBy(F.desc("avg_reorder_rate"), "user_segment")
    )


# --- funnel -----------------------------------------------------------------


def funnel_daily(product_funnel: DataFrame, k: int = 30) -> DataFrame:
    orders, users = F.col("daily_orders"), F.col("daily_users")
    added, again = F.col("daily_products_added"), F.col("daily_reordered_items")
    return (
        product_funnel.select(
            "metric_date",
            users.alias("users"),
            orders.alias("orders"),
            round_to(ratio(orders, users), 2).alias("conversion_rate"),
            round_to(ratio(added, orders), 2).alias("avg_items_per_order"),
            round_to(ratio(again, added), 3).alias("reorder_rate"),
            "order_dow",
        )
        .orderBy(F.desc("metric_date"), "order_dow")
        .limit(k)
        .drop("order_dow")
    )


def funnel_top_reordered(fct: DataFrame, dim_products: DataFrame, min_orders: int = 5, k: int = 25) -> DataFrame:
    return (
        product_sales(fct)
        .where(F.col("times_ordered") >= min_orders)
        .join(dim_products.select("product_id", "product_name", "department_name"), "product_id")
        .select(
            "product_id", "product_name", "department_name", "times_ordered", "reorder_count", "reorder_rate"
        )
        .orderBy(F.desc("reorder_count"), "product_id")
        .limit(k)
    )


def funnel_department(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    lines = fct.select("order_id", "user_id", "product_id", "reordered").join(
        dim_products.select("product_id", "department_name"), "product_id"
    )
    return (
        per_order(lines, "department_name")
        .groupBy("department_name")
        .agg(
            rows().alias("order_count"),
            F.countDistinct("user_id").alias("unique_users"),
            round_to(ratio(F.sum("again"), F.sum("lines")), 3).alias("reorder_rate"),
        )
        .withColumn("orders_per_user", round_to(ratio(F.col("order_count"), F.col("unique_users")), 2))
        .orderBy(F.desc("order_count"), "department_name")
    )


def funnel_cart_composition(fct: DataFrame) -> DataFrame:
    """Orders by basket size, with the mean reordered share of a basket."""
    baskets = fct.groupBy("order_id").agg(
        F.countDistinct("product_id").alias("items"),
        round_to(reorder_share(), 3).alias("share"),
    )
    return (
        baskets.groupBy(basket_bucket(F.col("items")).alias("order_size"))
        .agg(rows().alias("order_count"), round_to(F.avg("share"), 3).alias("avg_reorder_rate"))
        .orderBy(label_position(F.col("order_size"), BASKET_LABELS))
    )
