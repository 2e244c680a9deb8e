"""Star schema: the order-product fact and its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.labels import WEEKEND_DAYS, date_key, day_name, day_of_week, user_segment
from tillroll.functions.numbers import is_reordered, join_groups, ratio, reordered_items, rows

FACT_KEY = ["order_id", "product_id"]


ORDER_COLUMNS = ["user_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order", "order_date"]


def order_lines(orders: DataFrame, order_products: DataFrame) -> DataFrame:
    """Every line with its order's columns, and every order without lines: the one join that most marts need.

    known_order tells lines whose order is there; orders without lines have no product. Lines are
    the left side, so AQE can split a hot order; orders meet the distinct orders of the lines.
    """
    head = orders.select("order_id", *ORDER_COLUMNS).withColumn("known_order", F.lit(True))
    lines = order_products.select("order_id", "product_id", "add_to_cart_order", "reordered")
    idle = head.join(lines.select("order_id").distinct(), "order_id", "left_anti")
    return (
        lines.join(head, "order_id", "left")
        .withColumn("known_order", F.coalesce("known_order", F.lit(False)))
        .unionByName(idle, allowMissingColumns=True)
    )


def sold(lines: DataFrame) -> DataFrame:
    """The lines of known orders."""
    return lines.where(F.col("known_order") & F.col("product_id").isNotNull())


def baskets(lines: DataFrame, *columns: str) -> DataFrame:
    """One row per known order with the given columns, its lines and its reordered ones (NULL without lines)."""
    again = F.sum(F.when(F.col("product_id").isNotNull(), F.when(is_reordered(), 1).otherwise(0))).alias("again")
    return lines.where("known_order").groupBy("order_id", *columns).agg(F.count("product_id").alias("lines"), again)


def fct_orders(
    orders: DataFrame, order_products: DataFrame, products: DataFrame, lines: DataFrame | None = None
) -> DataFrame:
    """One row per order and product, with the order's user and calendar and the product's shelf.

    Whether products are broadcast is left to the size estimate; a large catalogue
    takes a shuffle join, whose hot products AQE splits.
    """
    shelf = products.select("product_id", "department_id", "aisle_id")
    return (
        sold(order_lines(orders, order_products) if lines is None else lines)
        .join(shelf, "product_id")
        .selectExpr(
            "order_id",
            "user_id",
            "product_id",
            "department_id",
            "aisle_id",
            "order_hour_of_day AS order_hour",
            "order_dow",
            "days_since_prior_order",
            "reordered",
            "add_to_cart_order",
            "year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS order_date_id",
            "order_date",
        )
    )


def dim_users(orders: DataFrame, order_products: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Order habits per user.

    avg_days_between_orders weighs each order by its lines (at least one), and
    reorder_rate divides reordered lines by distinct products, so it can exceed 1.
    Lines are collapsed per order first; distinct products are counted over
    (user, product) pairs. No row is multiplied.
    """
    lines = order_lines(orders, order_products) if lines is None else lines
    weight = F.greatest(F.col("lines"), F.lit(1))
    gap = F.col("days_since_prior_order")
    tenure = (
        baskets(lines, "user_id", "order_number", "days_since_prior_order")
        .groupBy("user_id")
        .agg(
            rows().alias("total_orders"),
            (F.max("order_number") - F.min("order_number")).alias("days_since_first_order"),
            ratio(F.sum(gap * weight), F.sum(F.when(gap.isNotNull(), weight))).alias("mean_gap"),
            F.sum("again").alias("again"),
        )
    )
    variety = (
        sold(lines).select("user_id", "product_id").distinct().groupBy("user_id").agg(rows().alias("distinct_products"))
    )
    return join_groups(tenure, variety, ["user_id"]).select(
        "user_id",
        "total_orders",
        "days_since_first_order",
        F.lit(0).alias("days_since_last_order"),
        F.round("mean_gap").alias("avg_days_between_orders"),
        ratio(F.col("again"), F.col("distinct_products")).alias("reorder_rate"),
        user_segment(F.col("total_orders")).alias("user_segment"),
    )


def dim_products(
    products: DataFrame,
    order_products: DataFrame,
    aisles: DataFrame | None = None,
    departments: DataFrame | None = None,
) -> DataFrame:
    """Product attributes with reorder totals. Lines are aggregated per product before the join.

    Names default to a label built from the id; pass the aisle and department tables for real ones.
    """
    sales = order_products.groupBy("product_id").agg(
        F.countDistinct("order_id").alias("total_orders"), reordered_items().alias("again")
    )
    named = products.select("product_id", "product_name", "aisle_id", "department_id")
    aisle_label = F.concat(F.lit("Aisle_"), F.col("aisle_id").cast("string"))
    department_label = F.concat(F.lit("Department_"), F.col("department_id").cast("string"))
    if aisles is not None:
        named = named.join(aisles.select("aisle_id", "aisle_name"), "aisle_id", "left")
        aisle_label = F.coalesce(F.col("aisle_name"), aisle_label)
    if departments is not None:
        named = named.join(departments.select("department_id", "department_name"), "department_id", "left")
        department_label = F.coalesce(F.col("department_name"), department_label)
    return named.join(sales, "product_id", "left").select(
        "product_id",
        "product_name",
        "aisle_id",
        aisle_label.alias("aisle_name"),
        "department_id",
        department_label.alias("department_name"),
        F.coalesce(F.col("again"), F.lit(0)).alias("reorder_count"),
        F.coalesce(ratio(F.col("again"), F.col("total_orders")), F.lit(0.0)).alias("reorder_rate"),
    )


def dim_departments(
    departments: DataFrame, products: DataFrame, order_products: DataFrame
) -> DataFrame:
    """Catalogue size and distinct orders per department."""
    stock = products.groupBy("department_id").agg(F.countDistinct("product_id").alias("total_products"))
    demand = (
        order_products.select("order_id", "product_id")
        .join(products.select("product_id", "department_id"), "product_id")
        .select("department_id", "order_id")
        .distinct()
        .groupBy("department_id")
        .agg(rows().alias("total_orders"))
    )
    return (
        departments.select("department_id", "department_name")
        .join(stock, "department_id", "left")
        .join(demand, "department_id", "left")
        .select(
            "department_id",
            "department_name",
            F.coalesce("total_products", F.lit(0)).alias("total_products"),
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        )
    )


def dim_aisles(aisles: DataFrame, products: DataFrame) -> DataFrame:
    """Each aisle with the department holding most of its products (lowest id on a tie)."""
    homes = (
        products.groupBy("aisle_id", "department_id")
        .agg(rows().alias("held"))
        .groupBy("aisle_id")
        .agg(F.max_by("department_id", F.struct("held", -F.col("department_id"))).alias("department_id"))
    )
    return aisles.select("aisle_id", "aisle_name").join(homes, "aisle_id", "left")


def dim_time(orders: DataFrame) -> DataFrame:
    """One row per calendar day from the first to the last order."""
    day = F.col("order_date")
    days = orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).where(
        F.col("lo").isNotNull()
    )
    return days.select(F.explode(F.sequence("lo", "hi")).alias("order_date")).select(
        date_key(day).alias("date_id"),
        "order_date",
        day_of_week(day).alias("order_dow"),
        day_name(day_of_week(day)).alias("day_of_week_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.when(day_of_week(day).isin(WEEKEND_DAYS), 1).otherwise(0).alias("is_weekend"),
    )
