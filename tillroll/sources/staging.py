"""Staging views: typed projections of the loaded tables, rows without a key removed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_COLUMNS = [
    "order_id",
    "user_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
]
PRODUCT_COLUMNS = ["product_id", "product_name", "aisle_id", "department_id"]
LINE_COLUMNS = ["order_id", "product_id", "add_to_cart_order", "reordered"]

# Carried along when the source has them.
OPTIONAL_COLUMNS = ["order_date", "loaded_at"]


def _keep(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    extra = [c for c in OPTIONAL_COLUMNS if c in df.columns]
    return df.select(*columns, *extra).where(" AND ".join(f"{k} IS NOT NULL" for k in keys))


def stg_orders(raw: DataFrame) -> DataFrame:
    return _keep(raw, ORDER_COLUMNS, ["order_id"])


def stg_products(raw: DataFrame) -> DataFrame:
    return _keep(raw, PRODUCT_COLUMNS, ["product_id"])


def stg_order_products(raw: DataFrame) -> DataFrame:
    return _keep(raw, LINE_COLUMNS, ["order_id", "product_id"])


def anchored_dates(orders: DataFrame, anchor: dt.date) -> DataFrame:
    """Give orders without a calendar date one: the anchor day plus order_id modulo 365."""
    return orders.withColumn(
        "order_date", F.date_add(F.lit(anchor), (F.col("order_id") % 365).cast("int"))
    )
