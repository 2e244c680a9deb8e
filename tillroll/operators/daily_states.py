"""Daily figures that new orders are added to, distinct counts among them.

A sum over yesterday's and today's orders is the sum of both; a distinct count is not. So the ids themselves
are kept, in a form that can be merged: bits where a group has many of them (users of a day; 32,768
ids to a bitmap), sorted lists where it has few (users of a product on a day; an id's range of RANGE ids is a row
of its own, so no list grows past that). Both are exact.

A batch brings orders that are not in the states yet; states are made of its lines alone and merged with those of
the days it touches. From states follow the daily product metrics, the product funnel, and users at any
coarser grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import join_groups, per_order, percent, ratio, rows
from tillroll.plans.star import baskets, sold
from tillroll.sinks.tables import sorted_by
from tillroll.sinks.tablesets import Draft

DAY = ["order_date", "order_dow"]
RANGE = 65_536
STATES = ["product_state", "basket_state", "user_state"]


# --- sets of ids --------------------------------------------------------------


def id_bitmaps(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, bucket and ids: the distinct ids of each group as bits, 4 KB to 32,768 of them."""
    id_ = F.col(column)
    return (
        df.where(id_.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(id_).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("ids"))
    )


def merged_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of a grain that is coarser, or of several states of one grain."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))


def counted_bitmaps(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """How many distinct ids each group has."""
    return merged_bitmaps(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(name))


# --- states -------------------------------------------------------------------


def product_state(lines: DataFrame) -> DataFrame:
    """Lines, reordered lines, orders and the users' ids per day, product and range of user ids."""
    per = per_order(sold(lines), *DAY, "product_id")
    span = F.floor(F.col("user_id") / RANGE).alias("span")
    return per.groupBy(*DAY, "product_id", span).agg(
        F.sum("lines").alias("lines"), F.sum("again").alias("again"), rows().alias("orders"), F.array_sort(F.collect_set("user_id")).alias("users")
    )


def basket_state(lines: DataFrame) -> DataFrame:
    """Orders per day, and those with a reordered line."""
    return baskets(lines, *DAY).groupBy(*DAY).agg(rows().alias("orders"), F.count(F.when(F.col("again") > 0, 1)).alias("orders_again"))


def user_state(lines: DataFrame) -> DataFrame:
    """The users of each day as bits."""
    return id_bitmaps(lines.where("known_order"), DAY, "user_id")


def states_of(lines: DataFrame) -> dict[str, DataFrame]:
    return {"product_state": product_state(lines), "basket_state": basket_state(lines), "user_state": user_state(lines)}


def merged(name: str, rows_: DataFrame) -> DataFrame:
    """One state of rows of several."""
    if name == "product_state":
        users = F.array_sort(F.array_distinct(F.flatten(F.collect_list("users"))))
        sums = [F.sum(c).alias(c) for c in ("lines", "again", "orders")]
        return rows_.groupBy(*DAY, "product_id", "span").agg(*sums, users.alias("users"))
    if name == "basket_state":
        return rows_.groupBy(*DAY).agg(F.sum("orders").alias("orders"), F.sum("orders_again").alias("orders_again"))
    return merged_bitmaps(rows_, DAY)


def update_states(draft: Draft, lines: DataFrame) -> dict[str, DataFrame]:
    """Bring the states of a draft up to date with the lines of new orders; only the days these touch are read and written."""

    def touched() -> list[str]:
        """The batch's days."""
        return [str(r.order_date) for r in lines.select("order_date").distinct().where("order_date IS NOT NULL").collect()]

    def put(name: str, fresh: DataFrame) -> DataFrame:
        fresh = fresh.where("order_date IS NOT NULL")
        if not draft.has(name):
            return draft.write(name, lambda: sorted_by(fresh, ["order_date"]), by="order_date")
        days = touched()

        def build(read) -> DataFrame:
            return sorted_by(merged(name, read(days).unionByName(fresh)), ["order_date"])

        return draft.replace(name, build, "order_date", lambda: days)

    return {name: put(name, fresh) for name, fresh in states_of(lines).items()}


# --- what follows from them ---------------------------------------------------


def daily_product_metrics(products_by_day: DataFrame, dim_products: DataFrame) -> DataFrame:
    """The mart of that name from its state."""
    day = ["order_date", "product_id"]
    daily = products_by_day.groupBy(*day, "span").agg(
        F.sum("lines").alias("lines"), F.sum("again").alias("again"), F.sum("orders").alias("orders"),
        F.size(F.array_distinct(F.flatten(F.collect_list("users")))).alias("users"),
    ).groupBy(*day).agg(
        F.sum("lines").alias("daily_orders"),
        F.sum("users").alias("daily_unique_users"),
        percent(F.sum("again"), F.sum("lines")).alias("daily_reorder_rate"),
        F.sum("orders").alias("daily_distinct_orders"),
    )
    names = dim_products.select("product_id", "product_name", "department_id")
    return daily.join(names, "product_id").select(
        "order_date", "product_id", "product_name", "department_id", "daily_orders", "daily_unique_users", "daily_reorder_rate",
        "daily_distinct_orders",
    )


def product_funnel(states: dict[str, DataFrame], products: DataFrame) -> DataFrame:
    """The mart of that name from the states."""
    zero = F.lit(0).cast("long")
    users = counted_bitmaps(states["user_state"], DAY, "daily_users")
    activity = join_groups(states["basket_state"], users, DAY)
    picks = states["product_state"].groupBy(*DAY, "product_id").agg(F.sum("again").alias("again"))
    known = products.select("product_id").distinct().withColumn("known", F.lit(True))
    choice = picks.join(known, "product_id", "left").groupBy(*DAY).agg(
        F.count("known").alias("known_products"), F.count("product_id").alias("any_products"), F.sum("again").alias("again")
    )
    both = join_groups(activity, choice, DAY).withColumns(
        {"daily_users": F.coalesce("daily_users", zero), "known_products": F.coalesce("known_products", zero)}
    )
    return both.select(
        F.col("order_date").alias("metric_date"),
        "order_dow",
        "daily_users",
        F.col("orders").alias("daily_orders"),
        F.col("known_products").alias("daily_products_added"),
        F.coalesce("again", zero).alias("daily_reordered_items"),
        F.col("orders_again").alias("orders_with_reorders"),
        ratio(F.col("orders"), F.col("daily_users")).alias("orders_per_user"),
        ratio(F.col("known_products"), F.col("orders")).alias("avg_items_per_order"),
        F.coalesce(ratio(F.col("again"), F.col("any_products")), F.lit(0.0)).alias("reorder_rate"),
    )


def users_by(states: dict[str, DataFrame], *grain: str) -> DataFrame:
    """Distinct users at a coarser grain, such as the day of week, without going back to the orders."""
    return counted_bitmaps(states["user_state"], list(grain), "users")
