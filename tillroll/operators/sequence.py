"""Order sequence per user and the reorder flag, both derived from order history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.numbering import number_in_blocks
from tillroll.session import scratch_dir


# Ids of one block of a day's orders.
IDS_PER_BLOCK = 1 << 20


def order_blocks() -> list[Column]:
    return [F.col("order_date"), F.floor(F.col("order_id") / IDS_PER_BLOCK)]


def derive_order_sequence(orders: DataFrame) -> DataFrame:
    """Add order_number and days_since_prior_order (NULL on a user's first order).

    Needs order_id, user_id, order_date. Orders without a user are numbered as those of one. A
    user's orders are cut by day and range of ids.
    """
    numbered = number_in_blocks(
        orders,
        key="user_id",
        blocks=order_blocks(),
        order_by=["order_date", "order_id"],
        position="order_number",
        carry="order_date",
        previous="_prior_date",
    )
    return numbered.selectExpr(
        *orders.columns, "order_number", "datediff(order_date, _prior_date) AS days_since_prior_order"
    )


def derive_reordered(orders: DataFrame, order_products: DataFrame) -> DataFrame:
    """Flag lines whose product the same user bought in an earlier order.

    The first purchase of each (user, product) is found with a map-side combined
    minimum and joined back, so no pair is ever sorted in a single task. Orders without
    a user count as those of one user.
    """
    lines = order_products.select("order_id", "product_id").join(
        orders.select("order_id", "user_id", "order_date"), "order_id"
    )
    when_bought = F.struct("order_date", "order_id")
    firsts = lines.groupBy("user_id", "product_id").agg(F.min(when_bought).alias("_first"))
    firsts = firsts.withColumnsRenamed({"user_id": "_buyer", "product_id": "_bought"})
    same = F.col("user_id").eqNullSafe(F.col("_buyer")) & (F.col("product_id") == F.col("_bought"))
    return lines.join(firsts, same).select(
        "order_id",
        "product_id",
        "user_id",
        F.when(F.struct("order_date", "order_id") > F.col("_first"), 1).otherwise(0).alias("reordered"),
    )


# --- batch by batch -----------------------------------------------------------

SEQUENCE = ["order_id", "user_id", "order_date", "order_number", "days_since_prior_order"]
USER_BLOCKS = 256


def sequence_state(sequence: DataFrame) -> DataFrame:
    """Each user's last order, its date, and how many there are."""
    last = F.max(F.struct("order_date", "order_id"))
    return sequence.groupBy("user_id").agg(last.alias("last"), F.max("order_number").alias("orders"))


def merged_state(state: DataFrame, changed: DataFrame) -> DataFrame:
    """The state after rows were added or renumbered: both its parts only grow."""
    return state.unionByName(sequence_state(changed)).groupBy("user_id").agg(F.max("last").alias("last"), F.max("orders").alias("orders"))


def late_users(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Users of whom the batch holds an order before their last one. Without a user is one user."""
    first = batch.groupBy("user_id").agg(F.min(F.struct("order_date", "order_id")).alias("first"))
    both = first.join(state.withColumnRenamed("user_id", "_user"), F.col("user_id").eqNullSafe(F.col("_user")))
    return both.where(F.col("first") < F.col("last")).select("user_id")


def extend_sequence(state: DataFrame, batch: DataFrame, history_of_late) -> tuple[DataFrame, DataFrame]:
    """(rows that are new or renumbered, users renumbered) when new orders arrive.

    Orders after their user's last one go on from the state; users with an earlier one, and they alone,
    are numbered anew. ``history_of_late`` gives the stored orders of the users it is handed.
    """
    batch = batch.select("order_id", "user_id", "order_date")
    late = late_users(state, batch)
    known = late.withColumnRenamed("user_id", "_late")
    of_late = F.col("user_id").eqNullSafe(F.col("_late"))
    again = history_of_late(late).select("order_id", "user_id", "order_date").unionByName(batch.join(known, of_late, "left_semi"))
    fresh = number_in_blocks(
        batch.join(known, of_late, "left_anti"), key="user_id", blocks=order_blocks(), order_by=["order_date", "order_id"],
        position="_n", carry="order_date", previous="_prior",
    )
    before = state.withColumnRenamed("user_id", "_user")
    going_on = fresh.join(before, F.col("user_id").eqNullSafe(F.col("_user")), "left").select(
        "order_id",
        "user_id",
        "order_date",
        (F.col("_n") + F.coalesce("orders", F.lit(0))).cast("int").alias("order_number"),
        F.datediff("order_date", F.coalesce("_prior", F.col("last.order_date"))).alias("days_since_prior_order"),
    )
    return going_on.unionByName(derive_order_sequence(again).select(*SEQUENCE)), late


def user_block(blocks: int = USER_BLOCKS):
    return F.pmod(F.xxhash64("user_id"), F.lit(blocks)).alias("user_block")


def extend_stored_sequence(draft, batch: DataFrame, blocks: int = USER_BLOCKS) -> DataFrame:
    """Take new orders into the tables `sequence` and `sequence_state` of a draft.

    The stored sequence lies in blocks of users. Rows go beside those of their block, but blocks with a late user are
    written anew; no other stored order is read.
    """
    spark = draft.spark
    if not draft.has("sequence"):
        whole = derive_order_sequence(batch.select("order_id", "user_id", "order_date")).select(*SEQUENCE, user_block(blocks))
        made = draft.write("sequence", lambda: whole, by="user_block")
        draft.write("sequence_state", lambda: sequence_state(made))
        return made.drop("user_block")

    entry = draft.entries["sequence"]
    state = draft.read("sequence_state")
    # As many as there are blocks.
    held = [str(r.user_block) for r in late_users(state, batch).select(user_block(blocks)).distinct().collect()]

    def stored_late(late: DataFrame) -> DataFrame:
        found = draft.tables.open("sequence", entry, held)
        return found.join(late.withColumnRenamed("user_id", "_late"), F.col("user_id").eqNullSafe(F.col("_late")), "left_semi")

    changed, late = extend_sequence(state, batch, stored_late)
    path = scratch_dir(spark, "sequence")
    changed.write.parquet(path)
    changed = spark.read.schema(changed.schema).parquet(path)

    def build(read) -> DataFrame:
        others = read(held).join(late.withColumnRenamed("user_id", "_late"), F.col("user_id").eqNullSafe(F.col("_late")), "left_anti")
        return others.unionByName(changed.withColumn("user_block", user_block(blocks)))

    made = draft.replace("sequence", build, "user_block", lambda: held)
    draft.write("sequence_state", lambda: merged_state(state, changed))
    return made.drop("user_block")


def extend_firsts(firsts: DataFrame, orders: DataFrame, lines: DataFrame) -> DataFrame:
    """(user_id, product_id, first): the first purchases after a batch, of those before it and the batch alone."""
    bought = lines.select("order_id", "product_id").join(orders.select("order_id", "user_id", "order_date"), "order_id")
    new = bought.groupBy("user_id", "product_id").agg(F.min(F.struct("order_date", "order_id")).alias("first"))
    return firsts.unionByName(new).groupBy("user_id", "product_id").agg(F.min("first").alias("first"))
