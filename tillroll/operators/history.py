"""Versioned product history: snapshot, merge and lookup by date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "product_id"
ATTRIBUTES = ["product_name", "aisle_id", "department_id"]
# Fixed value: the end date of an open version.
OPEN_END = dt.date(9999, 12, 31)
VERSION_COLUMNS = [KEY, *ATTRIBUTES, "valid_from", "valid_to", "is_current"]


def dim_products_scd(products: DataFrame, as_of: dt.date) -> DataFrame:
    """Every product as an open version starting on the given day."""
    return products.select(
        KEY,
        *ATTRIBUTES,
        F.lit(as_of).alias("valid_from"),
        F.lit(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(history: DataFrame, snapshot: DataFrame, as_of: dt.date) -> DataFrame:
    """Bring the history up to a full snapshot taken on ``as_of``.

    Closed versions pass through untouched. Open ones meet the snapshot in one full
    outer join, and each pair yields the versions it becomes:
    unchanged -> kept; changed -> closed and reopened; gone -> closed; new or
    returned -> opened. A version opened on ``as_of`` itself is replaced in place,
    so no version has zero length.
    """
    today, forever = F.lit(as_of), F.lit(OPEN_END)
    closed = history.where(~F.col("is_current")).select(*VERSION_COLUMNS)
    was = history.where(F.col("is_current")).select(
        KEY, F.struct(*ATTRIBUTES, "valid_from").alias("was"), F.lit(True).alias("in_history")
    )
    now = snapshot.select(KEY, F.struct(*ATTRIBUTES).alias("now"), F.lit(True).alias("in_snapshot"))
    pairs = was.join(now, KEY, "full_outer")

    def version(source: str, start, end, current: bool):
        return F.struct(
            *[F.col(f"{source}.{a}").alias(a) for a in ATTRIBUTES],
            start.cast("date").alias("valid_from"),
            end.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    started = F.col("was.valid_from")
    same = F.struct(*[F.col(f"was.{a}") for a in ATTRIBUTES]).eqNullSafe(F.col("now"))
    kept = version("was", started, forever, True)
    ended = version("was", started, today, False)
    opened = version("now", today, forever, True)
    fresh = started >= today
    versions = (
        F.when(F.col("in_history").isNull(), F.array(opened))
        .when(F.col("in_snapshot").isNull() & fresh, F.slice(F.array(kept), 1, 0))
        .when(F.col("in_snapshot").isNull(), F.array(ended))
        .when(same, F.array(kept))
        .when(fresh, F.array(version("now", started, forever, True)))
        .otherwise(F.array(ended, opened))
    )
    current = pairs.select(KEY, F.inline(versions)).select(*VERSION_COLUMNS)
    return closed.unionByName(current)


def scd2_as_of(history: DataFrame, probes: DataFrame, date_column: str) -> DataFrame:
    """Attach to each (product, date) the version valid on that date.

    Starts are inclusive, ends exclusive. A probe without a version keeps its row, with
    NULL attributes. The equality on the key keeps this a shuffle or broadcast hash join
    with the dates as a residual test.
    """
    day = F.col(date_column)
    versions = history.select(F.col(KEY).alias("_key"), *ATTRIBUTES, "valid_from", "valid_to")
    valid = (F.col(KEY) == F.col("_key")) & (F.col("valid_from") <= day) & (day < F.col("valid_to"))
    return probes.join(versions, valid, "left").drop("_key")
