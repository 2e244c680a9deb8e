"""Incremental build of the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_KEY = ["order_id", "product_id"]


def upsert_fact(existing: DataFrame, new: DataFrame, after_order=None) -> DataFrame:
    """Add the new batch's orders past a bound, replacing rows with the same key.

    ``after_order`` defaults to the highest order already present; then nothing can be
    replaced and the existing rows are not shuffled. Pass a lower bound to take in late
    lines: only existing rows past it meet the batch in the anti join.
    """
    columns = existing.columns
    if after_order is None:
        newest = existing.agg(F.max("order_id")).scalar()
        arriving = new.where(newest.isNull() | (F.col("order_id") > newest))
        return existing.unionByName(arriving.select(*columns))
    bound = F.lit(after_order) if not hasattr(after_order, "isNull") else after_order
    arriving = new.where(F.col("order_id") > bound)
    open_to_change = F.coalesce(F.col("order_id") > bound, F.lit(False))
    settled = existing.where(~open_to_change)
    replaced = existing.where(open_to_change).join(arriving.select(*FACT_KEY), FACT_KEY, "left_anti")
    return settled.unionByName(replaced.select(*columns)).unionByName(arriving.select(*columns))
