"""Row numbers within a key that stay exact when one key holds most of the rows.

A plain ``row_number`` window sends a whole key to one task. Here rows are range-sorted by key
and order, so a large key is cut into several parts of the sorted sequence; every part numbers
its own rows, and one small aggregate per (key, part) tells how many came before. There is no
threshold, and rows without a key are one key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import scratch_dir


def number_rows(
    df: DataFrame,
    key: str,
    order_by: list[str],
    position: str,
    carry: str | None = None,
    previous: str | None = None,
) -> DataFrame:
    """Add ``position`` (1-based within key) and, if asked, the ``carry`` value of the row before.

    ``carry`` must be the leading column of ``order_by``. The sorted rows are written to the
    shared scratch folder with their place, so that both passes see the same cut.
    """
    order = [key, *order_by]
    path = scratch_dir(df.sparkSession, "ranged")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        # The place tells the part (upper bits) and the row in it.
        .withColumn("_place", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    ranged = df.sparkSession.read.parquet(path).withColumn(
        # Structs are equal where their NULL fields are, so rows without a key find their part.
        "_group", F.struct(F.col(key).alias("key"), F.shiftright("_place", 33).alias("part"))
    )
    if carry:
        in_part = Window.partitionBy("_group").orderBy("_place")
        ranged = ranged.withColumn("_before", F.lag(carry).over(in_part))

    parts = ranged.groupBy("_group").agg(
        F.min("_place").alias("_first"),
        F.expr("count(1) AS _size"),
        *([F.max(carry).alias("_last")] if carry else []),
    )
    # One row per key and part from here on.
    along = Window.partitionBy("_group.key").orderBy("_group.part")
    shifts = parts.select(
        F.col("_group").alias("_of"),
        "_first",
        (F.sum("_size").over(along) - F.col("_size")).alias("_shift"),
        *([F.lag("_last").over(along).alias("_carried")] if carry else []),
    )
    return ranged.join(shifts, F.col("_group") == F.col("_of"), "left").select(
        *df.columns,
        (F.col("_place") - F.col("_first") + 1 + F.col("_shift")).cast("int").alias(position),
        # Only the first row of a part looks back across the cut.
        *([F.coalesce("_before", "_carried").alias(previous)] if carry else []),
    )


def number_in_blocks(
    df: DataFrame,
    key: str,
    blocks: list[Column],
    order_by: list[str],
    position: str,
    carry: str | None = None,
    previous: str | None = None,
) -> DataFrame:
    """The same for orders that are cut into blocks by their own values, such as days: one shuffle, nothing stored.

    ``blocks`` are expressions that never fall along ``order_by``; together they must cut a large key into
    parts of a bearable size. Every part numbers its own rows; how many came before is told by one row
    per key and part.
    """
    names = [f"_block{i}" for i in range(len(blocks))]
    # Structs are equal where their NULL fields are, so rows without a key find their part.
    group = F.struct(F.col(key).alias("key"), *[b.alias(n) for b, n in zip(blocks, names)])
    cut = df.withColumn("_group", group)
    within = Window.partitionBy("_group").orderBy(*order_by)
    numbered = cut.withColumn("_at", F.row_number().over(within))
    if carry:
        numbered = numbered.withColumn("_before", F.lag(carry).over(within))
    parts = cut.groupBy("_group").agg(F.expr("count(1) AS _size"), *([F.max(carry).alias("_last")] if carry else []))
    along = Window.partitionBy("_group.key").orderBy(*[f"_group.{n}" for n in names])
    shifts = parts.select(
        F.col("_group").alias("_of"),
        (F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, -1))).alias("_shift"),
        *([F.lag("_last").over(along).alias("_carried")] if carry else []),
    )
    before = F.when(F.col("_at") == 1, F.col("_carried")).otherwise(F.col("_before")) if carry else None
    return numbered.join(shifts, F.col("_group") == F.col("_of"), "left").select(
        *df.columns,
        (F.col("_at") + F.coalesce("_shift", F.lit(0))).cast("int").alias(position),
        *([before.alias(previous)] if carry else []),
    )
