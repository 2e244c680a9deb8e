"""Writing marts, logs and copies."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.upsert import FACT_KEY
from tillroll.session import scratch_dir
from tillroll.sinks import files
from tillroll.sinks.tablesets import Draft, TableSet

# The marts copied to another store.
PUBLISHED = [
    "fct_orders",
    "dim_users",
    "dim_products",
    "dim_departments",
    "product_funnel",
    "user_retention",
    "department_performance",
]

# Fixed value: the folder name of rows without a value in the dividing column.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class CopyDiffers(RuntimeError):
    """A copy does not hold what its source holds."""


# Orders per stored fact partition.
ORDERS_PER_BLOCK = 50_000_000


def stamp(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.current_timestamp() for c in columns}) if columns else df


def write_mart(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    audit: list[str] | None = None,
    file_format: str = "parquet",
    sort_by: list[str] | None = None,
) -> DataFrame:
    """Replace the mart stored at ``path`` and return it as read back."""
    stamped = stamp(df, audit or [])
    # Without this every task would write a file of every partition.
    stamped = sorted_by(stamped, [*(partition_by or []), *(sort_by or [])])
    writer = stamped.write.mode("overwrite").format(file_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return df.sparkSession.read.schema(stamped.schema).format(file_format).load(path)


def new_key() -> str:
    """A key no other draft has."""
    return uuid.uuid4().hex[:12]


def sorted_by(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows dealt out by the first column and sorted, so that a look at a few of its values reads little of each file.

    Tasks are made of a like size afterwards; there are no bounds to sample, so the rows are made once.
    """
    return df.hint("rebalance", order[0]).sortWithinPartitions(*order) if order else df


def write_marts(
    frames: dict[str, DataFrame],
    folder: str,
    audit: dict[str, list[str]] | None = None,
    sorted_by: dict[str, list[str]] | None = None,
    facts: list[str] | None = None,
    at_once: int = 4,
) -> dict[str, DataFrame]:
    """Write marts that do not read each other, a few jobs at a time.

    Jobs overlap so that the last tasks of one do not leave executors idle.
    """

    def write(name: str) -> DataFrame:
        columns = (audit or {}).get(name)
        if name in (facts or ()):
            # Read back without the block: it is a matter of storage.
            return write_fact(frames[name], f"{folder}/{name}", audit=columns).drop("order_block")
        return write_mart(frames[name], f"{folder}/{name}", audit=columns, sort_by=(sorted_by or {}).get(name))

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(frames, pool.map(write, frames)))


def save_mart_table(df: DataFrame, name: str, partition_by: list[str] | None = None, audit: list[str] | None = None) -> DataFrame:
    """Replace the catalog table ``name`` and return it."""
    writer = stamp(df, audit or []).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_run_log(runs: DataFrame, path: str) -> None:
    """Append run records as JSON lines."""
    runs.write.mode("append").option("ignoreNullFields", False).json(path)


def append_ops_table(df: DataFrame, target: str, jdbc: dict[str, str] | None = None) -> None:
    """Append run or metric rows to the operations store.

    ``target`` is a folder path when it holds a slash, else a catalog table; with
    ``jdbc`` options it is a table of that database.
    """
    if jdbc:
        df.write.mode("append").format("jdbc").options(**jdbc, dbtable=target).save()
    elif "/" in target:
        df.write.mode("append").parquet(target)
    else:
        df.write.mode("append").saveAsTable(target)


def publish_marts(marts: dict[str, DataFrame], target: str, names: list[str] | None = None, at_once: int = 4) -> DataFrame:
    """Copy marts to another store, replacing what is there; rows per copied mart, counted while they are written."""
    names = names or PUBLISHED

    def copy(name: str) -> tuple[str, int]:
        counted = Observation()
        marts[name].observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{target}/{name}")
        return name, counted.get["n"]

    with ThreadPoolExecutor(at_once) as pool:
        counts = list(pool.map(copy, names))
    return marts[names[0]].sparkSession.createDataFrame(counts, "table_name string, row_count long")


# --- copies that are proven equal -------------------------------------------

DIGEST = ["row_count", "hash_sum", "hash_xor"]


def content_digest(df: DataFrame, by: str | None = None) -> DataFrame:
    """(part, row_count, hash_sum, hash_xor) of the rows of each value of a column, or of all rows.

    The order of rows and how they are cut into files do not show; any other change does, but for a chance in 2**100 or so.
    Sums are of halves of 64-bit hashes, so that they fit, and the xor is of hashes with another seed.
    """
    part = F.col(by).cast("string") if by else F.lit("")
    columns = sorted(df.columns)
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    half = (1 << 32) - 1
    hashed = df.select(part.alias("part"), first.alias("a"), second.alias("b"))
    return hashed.groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.struct(F.sum(F.col("a").bitwiseAND(half)).alias("low"), F.sum(F.shiftrightunsigned("a", 32)).alias("high")).alias("hash_sum"),
        F.bit_xor("b").alias("hash_xor"),
    )


def compare_copies(source: DataFrame, copy: DataFrame, by: str | None = None) -> DataFrame:
    """(part, source_rows, copy_rows, equal) of every part that either side has."""
    sides = [
        content_digest(df, by).select("part", F.lit(k).alias("side"), F.struct(*DIGEST).alias("digest"))
        for k, df in enumerate((source, copy.select(*source.columns)))
    ]
    # A group, not a join: a part may be null.
    found = sides[0].unionByName(sides[1]).groupBy("part").agg(*[F.max(F.when(F.col("side") == k, F.col("digest"))).alias(n) for k, n in enumerate(("ours", "theirs"))])
    zero = F.lit(0).cast("long")
    return found.select(
        "part", F.coalesce("ours.row_count", zero).alias("source_rows"), F.coalesce("theirs.row_count", zero).alias("copy_rows"),
        F.col("ours").eqNullSafe(F.col("theirs")).alias("equal"),
    )


def publish_changes(name: str, df: DataFrame, target: TableSet, by: str) -> DataFrame:
    """Bring a copy up to date: only parts whose content differs are written, and what is then there is compared with the source.

    (table_name, part, source_rows, copy_rows, written, equal), a row per value of the dividing column.
    """
    spark = df.sparkSession
    draft = target.draft(new_key())
    schema = "table_name string, part string, source_rows long, copy_rows long, written boolean, equal boolean"
    if not draft.has(name):
        draft.write(name, lambda: sorted_by(df, [by]), by=by)
        written = None
    else:
        # No more rows than the copy has folders.
        differ = [r.part for r in compare_copies(df, draft.read(name), by).where("NOT equal").select("part").collect()]
        folders = [NO_VALUE if p is None else p for p in differ]
        value = F.coalesce(F.col(by).cast("string"), F.lit(NO_VALUE))
        if folders:
            draft.replace(name, lambda read: sorted_by(df.where(value.isin(folders)), [by]), by, lambda: folders)
        written = differ
    after = compare_copies(df, draft.read(name), by)
    rows = [
        (name, r.part, r.source_rows, r.copy_rows, written is None or r.part in written, r.equal) for r in after.collect()
    ]
    if not all(r[-1] for r in rows):
        raise CopyDiffers(f"{name}: {[r[1] for r in rows if not r[-1]]}")
    draft.publish()
    return spark.createDataFrame(rows, schema)


# --- the stored fact --------------------------------------------------------

FACT = "fact"
# Slices of a stored block, which are sorted, so files hold few ranges of orders; a block with few orders has fewer.
SLICES_PER_BLOCK = 64
ORDERS_PER_SLICE = 10_000


def _with_block(fct: DataFrame, orders_per_block: int) -> DataFrame:
    return fct.withColumn("order_block", F.floor(F.col("order_id") / F.lit(orders_per_block)))


def _sorted_blocks(blocked: DataFrame, orders_per_block: int) -> DataFrame:
    """Rows dealt out by slices of consecutive orders and sorted: no range bounds, so the rows are made once.

    Slices of any size become tasks of a like size. A slice lies within a block, so a write has about as many files as
    slices: were the orders of a small block dealt to all tasks, there would be blocks times tasks of them.
    """
    slices = max(1, min(SLICES_PER_BLOCK, orders_per_block // ORDERS_PER_SLICE))
    part = F.floor(F.pmod("order_id", F.lit(orders_per_block)) * slices / orders_per_block)
    dealt = blocked.withColumn("_slice", part).hint("rebalance", "order_block", "_slice").drop("_slice")
    return dealt.sortWithinPartitions("order_block", "order_id")


def read_fact(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The stored fact as last published."""
    return TableSet(spark, path).read(FACT, version)


def write_fact(
    fct: DataFrame, path: str, orders_per_block: int = ORDERS_PER_BLOCK, audit: list[str] | None = None
) -> DataFrame:
    """Store the fact in blocks of consecutive orders, in place of what is there."""
    draft = TableSet(fct.sparkSession, path).draft(new_key())
    draft_fact(draft, FACT, fct, orders_per_block, audit)
    draft.publish()
    return read_fact(fct.sparkSession, path)


def draft_fact(draft: Draft, name: str, fct: DataFrame, orders_per_block: int = ORDERS_PER_BLOCK, audit: list[str] | None = None) -> DataFrame:
    """The whole fact as a table of a draft."""
    return draft.write(name, lambda: stamp(_sorted_blocks(_with_block(fct, orders_per_block), orders_per_block), audit or []), by="order_block")


def newest_order(stored: DataFrame):
    """The highest order of a stored fact: only its last block is scanned, as blocks follow the orders."""
    last = stored.agg(F.max("order_block").alias("block")).first().block
    if last is None:
        return None
    return stored.where(F.col("order_block") == last).agg(F.max("order_id").alias("top")).first().top


def _drop_scratch(spark: SparkSession, path: str) -> None:
    files.delete(spark, path)


def merge_into_fact(
    spark: SparkSession, path: str, new: DataFrame, after_order=None, orders_per_block: int = ORDERS_PER_BLOCK
) -> DataFrame:
    """Upsert a batch into the stored fact, touching only the blocks it falls into; readers see all of it or nothing."""
    draft = TableSet(spark, path).draft(new_key())
    draft_merge(draft, FACT, new, after_order, orders_per_block)
    draft.publish()
    return read_fact(spark, path)


def draft_merge(draft: Draft, name: str, new: DataFrame, after_order=None, orders_per_block: int = ORDERS_PER_BLOCK) -> DataFrame:
    """Upsert a batch into a fact of a draft.

    Without ``after_order`` every arriving order is newer than the stored ones, so the
    batch is written once, beside what the blocks hold. With it, the batch is written aside, as its
    blocks must be known first; these alone are read, merged and written anew.
    """
    spark, stored = draft.spark, draft.read(name)
    if after_order is None:
        bound = None if name in draft.resumed else newest_order(stored)
        arriving = new if bound is None else new.where(F.col("order_id") > bound)
        blocked = _with_block(arriving, orders_per_block).select(*stored.columns)
        return draft.add(name, lambda: _sorted_blocks(blocked, orders_per_block), by="order_block")

    aside = scratch_dir(spark, "fact-incoming")
    arriving = _with_block(new.where(F.col("order_id") > after_order), orders_per_block).select(*stored.columns)

    blocks: list[str] = []

    def touched() -> list[str]:
        """The batch's blocks: no more than the fact has or the batch adds."""
        arriving.write.parquet(aside)
        blocks.extend(str(r.order_block) for r in incoming().select("order_block").distinct().collect())
        return blocks

    def incoming() -> DataFrame:
        return spark.read.schema(arriving.schema).parquet(aside)

    def merged(read) -> DataFrame:
        rest = read(blocks).join(incoming().select(*FACT_KEY), FACT_KEY, "left_anti")
        return _sorted_blocks(rest.unionByName(incoming()), orders_per_block)

    result = draft.replace(name, merged, "order_block", touched)
    _drop_scratch(spark, aside)
    return result
