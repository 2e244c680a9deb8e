"""Order lines as their files arrive, each taken in exactly once.

A folder is watched by Spark's file source; what is new in it is merged into the stored lines, and the stream
stops when nothing is left (run it as often as files are expected). The checkpoint tells which files were read. A
batch that was merged but not yet noted there comes again with the same number: the stored lines know
the last number they hold, from the same rename that made it visible, and refuse it.

Lines are upserted by (order_id, product_id); of several lines with one key in a batch the one from the
latest file counts. Rows that do not fit their types go to a table of their own in the same step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sinks.tables import FACT, ORDERS_PER_BLOCK, draft_fact, draft_merge
from tillroll.sinks.tablesets import TableSet
from tillroll.sources.raw import COLUMN_TYPES, CSV_OPTIONS, sorted_out

REJECTED = "rejected"
LINES = list(COLUMN_TYPES["order_products"])


def latest(rows: DataFrame) -> DataFrame:
    """One line per key: that of the file changed last, then of the last path and the greatest line."""
    values = [c for c in LINES if c not in ("order_id", "product_id")]
    newest = F.max(F.struct("changed", "file", *values)).alias("newest")
    return rows.groupBy("order_id", "product_id").agg(newest).select("order_id", "product_id", *[F.col(f"newest.{c}").alias(c) for c in values])


def merge_batch(spark: SparkSession, rows: DataFrame, number: int, target: str, orders_per_block: int = ORDERS_PER_BLOCK) -> bool:
    """Merge one batch into the stored lines, unless they hold it; whether it was merged."""
    tables = TableSet(spark, target)
    if number <= tables.state()["notes"].get("batch", -1):
        return False
    draft = tables.draft(f"batch{number}")
    # Sorted out once and stored: what follows reads the copy.
    typed = sorted_out(rows, "order_products", keep=["changed", "file"])
    draft.write("arrived", lambda: typed, by="rejected")
    arrived = draft.read("arrived")
    keyed = arrived.where("NOT rejected AND order_id IS NOT NULL AND product_id IS NOT NULL")
    lines = latest(keyed)
    refused = arrived.where("rejected").select("file", "raw_text", F.lit(number).alias("batch"))
    if draft.has(REJECTED):
        draft.add(REJECTED, lambda: refused, by="batch")
    else:
        draft.write(REJECTED, lambda: refused, by="batch")
    if not draft.has(FACT):
        draft_fact(draft, FACT, lines, orders_per_block)
    else:
        first = keyed.agg(F.min("order_id").alias("first")).first()["first"]
        if first is not None:
            draft_merge(draft, FACT, lines, after_order=first - 1, orders_per_block=orders_per_block)
    draft.publish(batch=number)
    return True


def take_in(spark: SparkSession, folder: str, target: str, checkpoint: str, files_at_once: int = 1000, orders_per_block: int = ORDERS_PER_BLOCK) -> None:
    """Merge all files of a folder that were not taken in before into the stored lines at ``target``; ends when none is left."""
    text = (
        spark.readStream.schema(", ".join(f"{c} string" for c in LINES))
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", files_at_once)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(folder)
        .select(*LINES, F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_path").alias("file"))
    )

    def merge(rows: DataFrame, number: int) -> None:
        merge_batch(spark, rows, number, target, orders_per_block)

    stream = text.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
