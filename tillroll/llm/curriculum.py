"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, linear in time: its rate at time t is
``target * (1 + tilt * (2 t - 1))``. Integrated, the words it has been asked for by time t are
``target * (t + tilt * (t * t - t))``. A source gives its documents in the order of a hash of
their id (of their text, without one), pass after pass; the middle of each document's stretch of words, looked up in the
inverse of that integral, is its training position. Sorting by position mixes the sources.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and share a multiple
of all words; no target is above a multiple of its source's words, the excess going to the others
by weight. The level is found in one pass over the sources sorted by where they cap.

Defined cases: a null or empty text has size 0, is taken 0 times over and has no position; null
sources are one source; repeated rows are documents of their own, in any order among themselves;
an empty table gives an empty result; columns of the input besides id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
TILTS = (0.5, 0.0, -0.5)
SHARE = 1.5
MOST = 2.0
SLOTS = 4096


def document_sizes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", extra: list[str] | None = None) -> DataFrame:
    """doc_id, source and size, the number of runs without white space (null: 0), and further columns."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), *(extra or []))


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add rank, weight and target to rows of (source, source_size), one per source.

    The level is the one at which the capped shares add up to `share` of all words.
    """
    # One row per source from here on; the windows see nothing larger.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("cap_at", "rank")
    everything = Window.partitionBy(F.lit(1))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        totals.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("cap_at", F.col("cap") / F.col("weight"))
        .withColumn("capped_before", F.sum("cap").over(by_cap) - F.col("cap"))
        .withColumn("weight_from", F.sum("weight").over(everything) - F.sum("weight").over(by_cap) + F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(everything) * share - F.col("capped_before")) / F.col("weight_from"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("cap_at"), F.struct("cap_at", "rank", "level"))).over(everything)["level"])
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return ranked.select("source", "source_size", "rank", F.round(target, 6).alias("target"))


def time_of(share: Column, tilt: Column) -> Column:
    """The time by which that share of a source's words has been asked for."""
    return 2 * share / ((1 - tilt) + F.sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share))


def curriculum(docs: DataFrame, weights=WEIGHTS, tilts=TILTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: sizes, its source's target, copies, words taken and training positions.

    Running sums are taken per slot of the id's hash (the text's, where there is no id), so a source of any
    size is cut into SLOTS parts: one sum per slot, the slots' offsets from at most SLOTS rows a source, then the
    documents within a slot. Texts are read once: their sizes and keys are stored.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("/"), F.md5(F.coalesce("text", F.lit(""))))))
    slot = F.conv(F.substring("key", 1, 3), 16, 10).cast("int")
    assert SLOTS == 16**3
    sized = written(document_sizes(docs.withColumn("__key", key), extra=["__key"]).withColumnRenamed("__key", "key").withColumn("slot", slot), "sizes")
    slots = sized.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    before = Window.partitionBy("source").orderBy("slot")
    offsets = slots.withColumn("before", F.sum("slot_size").over(before) - F.col("slot_size"))
    totals = slots.groupBy("source").agg(F.sum("slot_size").alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    facts = offsets.withColumnRenamed("source", "o_source").join(
        targets.withColumnRenamed("source", "t_source"), F.col("o_source").eqNullSafe(F.col("t_source"))
    ).withColumnRenamed("slot", "o_slot")
    # Both sides meet per source and slot, so no source meets in one task.
    placed = sized.join(facts, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("slot") == F.col("o_slot")))
    within = Window.partitionBy("o_source", "o_slot").orderBy("key", "doc_id", "size")
    start = F.col("before") + F.sum("size").over(within) - F.col("size")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    copies = F.when(
        F.col("size") > 0,
        F.col("passes") + F.when(F.col("start") + F.col("size") / 2 <= F.col("rest"), 1).otherwise(0),
    ).otherwise(0)
    tilt = F.element_at(F.array(*[F.lit(float(t)) for t in tilts]), (F.col("rank") % len(tilts) + 1).cast("int"))
    asked = lambda c: F.least(
        F.lit(1.0), (c * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.greatest(F.col("target"), F.lit(1e-9))
    )
    positions = F.when(
        F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda c: time_of(asked(c), tilt))
    ).otherwise(F.array().cast("array<double>"))
    return (
        placed.withColumn("start", start)
        .withColumn("passes", passes.cast("int"))
        .withColumn("rest", rest)
        .withColumn("copies", copies.cast("int"))
        .select(
            "doc_id", "source", "size", "source_size", "target",
            (F.col("size") * F.col("copies")).alias("taken"), "copies", positions.alias("positions"),
        )
    )


def training_order(mix: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by training position."""
    return mix.select("doc_id", "source", "size", F.explode("positions").alias("position")).orderBy("position", "doc_id")
