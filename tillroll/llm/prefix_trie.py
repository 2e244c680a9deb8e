"""The trie of conversation prefixes, its subtree totals by parallel tree contraction.

Conversations are rebuilt with shared openings: of every conversation the first `opening` turns are
those of the conversation it stems from, then come its own turns after as many. Every distinct sequence of
a conversation's first d turns is a node of depth d; the root has no turns.

A prefix is named by hashes that add up: a turn's digest with its depth gives four numbers of 32
bits, and a prefix is the digest of its depth and their sums. So prefixes are running sums, made in blocks of BLOCK
turns with one row per block in between; a conversation with a third of all turns is many blocks.

Totals over subtrees come from contraction in rounds of joins. A round rakes every leaf into its
parent, then compresses unary chains: of two unary nodes in a row the one with the lower hash of the
round stays, any other unary node is spliced out, its weight left on the edge above its child. Both
at once leave a share of the nodes, so rounds grow with the logarithm of the tree, however deep. A
leaf's total is known when it is raked. Afterwards the rounds are gone through backwards: a
spliced node's total is that of the child it was left above, plus what had been gathered on the way.

The list of a node's ends is hashed in order. A digest has no parallel form, so pieces of the list
are written by range-sorted parts and one task then hashes a node's pieces as they stream by, in
constant memory.

Defined cases: turns are ordered by turn (null first), then role and digest of the text; null roles
and texts are empty; rows without a conv_id belong to no conversation and take no part; repeated
rows are turns of their own; a conversation whose opening stems from an absent one starts with its
own later turns, or has none and ends at the root; `%` keeps the sign of a negative id; an empty
table has no nodes, not even a root; columns besides conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import written
from tillroll.operators.numbering import number_rows

FAMILY = 20
OPENINGS = 4
BLOCK = 1024
LANES = 4
PIECE_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def stem(conv_id: Column) -> Column:
    """The conversation whose first turns open this one."""
    return conv_id - conv_id % FAMILY


def opening(conv_id: Column) -> Column:
    """How many turns of its opening are those of its stem."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % OPENINGS).cast("long")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest of role and text, and words, of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    chosen = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.md5(text).alias("content"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    placed = number_rows(chosen, "conv_id", ["turn", "role", "content"], "place")
    digest = F.md5(F.concat_ws(":", F.length("role"), "role", "content"))
    return placed.select("conv_id", F.col("place").cast("long").alias("place"), digest.alias("digest"), "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, depth, length, digest, words) of the rebuilt conversations, and (conv_id, length) of all of these."""
    own = written(numbered_turns(turns), "turns")
    id_ = F.col("conv_id")
    sizes = own.groupBy("conv_id").agg(F.max("place").alias("n"))
    stems = sizes.select(id_.alias("stem"), F.col("n").alias("had"))
    convs = sizes.select("conv_id", "n", stem(id_).alias("stem"), opening(id_).alias("open")).join(stems, "stem", "left")
    given = F.least("open", F.coalesce("had", F.lit(0)))
    convs = convs.select("conv_id", "stem", "open", given.alias("given"), (given + F.greatest(F.col("n") - F.col("open"), F.lit(0))).alias("length"))
    convs = written(convs, "conversations")
    later = (
        own.join(convs.select("conv_id", "open", "given", "length"), "conv_id")
        .where("place > open")
        .select("conv_id", (F.col("place") - F.col("open") + F.col("given")).alias("depth"), "length", "digest", "words")
    )
    heads = own.where(F.col("place") < OPENINGS).withColumnRenamed("conv_id", "stem")
    first = convs.select("conv_id", "stem", "open", "length").join(heads, "stem").where("place <= open")
    return later.unionByName(first.select("conv_id", F.col("place").alias("depth"), "length", "digest", "words")), convs.select("conv_id", "length")


def named(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws("-", depth, *(s % (1 << 32) for s in sums))))


def prefixes(turns: DataFrame) -> DataFrame:
    """The node and its parent for every turn of (conv_id, depth, digest); other columns stay."""
    lanes = [f"lane{i}" for i in range(LANES)]
    placed = F.md5(F.concat_ws(":", "depth", "digest"))
    cut = turns.withColumn("block", F.floor((F.col("depth") - 1) / BLOCK)).withColumns(
        {name: F.conv(F.substring(placed, 8 * i + 1, 8), 16, 10).cast("long") for i, name in enumerate(lanes)}
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth")
    blocks = cut.groupBy("conv_id", "block").agg(*(F.sum(n).alias(n) for n in lanes))
    # One row per block from here on; most conversations have one.
    along = Window.partitionBy("conv_id").orderBy("block")
    before = blocks.select("conv_id", "block", *((F.sum(n).over(along) - F.col(n)).alias(f"{n}_before") for n in lanes))
    sums = cut.withColumns({f"{n}_sum": F.sum(n).over(so_far) for n in lanes}).join(before, ["conv_id", "block"])
    total = [F.col(f"{n}_sum") + F.col(f"{n}_before") for n in lanes]
    above = [t - F.col(n) for t, n in zip(total, lanes)]
    return sums.select(
        *(c for c in turns.columns if c != "digest"),
        named(F.col("depth"), total).alias("node"),
        named(F.col("depth") - 1, above).alias("parent"),
    )


def root() -> Column:
    return named(F.lit(0).cast("long"), [F.lit(0).cast("long")] * LANES)


def subtree_totals(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """node and, for each weight, its sum over the node's subtree; nodes are (node, parent, weights), the root's parent is null."""
    edge = [f"{w}_above" for w in weights]
    live = nodes.select("node", "parent", *weights, *(F.lit(0).cast("long").alias(e) for e in edge))
    raked, spliced = [], []
    while True:
        kids = live.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"), F.min("node").alias("child"))
        marked = written(live.join(kids, "node", "left"), "marked", slim=len(raked) > 0)
        leaves = marked.where("kids is null")
        raked.append(leaves.select("node", *weights))
        gifts = leaves.groupBy(F.col("parent").alias("node")).agg(F.lit(True).alias("given"), *(F.sum(F.col(w) + F.col(e)).alias(f"{w}_given") for w, e in zip(weights, edge)))
        inner = written(
            marked.where("kids is not null").join(gifts, "node", "left").select(
                "node", "parent", *((F.col(w) + F.coalesce(f"{w}_given", F.lit(0))).alias(w) for w in weights), *edge,
                # Its only child, if that stays too.
                F.when((F.col("kids") == 1) & F.col("given").isNull() & F.col("parent").isNotNull(), F.col("child")).alias("child"),
            ),
            "inner", slim=True,
        )
        if not inner.limit(1).count():
            break
        chance = F.xxhash64("node", F.lit(len(raked)))
        unary = inner.where("child is not null").select("node", "child", chance.alias("chance"))
        below = unary.select(F.col("node").alias("child"), F.col("chance").alias("child_chance"))
        stays = unary.join(below, "child").select(F.when(F.col("chance") < F.col("child_chance"), F.col("node")).otherwise(F.col("child")).alias("node")).distinct()
        chosen = inner.where("child is not null").join(stays, "node", "left_anti")
        out = chosen.select(
            F.col("node").alias("out"), F.col("parent").alias("up"), F.col("child").alias("node"),
            *(F.col(w).alias(f"{w}_out") for w in weights), *(F.col(e).alias(f"{e}_out") for e in edge),
        )
        joined = written(inner.join(out, "node", "left"), "joined", slim=True)
        spliced.append(
            joined.where("out is not null").select(F.col("out").alias("spliced"), "node", *((F.col(f"{w}_out") + F.col(e)).alias(f"{w}_more") for w, e in zip(weights, edge)))
        )
        gone = joined.where("out is not null").select(F.col("out").alias("node"))
        over = {e: F.col(e) + F.coalesce(F.col(f"{w}_out") + F.col(f"{e}_out"), F.lit(0)) for w, e in zip(weights, edge)}
        live = joined.join(gone, "node", "left_anti").select(
            "node", F.when(F.col("out").isNotNull(), F.col("up")).otherwise(F.col("parent")).alias("parent"), *weights, *(v.alias(e) for e, v in over.items())
        )
    # Backwards: a node left above a child in some round gets its total from rounds after it.
    known = raked[-1:]
    for leaves, gone in zip(reversed(raked[:-1]), reversed(spliced)):
        later = reduce(DataFrame.unionByName, known)
        found = gone.join(later, "node").select(F.col("spliced").alias("node"), *((F.col(w) + F.col(f"{w}_more")).alias(w) for w in weights))
        known += [written(found, "expanded", slim=True), leaves]
    return reduce(DataFrame.unionByName, known)


def listed_digests(members: DataFrame) -> DataFrame:
    """node and the SHA-256 of its ids, ascending, joined by commas; members are (node, conv_id)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([b",".join(held)], pa.binary())], ["node", "first", "piece"]
            )

        for batch in batches:
            for own, id_ in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if held and (own != node or size >= PIECE_BYTES):
                    yield piece()
                    held, size = [], 0
                if not held:
                    node, first = own, id_
                held.append(str(id_).encode())
                size += len(held[-1]) + 1
        if held:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done, found = [], []
            for own, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
                if own != node:
                    if node is not None:
                        done.append(node)
                        found.append(state.hexdigest())
                    node, state = own, hashlib.sha256(piece)
                else:
                    state.update(b",")
                    state.update(piece)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary()), pa.array(found, pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    order = ["node", "conv_id"]
    parts = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "node binary, first long, piece binary")
    return parts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    rows, convs = rebuilt(turns)
    paths = written(prefixes(rows), "paths")
    zero = F.lit(0).cast("long")
    everyone = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = everyone.select(root().alias("node"), F.lit(None).cast("binary").alias("parent"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("words"))
    nodes = paths.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("words").alias("words")
    )
    nodes = written(nodes.unionByName(top), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    tree = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    tree = written(tree.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).withColumn("leaf", (F.col("n_children") == 0).cast("long")), "tree")
    totals = subtree_totals(tree.select("node", "parent", "leaf", "saved"), ["leaf", "saved"])
    ends = paths.where("depth = length").select("node", "conv_id").unionByName(convs.where("length = 0").select(root().alias("node"), "conv_id"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = (
        tree.drop("leaf", "saved")
        .join(totals.select("node", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens")), "node")
        .join(listed_digests(ends), "node", "left")
        .join(above, "parent", "left")
    )
    none = F.sha2(F.lit("").cast("binary"), 256)
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
