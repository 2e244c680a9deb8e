"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is a weighted set: its shingles of five words, each weighing how often it occurs times
its smoothed inverse document frequency, 1 + IDF_SHARE * ln(1 + documents / documents that have it).
The smoothing keeps large groups of near copies together: what they share is frequent because of
them, and an unsmoothed weight would count their few differences for more than all they share. Document frequencies cover all
documents and are kept per bucket of a hash (BUCKETS of them, whatever the corpus); the share of
documents in a bucket, and so the noise of that, does not grow with the corpus.

Every document draws SAMPLES consistent weighted samples; two documents agree on one with a chance
of their weighted Jaccard similarity. BANDS bands of ROWS samples put documents into buckets: at a
similarity of 0.8 a pair shares one with a chance of 0.9992. Buckets propose pairs that agree on a
share of LIKELY of all samples; bands and this bound together miss 0.080 % of pairs at 0.8. Of the
proposed pairs the weighted Jaccard similarity of the whole texts is computed; pairs from
`threshold` on are links, and a class is a connected component of links.

Equal texts are one node of the graph, so copies are never compared. Buckets are worked on in blocks
of about BLOCK nodes and BLOCK_BYTES of text, dealt by a hash of node and bucket. First the nodes of every
block meet, and what they link makes classes. Then, in buckets of several blocks, the nodes outside the
bucket's largest class visit all of its blocks, a block of visitors and a block of the bucket in a task of their own; pairs
within a class, which cannot change it, are left out. So every pair of a bucket is looked at, and a bucket
of one class, however large, is not gone through again.

A meeting has two steps. The first sees samples only and gives back the nodes that have a likely
partner; then the texts of these are sent for, and the second computes the similarities of
the likely pairs and gives back links that join classes, fewer than it has nodes. No pair is ever a row. A
pair that shares several buckets is computed in the first one.

Defined cases: null and empty texts are in classes of their own; a text of one to four words has
one shingle; texts without words are alike only if equal; rows repeated with the same doc_id are one
document and share its fate; rows with a null doc_id are documents of their own, and of a class of
such rows alone one row of the least text digest stays; rows of one doc_id with different texts are
judged each by its text; an empty table gives an empty result; columns besides the id and text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import mixed, row_of, shingles, slices, words
from tillroll.llm.bitmaps import bitmap, let_through
from tillroll.llm.graph import components, composed, renamed
from tillroll.llm.scratch import written

SHINGLE = 5
THRESHOLD = 0.8
IDF_SHARE = 0.02
BUCKETS = 1 << 20
BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
# Agreeing samples from which a pair is worth its exact similarity: at 0.8, fewer agree once in 19,000 times.
LIKELY = 0.5
BLOCK = 4096
BLOCK_BYTES = 16 << 20
ROWS_AT_ONCE = 256
COUNTS_PER_ROW = 1 << 14
RANDOMS = 1 << 16


def weighted_set(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (48 bits) of each row with their counts, sorted within rows, and the rows' offsets."""
    found, rows = shingles(words(column), SHINGLE)
    keys = np.sort(row_of(rows).astype(np.uint64) << np.uint64(48) | found >> np.uint64(16))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    offsets = np.searchsorted(keys >> np.uint64(48), np.arange(len(column) + 1))
    return keys & np.uint64((1 << 48) - 1), counts, offsets


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket's shingles occur, over all documents, and how many have any.

    BUCKETS counts, a fixed number, reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int32), 0
        for batch in batches:
            for part in slices(batch, "text"):
                keys, _, rows = weighted_set(part.column("text"))
                bucket = (keys & np.uint64(BUCKETS - 1)).astype(np.int64) | row_of(rows) << 20
                bucket = np.unique(bucket) & (BUCKETS - 1)
                np.add.at(total, bucket, 1)
                n += int((np.diff(rows) > 0).sum())
        if n:
            parts = total.reshape(-1, COUNTS_PER_ROW)
            used = np.flatnonzero(parts.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*used.tolist(), -1], pa.int32()), pa.array([*(parts[i].tobytes() for i in used), np.int64(n).tobytes()], pa.binary())],
                ["part", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                own = np.frombuffer(counts, np.int64 if part < 0 else np.int32).astype(np.int64)
                sums[part] = sums[part] + own if part in sums else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "counts"]
        )

    schema = "part int, counts binary"
    table, n = np.zeros((BUCKETS // COUNTS_PER_ROW, COUNTS_PER_ROW), np.int64), 0
    for row in docs.select("text").mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).collect():
        values = np.frombuffer(row["counts"], np.int64)
        if row["part"] < 0:
            n += int(values[0])
        else:
            table[row["part"]] += values
    return table.ravel(), n


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    table, n = document_frequencies(docs)
    return (1 + IDF_SHARE * np.log1p(max(n, 1) / np.maximum(table, 1))).astype(np.float32)


def random_tables() -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per sample: r and ln c of Gamma(2, 1), and beta of Uniform(0, 1), for RANDOMS hash values."""
    tables = []
    for k in range(SAMPLES):
        rng = np.random.default_rng(1000 + k)
        r = rng.gamma(2, 1, RANDOMS)
        tables.append((r.astype(np.float32), np.log(rng.gamma(2, 1, RANDOMS)).astype(np.float32), rng.random(RANDOMS, np.float32)))
    return tables


def samples(keys: np.ndarray, log_weights: np.ndarray, rows: np.ndarray, tables) -> np.ndarray:
    """Consistent weighted samples (rows x SAMPLES) of rows that have a shingle."""
    starts, sizes = rows[:-1], np.diff(rows)
    spread = mixed(keys.copy())
    result = np.zeros((len(starts), SAMPLES), np.uint32)
    row = row_of(rows)
    for k, (r, log_c, beta) in enumerate(tables):
        at = (spread * np.uint64(2 * k + 1) ^ spread >> np.uint64(k + 8)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)
        own_r, own_beta = r[at], beta[at]
        step = np.floor(log_weights / own_r + own_beta)
        log_a = log_c[at] - own_r * (step - own_beta + 1)
        least = np.minimum.reduceat(log_a, starts)
        chosen = np.flatnonzero(log_a == np.repeat(least, sizes))[::-1]
        first = np.empty(len(starts), np.int64)
        first[row[chosen]] = chosen
        picked = spread[first] + step[first].astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        result[:, k] = (mixed(picked) >> np.uint64(32)).astype(np.uint32)
    return result


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, node (digest of the text, null if empty), its size, samples and the keys of the bands (none without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, tables = shared.value, random_tables()
        for batch in batches:
            for part in slices(batch, "text"):
                keys, counts, rows = weighted_set(part.column("text"))
                some = np.flatnonzero(np.diff(rows))
                drawn, bands = [None] * len(part), [None] * len(part)
                if len(some):
                    logs = np.log(counts.astype(np.float32) * weights[(keys & np.uint64(BUCKETS - 1)).astype(np.int64)])
                    found = samples(keys, logs, np.append(rows[some], rows[-1]), tables)
                    band = np.zeros((len(some), BANDS), np.uint64)
                    for b in range(BANDS):
                        band[:, b] = b + 1
                        for k in range(b * ROWS, (b + 1) * ROWS):
                            band[:, b] = mixed(band[:, b] * np.uint64(0x9E3779B97F4A7C15) + found[:, k])
                    for i, s, b in zip(some.tolist(), found, band.view(np.int64)):
                        drawn[i], bands[i] = s.tobytes(), b
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "node", "size")), pa.array(drawn, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "node", "size", "drawn", "bands"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of("text").alias("node"), F.octet_length("text").cast("long").alias("size"), "text")
    return chosen.mapInArrow(run, "doc_id long, node binary, size long, drawn binary, bands array<long>")


def node_of(text: str):
    return F.when(F.length(text) > 0, F.unhex(F.md5(F.col(text))))


class Sides(NamedTuple):
    """The members of a meeting: samples, classes, and which of them are at home (rows) and which visit (columns).

    In a block's meeting with itself every member is both, and each two meet once.
    """

    drawn: np.ndarray
    classes: np.ndarray
    home: np.ndarray
    visiting: np.ndarray

    @staticmethod
    def of(members: pa.StructArray) -> Sides:
        drawn = np.frombuffer(b"".join(members.field("drawn").to_pylist()), np.uint32).reshape(len(members), SAMPLES)
        classes_ = np.unique([c.hex() for c in members.field("component").to_pylist()], return_inverse=True)[1]
        side = np.asarray(members.field("side"))
        return Sides(drawn, classes_, np.flatnonzero(side != VISITING), np.flatnonzero(side != HOME))


HOME, VISITING, BOTH = 0, 1, 2


def likely(sides: Sides, band: int, once: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(members at home, a matrix of their likely partners among the visitors), a few rows at a time.

    once: leave out pairs that share a bucket of an earlier band.
    """
    right = sides.drawn[sides.visiting]
    for first in range(0, len(sides.home), ROWS_AT_ONCE):
        rows = sides.home[first : first + ROWS_AT_ONCE]
        left = sides.drawn[rows]
        agree, earlier = np.zeros((len(rows), len(right)), np.uint8), np.zeros((len(rows), len(right)), bool)
        for b in range(BANDS):
            whole = np.ones_like(earlier)
            for k in range(b * ROWS, (b + 1) * ROWS):
                same = left[:, k][:, None] == right[:, k][None, :]
                agree += same
                whole &= same
            if once and b < band:
                earlier |= whole
        found = (agree >= LIKELY * SAMPLES) & ~earlier
        if len(sides.home) == len(sides.drawn) == len(sides.visiting):
            found &= rows[:, None] < sides.visiting[None, :]
        yield rows, found & (sides.classes[rows][:, None] != sides.classes[sides.visiting][None, :])


MEETING = "key long, band int, one long, two long, once boolean"
MEMBER = "side int, node binary, drawn binary, component binary"


def partnered(meetings: DataFrame) -> DataFrame:
    """The members of each meeting that have a likely partner in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                place = [batch.column(c)[k].as_py() for c in ("key", "band", "one", "two", "once")]
                members = batch.column("members")[k].values
                sides, wanted = Sides.of(members), np.zeros(len(members), bool)
                for rows, found in likely(sides, place[1], place[4]):
                    wanted[rows[found.any(1)]] = True
                    wanted[sides.visiting[found.any(0)]] = True
                if wanted.any():
                    kept = members.filter(pa.array(wanted))
                    n = len(kept)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v] * n, t) for v, t in zip(place, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))]
                        + [kept.field(c) for c in ("side", "node", "drawn", "component")],
                        ["key", "band", "one", "two", "once", "side", "node", "drawn", "component"],
                    )

    return meetings.mapInArrow(run, f"{MEETING}, {MEMBER}")


class Sets(NamedTuple):
    """The weighted sets of texts, one after the other: numbers of shingles, weights, offsets, and the sums of weights."""

    numbers: np.ndarray
    weights: np.ndarray
    rows: np.ndarray
    sums: np.ndarray

    @staticmethod
    def of(texts: pa.Array, idf: np.ndarray) -> Sets:
        keys, weights, counts = [], [], [np.zeros(1, np.int64)]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            own, times, rows = weighted_set(part.column("text"))
            keys.append(own)
            weights.append(times * idf[(own & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(float))
            counts.append(np.diff(rows))
        numbers = np.unique(np.concatenate(keys), return_inverse=True)[1]
        rows = np.cumsum(np.concatenate(counts))
        total = np.concatenate(weights)
        return Sets(numbers, total, rows, np.bincount(row_of(rows), total, len(texts)))

    def similarities(self, i: int, others: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarities of a text with others; all have shingles."""
        own = slice(self.rows[i], self.rows[i + 1])
        weight = np.zeros(self.numbers.max() + 1)
        weight[self.numbers[own]] = self.weights[own]
        sizes = self.rows[others + 1] - self.rows[others]
        starts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.rows[others] - starts, sizes)
        shared = np.add.reduceat(np.minimum(weight[self.numbers[at]], self.weights[at]), starts)
        return shared / np.maximum(self.sums[i] + self.sums[others] - shared, 1e-12)


def joining_links(wanted: DataFrame, texts: DataFrame, idf: Broadcast, threshold: float) -> DataFrame:
    """Links (a, b) between nodes of different classes that meet: of every meeting, as many as join all that is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for k in range(len(batch)):
                members = batch.column("members")[k].values
                sides, sets = Sides.of(members), Sets.of(members.field("text"), idf.value)
                names, classes_ = members.field("node").to_pylist(), sides.classes.copy()
                for rows, found in likely(sides, batch.column("band")[k].as_py(), batch.column("once")[k].as_py()):
                    for i, row in zip(rows.tolist(), found):
                        others = sides.visiting[row]
                        others = others[classes_[others] != classes_[i]]
                        for low in range(0, len(others), ROWS_AT_ONCE):
                            part = others[low : low + ROWS_AT_ONCE]
                            part = part[classes_[part] != classes_[i]]
                            if not len(part):
                                continue
                            for j in part[sets.similarities(i, part) >= threshold - 1e-9].tolist():
                                if classes_[i] != classes_[j]:
                                    classes_[classes_ == classes_[j]] = classes_[i]
                                    a.append(names[i])
                                    b.append(names[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    meetings = (
        wanted.join(texts, "node")
        .groupBy("key", "one", "two")
        .agg(F.first("band").alias("band"), F.first("once").alias("once"), F.collect_list(F.struct("side", "node", "drawn", "component", "text")).alias("members"))
    )
    return meetings.mapInArrow(run, "a binary, b binary")


def _met(rows: DataFrame) -> DataFrame:
    """Rows of (key, band, one, two, once) and a member, as meetings."""
    return rows.groupBy("key", "one", "two").agg(
        F.first("band").alias("band"), F.first("once").alias("once"), F.collect_list(F.struct("side", "node", "drawn", "component")).alias("members")
    ).select("key", "band", "one", "two", "once", "members")


def _block(blocks: str) -> Column:
    """A node's block; in every bucket another one, so that blocks of several buckets mix what they hold."""
    return F.pmod(F.xxhash64("node", "key"), F.col(blocks))


def within_blocks(members: DataFrame) -> DataFrame:
    """The meeting of every block with itself; members: key, band, node, drawn and blocks of the bucket."""
    none = F.lit(-1).cast("long")
    # Where a bucket is in several blocks, two nodes may miss each other in their first one: they meet in any.
    rows = members.withColumns({"one": _block("blocks"), "two": none, "once": F.col("blocks") == 1, "side": F.lit(BOTH), "component": F.col("node")})
    return _met(rows)


def across_blocks(members: DataFrame, found: DataFrame) -> DataFrame:
    """In buckets of several blocks, the meetings of blocks with those outside the bucket's largest class."""
    placed = members.where("blocks > 1").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max_by("component", "n").alias("largest"), (F.sum("n") - F.max("n")).alias("rest")).where("rest > 0")
    placed = placed.join(largest, "key").withColumn("visits", F.greatest(F.ceil(F.col("rest") / BLOCK), F.ceil(F.col("blocks") * F.col("rest") / F.col("n"))))
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)) for c in ("visits", "blocks")]
    home = placed.withColumns({"one": _block("blocks"), "two": every[0], "side": F.lit(HOME)})
    visitors = placed.where("component != largest").withColumns({"one": every[1], "two": _block("visits"), "side": F.lit(VISITING)})
    return _met(home.unionByName(visitors).withColumn("once", F.lit(True)))


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of the given nodes; a bitmap keeps other texts from being shuffled."""
    head = F.conv(F.substring(F.hex("node"), 1, 15), 16, 10).cast("long")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(nodes.select(head)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.asarray(batch.column("head"), np.int64).view(np.uint64)
            yield batch.take(pa.array(let_through(hashes, shared.value)))

    known = docs.select(node_of("text").alias("node"), "text").where("node is not null").withColumn("head", head)
    return (
        known.mapInArrow(run, "node binary, text string, head long")
        .drop("head")
        .join(nodes, "node", "left_semi")
        .dropDuplicates(["node"])
    )


def placed_rows(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node (digest of the text, null if empty), class_id and whether it stays, for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    idf = inverse_frequencies(docs)
    drawn = written(signatures(docs, idf).withColumn("row", F.monotonically_increasing_id()), "signatures")
    nodes = drawn.where("bands is not null").groupBy("node").agg(*(F.first(c).alias(c) for c in ("drawn", "bands", "size")))
    banded = nodes.select("node", "size", F.posexplode("bands").alias("band", "key"))
    full = banded.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).where("n > 1")
    full = full.select("key", "n", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).alias("blocks"))
    members = written(banded.drop("size").join(full, "key").join(nodes.select("node", "drawn"), "node"), "members")
    texts = written(texts_of(docs, members.select("node").distinct()), "texts")
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    near = written(joining_links(written(partnered(within_blocks(members)), "partnered"), texts, shared, threshold), "links", slim=True)
    found = written(components(near), "classes", slim=True)
    far = joining_links(written(partnered(across_blocks(members, found)), "partnered"), texts, shared, threshold)
    more = written(renamed(far, found), "links", slim=True)
    if more.limit(1).count():
        found = written(composed(found, components(more)), "classes", slim=True)
    shared.destroy()
    # An empty text is a class of its own, known by its document.
    own = F.coalesce("component", "node", F.concat(F.encode(F.lit("empty "), "utf-8"), F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")))
    placed = drawn.select("doc_id", "node", "row").join(found, "node", "left").select("doc_id", "node", "row", own.alias("class"))
    # Of a class without any id, one row of the least digest stays.
    nameless = F.when(F.col("doc_id").isNull() & F.col("node").isNotNull(), F.struct("node", "row"))
    first = placed.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.min(nameless).alias("least"))
    stays = F.when(F.col("class_id").isNotNull(), F.col("doc_id").eqNullSafe(F.col("class_id"))).otherwise(
        F.col("least").isNull() | (F.col("row") == F.col("least.row"))
    )
    return placed.join(first, "class").select("doc_id", "node", "class_id", F.coalesce(stays, F.lit(True)).alias("stays"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the smallest id of the class, null if it has none) and whether the document is the one that stays."""
    return placed_rows(docs, threshold).drop("node")


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with its own columns."""
    rows = placed_rows(docs, threshold).where("node is not null")
    gone = written(
        rows.groupBy(F.col("doc_id").alias("__gone"), F.col("node").alias("__node")).agg(F.max("stays").alias("__stays"), F.count("*").alias("__n"))
        .where("not __stays or __gone is null and __n > 1"),
        "gone",
    )
    id_, node = docs["doc_id"].cast("long"), F.when(F.length(docs["text"]) > 0, F.unhex(F.md5(docs["text"])))
    same = id_.eqNullSafe(F.col("__gone")) & (node == F.col("__node"))
    kept = docs.join(gone, same, "left_anti")
    # Equal rows without an id are told apart by nothing: any one of them stays.
    copies = docs.where(F.col("doc_id").isNull()).join(gone.where("__stays"), same).dropDuplicates(["__node"])
    return kept.unionByName(copies.select(*(docs[c] for c in docs.columns)))
