"""Benchmark decontamination by spaced-seed hashing.

Fixed masks over a few token positions ignore some of them, so a hash over the others survives
substituted tokens. Hashes of test items and of documents are joined; around each hit the item is
laid along the document, and the longest stretch in which enough tokens agree decides. Items of
fewer than MIN_TOKENS tokens have masks of their own length besides, which find every substitution
that the rule allows them.

Before the join, documents drop hashes that no test item can have: a bitmap of fixed size
(whatever the size of the benchmark) is probed twice per hash. Hits near each other
form a region, which carries its tokens with CONTEXT tokens on either side.

A hash that up to FEW items have gives a row per hit and item. Hits of a hash that more items have (a
common opening, a fixed question) meet those items in blocks, where the tokens around the hits are compared at
once; only alignments that hold a long enough stretch become rows, so rows grow with findings, not with hits times items.

A document is contaminated by an item if, along one alignment, at least `min_tokens` tokens, or the
whole of a shorter item of at least `min_item` tokens, lie in a stretch of which a share of
`min_share` agrees.

Defined cases: null or empty texts have no tokens and no hits, nor have items of fewer than
`min_item` tokens (MIN_ITEM unless told otherwise, 1 at least; a word or two of everyday speech would
take clean documents along); items with the same tokens count as the one with the smallest id, those
whose ids are all null are found with a null item_id; rows with the
same doc_id, null too, share their findings, but each text is kept or removed for its own; empty
tables give an empty result; columns besides
the ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import mixed, powers, slices, words
from tillroll.llm.bitmaps import bitmap, let_through
from tillroll.llm.scratch import written

# Positions that count within a mask; the others may differ.
MASKS = ("111111", "11011011", "1101001011", "101100010011")
MIN_TOKENS = 13
MIN_SHARE = 0.8
MIN_ITEM = 6
CONTEXT = 160
FEW = 16
ITEM_BLOCK = 256
REGION_BLOCK_BITS = 8
PAIRS = 4_096


def short_masks(n: int, min_share: float = MIN_SHARE) -> list[str]:
    """Masks over all n places of a short item, one of which misses every substitution that the share allows.

    With m substitutions the places are m + 2 groups; each two groups are a mask, and two are always untouched.
    """
    groups = int(n * (1 - min_share) + 1e-9) + 2
    return ["".join("1" if k * groups // n in kept else "0" for k in range(n)) for kept in combinations(range(groups), 2)]


def masks_for(lengths: list[int], min_share: float = MIN_SHARE) -> list[tuple[int, str]]:
    """Numbered masks: MASKS, and those of short items of the given lengths."""
    own = [(1000 * n + k, mask) for n in lengths for k, mask in enumerate(short_masks(n, min_share))]
    return [*enumerate(MASKS, 1), *own]


def seeds(hashes: np.ndarray, rows: np.ndarray, masks: list[tuple[int, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per mask: the hash of each place and the places where the mask lies within one row."""
    ends = np.repeat(rows[1:], np.diff(rows))
    for number, mask in masks:
        size = len(mask)
        places = np.flatnonzero(np.arange(len(hashes)) + size <= ends)
        if not len(places):
            continue
        n = int(places[-1]) + 1
        total = np.full(n, number, np.uint64)
        for k, (bit, power) in enumerate(zip(mask, powers(size))):
            if bit == "1":
                total += hashes[k : k + n] * power
        yield mixed(total)[places], places


def test_items(benchmark: DataFrame, min_share: float = MIN_SHARE, min_item: int = MIN_ITEM) -> DataFrame:
    """Distinct items: item (digest of the tokens), item_id, tokens (4 bytes each) and seeds (hash, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = words(part.column("text"))
                low = found.hashes.astype(np.uint32)
                tokens, seed_lists = [], []
                for a, b in zip(found.rows[:-1], found.rows[1:]):
                    tokens.append(low[a:b].tobytes())
                    masks = masks_for([b - a] if min_item <= b - a < MIN_TOKENS else [], min_share)
                    own = [(h, p) for h, p in seeds(found.hashes[a:b], np.array([0, b - a]), masks)]
                    seed_lists.append(
                        [{"hash": int(x), "place": int(y)} for h, p in own for x, y in zip(h.view(np.int64), p)]
                    )
                kind = pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), pa.array(tokens, pa.binary()), pa.array(seed_lists, kind)],
                    ["item_id", "tokens", "seeds"],
                )

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "item_id long, tokens binary, seeds array<struct<hash: long, place: int>>"
    )
    items = items.where(F.length("tokens") >= 4 * max(1, min_item))
    first = items.groupBy("tokens").agg(F.min("item_id").alias("item_id"))
    distinct = first.join(items.select("tokens", "seeds").dropDuplicates(["tokens"]), "tokens")
    return distinct.withColumn("item", F.unhex(F.md5("tokens")))


def version_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


def regions(docs: DataFrame, filter_bytes: np.ndarray, masks: list[tuple[int, str]]) -> DataFrame:
    """Stretches of documents around seeds that the bitmap lets through: tokens, their offset, and the hits."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int32())]))
        for batch in batches:
            for part in slices(batch, "text"):
                found = words(part.column("text"))
                hits, places = [], []
                for h, p in seeds(found.hashes, found.rows, masks):
                    keep = let_through(h, table)
                    hits.append(h[keep])
                    places.append(p[keep])
                if not sum(map(len, hits)):
                    continue
                hits, places = np.concatenate(hits).view(np.int64), np.concatenate(places)
                order = np.argsort(places, kind="stable")
                hits, places = hits[order], places[order]
                rows = np.searchsorted(found.rows, places, "right") - 1
                # A region ends where the next hit is in another row or further than the context.
                cut = np.flatnonzero((np.diff(places) > CONTEXT) | (np.diff(rows) > 0)) + 1
                low = found.hashes.astype(np.uint32)
                out = {"row": [], "start": [], "tokens": [], "hits": []}
                for a, b in zip([0, *cut], [*cut, len(places)]):
                    r = rows[a]
                    first = max(found.rows[r], places[a] - CONTEXT)
                    last = min(found.rows[r + 1], places[b - 1] + CONTEXT)
                    out["row"].append(r)
                    out["start"].append(first - found.rows[r])
                    out["tokens"].append(low[first:last].tobytes())
                    out["hits"].append([{"hash": x, "place": y} for x, y in zip(hits[a:b].tolist(), (places[a:b] - first).tolist())])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(out["row"], pa.int64())),
                        part.column("version").take(pa.array(out["row"], pa.int64())),
                        pa.array(out["start"], pa.int64()),
                        pa.array(out["tokens"], pa.binary()),
                        pa.array(out["hits"], kind),
                    ],
                    ["doc_id", "version", "start", "tokens", "hits"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), version_of(F.col("text")).alias("version"), "text")
    return chosen.mapInArrow(run, "doc_id long, version binary, start long, tokens binary, hits array<struct<hash: long, place: int>>")


def longest_stretch(agree: np.ndarray, share: float = MIN_SHARE) -> tuple[int, int]:
    """The longest stretch of which that share agrees, as (first, past the last)."""
    gain = np.concatenate([[0.0], np.cumsum(np.where(agree, 1 - share, -share) + 1e-12)])
    lowest = np.minimum.accumulate(gain)
    first = np.searchsorted(-lowest, -gain, "left")
    length = np.arange(len(gain)) - first
    at = int(np.argmax(length))
    return int(first[at]), at


def around(tokens: Column, place: Column, hit: str) -> Column:
    """The tokens up to CONTEXT before and past a place, with how many lie before it."""
    before = F.least(place, F.lit(CONTEXT))
    window = F.substring(tokens, (place - before) * 4 + 1, (before + CONTEXT) * 4)
    return F.struct(hit, place.cast("int").alias("place"), before.cast("int").alias("before"), window.alias("window"))


def laid_out(found: pa.StructArray) -> np.ndarray:
    """Windows of hits as rows of equal length, their places below each other; 2**32 where no token is."""
    rows = np.full((len(found), 2 * CONTEXT), 1 << 32, np.int64)
    for i, (before, window) in enumerate(zip(found.field("before").to_pylist(), found.field("window").to_pylist())):
        tokens = np.frombuffer(window, np.uint32)
        rows[i, CONTEXT - before : CONTEXT - before + len(tokens)] = tokens
    return rows


def long_enough(agree: np.ndarray, least: np.ndarray, share: float) -> np.ndarray:
    """Whether each row holds a stretch of at least that many places of which the share agrees."""
    gain = np.zeros((len(agree), agree.shape[1] + 1))
    np.cumsum(np.where(agree, 1 - share, -share) + 1e-12, axis=1, out=gain[:, 1:])
    lowest = np.minimum.accumulate(gain, axis=1)
    result = np.zeros(len(agree), bool)
    for n in np.unique(least):
        own = least == n
        result[own] = (gain[own, n:] >= lowest[own, : gain.shape[1] - n]).any(1)
    return result


def alignments_of_many(hits: DataFrame, known: DataFrame, n_items: int, min_tokens: int, min_share: float) -> DataFrame:
    """(region, item, shift) of the hits and the items of one hash that hold a stretch; both sides meet in blocks.

    A place without a token on either side counts as one that differs, so this refuses no stretch that is one.
    """
    blocks = max(1, -(-n_items // ITEM_BLOCK))
    asked = hits.groupBy("hash", F.shiftright("region", REGION_BLOCK_BITS).alias("regions")).agg(
        F.collect_list(around(F.col("tokens"), F.col("at"), "region")).alias("hits")
    )
    asking = known.groupBy("hash", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("items")).agg(
        F.collect_list(around(F.col("tokens"), F.col("place"), "item")).alias("known"),
        F.collect_list((F.length("tokens") / 4).cast("int")).alias("sizes"),
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                hits, known = batch.column("hits")[i].values, batch.column("known")[i].values
                least = np.minimum(min_tokens, np.asarray(batch.column("sizes")[i].values))
                texts, tests = laid_out(hits), laid_out(known)
                tests[tests == 1 << 32] = -1
                at, place = np.asarray(hits.field("place")), np.asarray(known.field("place"))
                for first in range(0, len(texts), max(1, PAIRS // len(tests))):
                    some = texts[first : first + max(1, PAIRS // len(tests))]
                    agree = (some[:, None, :] == tests[None, :, :]).reshape(-1, tests.shape[1])
                    a, b = np.divmod(np.flatnonzero(long_enough(agree, np.tile(least, len(some)), min_share)), len(tests))
                    a += first
                    yield pa.RecordBatch.from_arrays(
                        [hits.field("region").take(pa.array(a)), known.field("item").take(pa.array(b)), pa.array((at[a] - place[b]).astype(np.int32))],
                        ["region", "item", "shift"],
                    )

    met = asked.join(asking, "hash").select("hits", "known", "sizes")
    return met.mapInArrow(meet, "region long, item binary, shift int")


def stretches(docs: DataFrame, benchmark: DataFrame, min_tokens: int = MIN_TOKENS, min_share: float = MIN_SHARE, min_item: int = MIN_ITEM) -> DataFrame:
    """The stretches of texts (doc_id, version: digest of the text) that overlap with an item, one or more a pair."""
    items = written(test_items(benchmark, min_share, min_item), "items")
    # Lengths under MIN_TOKENS only, so a few numbers; a benchmark without short items costs no more masks.
    short = items.select((F.length("tokens") / 4).cast("int").alias("n")).where(F.col("n") < MIN_TOKENS).distinct().collect()
    masks = masks_for(sorted(r["n"] for r in short), min_share)
    found = written(regions(docs, bitmap(items.select(F.explode("seeds.hash"))), masks), "regions").withColumn("region", F.monotonically_increasing_id())
    found = written(found, "numbered-regions")
    hits = found.select("region", "tokens", F.explode("hits").alias("hit")).select("region", "tokens", "hit.hash", F.col("hit.place").alias("at"))
    known = items.select("item", "tokens", F.explode("seeds").alias("seed")).select("item", "tokens", "seed.hash", "seed.place")
    shared = written(known.groupBy("hash").agg((F.countDistinct("item") > FEW).alias("many")), "seeds")
    few, many = shared.where(~F.col("many")).select("hash"), shared.where("many").select("hash")
    aligned = hits.drop("tokens").join(known.drop("tokens").join(few, "hash"), "hash").select("region", "item", (F.col("at") - F.col("place")).alias("shift"))
    n_many = known.join(many, "hash", "left_semi").select("item").distinct().count()
    if n_many:
        aligned = aligned.union(
            alignments_of_many(hits.join(many, "hash", "left_semi"), known.join(many, "hash", "left_semi"), n_many, min_tokens, min_share)
        )
    aligned = aligned.distinct()
    laid = (
        aligned.join(items.select("item", "item_id", F.col("tokens").alias("item_tokens")), "item")
        .join(found.select("region", "doc_id", "version", "start", "tokens"), "region")
        .select("doc_id", "version", "item", "item_id", "start", "shift", "tokens", "item_tokens")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, start, length, same = [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("start", "shift", "tokens", "item_tokens")]
            for i, (offset, shift, tokens, item) in enumerate(zip(*columns)):
                t, q = np.frombuffer(tokens, np.uint32), np.frombuffer(item, np.uint32)
                low, high = max(0, shift), min(len(t), shift + len(q))
                agree = t[low:high] == q[low - shift : high - shift]
                a, b = longest_stretch(agree, min_share)
                if b - a >= min(min_tokens, len(q)):
                    keep.append(i)
                    start.append(offset + low + a)
                    length.append(b - a)
                    same.append(int(agree[a:b].sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep, pa.int64())),
                    batch.column("version").take(pa.array(keep, pa.int64())),
                    batch.column("item").take(pa.array(keep, pa.int64())),
                    batch.column("item_id").take(pa.array(keep, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(same, pa.int64()),
                ],
                ["doc_id", "version", "item", "item_id", "start", "n_tokens", "n_same"],
            )

    return laid.mapInArrow(verify, "doc_id long, version binary, item binary, item_id long, start long, n_tokens long, n_same long")


def overlaps(docs: DataFrame, benchmark: DataFrame, min_tokens: int = MIN_TOKENS, min_share: float = MIN_SHARE, min_item: int = MIN_ITEM) -> DataFrame:
    """Pairs (doc_id, item_id) with the place and length in tokens of their longest overlap."""
    checked = stretches(docs, benchmark, min_tokens, min_share, min_item)
    best = F.max(F.struct("n_same", "n_tokens", (-F.col("start")).alias("before"))).alias("best")
    return checked.groupBy("doc_id", "item", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.before")).alias("start_token"), F.col("best.n_tokens").alias("n_tokens"),
        F.col("best.n_same").alias("n_same"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, min_item: int = MIN_ITEM) -> DataFrame:
    """The documents that no test item contaminates."""
    bad = stretches(docs, benchmark, min_item=min_item).select(F.col("doc_id").alias("__contaminated"), F.col("version").alias("__version")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(bad["__contaminated"]) & (version_of(docs["text"]) == bad["__version"])
    return docs.join(bad, same, "left_anti")
