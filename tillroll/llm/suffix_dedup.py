"""Removal of repeated byte strings with suffix arrays, built by a distributed difference-cover algorithm.

A byte goes if it lies in a string of LENGTH bytes that also starts in a document with a smaller id.
Strings are judged on the input.

1. Every string of LENGTH bytes has a key that its content alone decides: the least hash among its
   GRAM-byte substrings. Neighbouring strings mostly share it. Keys that occur in one document
   only cannot belong to a repeated string; a shuffle of keys finds those, and only runs of strings
   with other keys, cut into segments where the content says so, go on.
2. Equal segments are sorted once, under the smallest id that has them. In any other document they
   are repeated as a whole.
3. Segments are cut into runs of one key and dealt out by key, so equal strings meet whatever
   document they are from. Equal runs of a bucket are sorted once, under the smallest id, and those
   whose key no other id has then need no sorting. Of the rest each bucket builds the suffix array by the
   difference-cover algorithm: sort the triples at two of three places, name them, recurse on the
   names until they span LENGTH, merge in the remaining suffixes; then the LENGTH-byte prefixes of
   adjacent suffixes are compared, and the smallest id of each group of equal ones is known.
4. Strings that start in a smaller document become spans, which are joined to the texts.

A bucket that outgrows BUCKET_LIMIT is not sorted but passed on, its strings dealt out anew by finer
keys (least hashes of more hash functions). What is left after LEVELS of those, such as one string
in very many texts, is compared string by string in an aggregate. So a passage in a third of all
documents, each going on differently, needs no more memory than others.

Defined cases: a null text is empty; a null doc_id comes after all others; rows with the same doc_id never
remove bytes from each other, and those with the same text too share their result; texts under
LENGTH bytes lose nothing; an empty table gives an empty result; columns besides id and text are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import mixed, powers, row_of, slices, text_bytes
from tillroll.llm.scratch import written

LENGTH = 50
GRAM = 20
# A segment ends before a key whose last bits are zero: after eight keys or about 130 strings, on average.
CUT = np.uint64(7)
BUCKET_BYTES = 1 << 18
BUCKET_LIMIT = 1 << 21
CUT_BYTES = 1 << 21
FLUSH = 1 << 19
LEVELS = 3
LAST = np.iinfo(np.int64).max
# Rows without an id are told apart by numbers from FIRST to below NAMELESS, which no document should have as its id.
FIRST = np.iinfo(np.int64).min
NAMELESS = FIRST + (1 << 60)
KEYS_BYTES = 1 << 22
_SEED = np.uint64(0xA24BAED4963EE407)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all substrings of `size` bytes, by doubling their length."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part, length = data.astype(np.uint64) + np.uint64(1), 1
    total, done = np.zeros(n, np.uint64), 0
    step = powers(1)
    while done < size:
        if size & length:
            total = total * step + part[done : done + n]
            done += length
        if done < size:
            part = part[:-length] * step + part[length:]
            step, length = step * step, 2 * length
    return mixed(total)


def window_least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    span, least = 1, h
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def string_keys(data: np.ndarray, level: int = 0) -> np.ndarray:
    """The key of the string of LENGTH bytes that starts at each place."""
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64)
    if level >= LEVELS:
        return gram_hashes(data, LENGTH)
    grams = gram_hashes(data, GRAM)
    width = LENGTH - GRAM + 1
    keys = window_least(grams, width)
    for k in range(1, level + 1):
        keys = mixed(keys ^ window_least(mixed(grams ^ _SEED * np.uint64(k)), width))
    return keys


def runs(keys: np.ndarray, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of runs of one key; `whole` tells which places have a string at all."""
    change = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    if whole is not None:
        change |= np.append(True, whole[1:] != whole[:-1])
    first = np.flatnonzero(change)
    sizes = np.diff(np.append(first, len(keys)))
    if whole is not None:
        first, sizes = first[whole[first]], sizes[whole[first]]
    return first, sizes


# --- the suffix array ---------------------------------------------------------


def _names(*columns: np.ndarray) -> np.ndarray:
    """Order-keeping names from 1 on of tuples of numbers."""
    bits = [max(1, int(c.max()).bit_length()) for c in columns]
    if sum(bits) > 63:
        columns = [np.unique(c, return_inverse=True)[1] + 1 for c in columns]
        bits = [int(c.max()).bit_length() for c in columns]
    if sum(bits) > 63:
        return _names(_names(*columns[:-1]), columns[-1])
    key = columns[0]
    for column, size in zip(columns[1:], bits[1:]):
        key = key << size | column
    return np.unique(key, return_inverse=True)[1] + 1


def suffix_ranks(x: np.ndarray, depth: int, wanted: np.ndarray) -> np.ndarray:
    """Ranks of the wanted suffixes of x, given as a mask; the other entries mean nothing.

    Suffixes equal in their first `depth` symbols have neighbouring ranks. Difference-cover
    algorithm modulo 3; names that span `depth` symbols end the recursion. Triples are named at all
    sampled places, but only wanted suffixes, and those they are compared by, are merged.
    """
    n = len(x)
    x = np.concatenate([x, np.zeros(3 + (-n) % 3, np.int64)])
    size = len(x) - 3
    wanted = np.concatenate([wanted, np.zeros(size - n + 3, bool)])
    one, two = np.arange(1, size, 3), np.arange(2, size, 3)
    sample = np.concatenate([one, two])
    bits = max(1, int(x.max()).bit_length())
    if 3 * bits <= 21 and depth > 3:
        # Triples of few bits are their own names.
        names = x[sample] << 2 * bits | x[sample + 1] << bits | x[sample + 2]
    else:
        names = _names(x[sample], x[sample + 1], x[sample + 2])
    if depth > 3:
        # Compared by: a sampled suffix itself, and the one after a remaining suffix, or two after.
        needed = wanted.copy()
        needed[1:] |= wanted[:-1]
        needed[2:] |= wanted[:-2]
        mask = np.concatenate([needed[one], [False], needed[two]])
        names = suffix_ranks(np.concatenate([names[: len(one)], [0], names[len(one) :]]), -(-depth // 3), mask)
        names = np.delete(names, len(one)) + 1
    rank = np.zeros(size + 3, np.int64)
    rank[sample] = names
    rest, one, two = (places[wanted[places]] for places in (np.arange(0, size, 3), one, two))
    # A remaining suffix is compared with one at 1 modulo 3 by a symbol and a rank, at 2 by two and a rank.
    both = np.concatenate([rest, two])
    pairs = x[both] << bits | x[both + 1] if bits <= 20 else _names(x[both], x[both + 1])
    top = int(rank.max()).bit_length() + 1
    if max(int(x.max()).bit_length(), int(pairs.max(initial=1)).bit_length()) + top > 63:
        pairs, top = _names(pairs), top
    short = lambda i: x[i] << top | rank[i + 1]
    rest_short, rest_long = short(rest), pairs[: len(rest)] << top | rank[rest + 2]
    two_long = pairs[len(rest) :] << top | rank[two + 2]
    sorted_short, sorted_long = np.sort(rest_short), np.sort(rest_long)
    sampled = np.sort(np.concatenate([rank[one], rank[two]]))
    result = np.zeros(size, np.int64)
    one_short = short(one)
    result[one] = np.searchsorted(sampled, rank[one]) + np.searchsorted(sorted_short, one_short)
    result[two] = np.searchsorted(sampled, rank[two]) + np.searchsorted(sorted_long, two_long)
    result[rest] = (
        np.searchsorted(sorted_short, rest_short)
        + np.searchsorted(np.sort(one_short), rest_short)
        + np.searchsorted(np.sort(two_long), rest_long)
    )
    return result[:n]


def equal_groups(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in suffix order, and the number of the group of equal LENGTH-byte prefixes of each."""
    symbols = np.zeros(256, np.int64)
    used = np.flatnonzero(np.bincount(data, minlength=256))
    symbols[used] = np.arange(1, len(used) + 1)
    wanted = np.zeros(len(data), bool)
    wanted[places] = True
    rank = suffix_ranks(symbols[data], LENGTH, wanted)
    order = places[np.argsort(rank[places], kind="stable")]
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words[: len(data) - 7] |= data[k : len(data) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    same = np.ones(len(order) - 1, bool)
    for offset in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        left = np.flatnonzero(same)
        same[left] = words[order[left] + offset] == words[order[left + 1] + offset]
    return order, np.concatenate([[0], np.cumsum(~same)])


# --- the steps ----------------------------------------------------------------


def keyed(docs: DataFrame) -> DataFrame:
    """id (null ones last), own (the id, or a number by text below NAMELESS), version (digest of the text) and text."""
    version = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    nameless = F.lit(FIRST) + F.xxhash64(version).bitwiseAND(NAMELESS - FIRST - 1)
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
        F.coalesce(F.col("doc_id").cast("long"), nameless).alias("own"),
        version.alias("version"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def orders(own: np.ndarray) -> np.ndarray:
    """The ids that decide which document is earlier: the last one for rows without an id."""
    return np.where(own < NAMELESS, LAST, own)


def shared_keys(texts: DataFrame, buckets: int) -> DataFrame:
    """(id, key) of the keys of strings that occur under two ids at least; id is that of `own`.

    A task sends each key once, with one of its ids, and decides by itself about keys it has seen
    under several; so a key in many documents is no large group anywhere. Rows without an id, which are
    equally late, send theirs each: their keys come back to the rows of one text, not to all of these rows.
    """
    bits = np.uint64(64 - (buckets.bit_length() - 1))
    names = ["bucket", "ids", "keys"]
    kinds = [pa.int32(), pa.binary(), pa.binary()]

    def flush(ids: list[np.ndarray], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids, keys = np.concatenate(ids), np.concatenate(keys)
        order = np.lexsort((ids, orders(ids), keys))
        ids, keys = ids[order], keys[order]
        late = orders(ids)
        new = np.append(True, keys[1:] != keys[:-1])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(keys)))
        several = np.repeat(late[first] != late[first + sizes - 1], sizes)
        # Known here already: for every id, its keys of several ids.
        known = np.flatnonzero(several & (new | np.append(True, ids[1:] != ids[:-1])))
        rows = [(-1 - int(part), *both) for part, *both in pieces(ids[known], keys[known], ids[known] % buckets)]
        sent = np.flatnonzero(new | (~several & (late == LAST) & np.append(True, ids[1:] != ids[:-1])))
        rows += [(int(part), *both) for part, *both in pieces(ids[sent], keys[sent], (keys[sent] >> bits).astype(np.int64))]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def pieces(ids: np.ndarray, keys: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        order = np.argsort(part, kind="stable")
        ids, keys, part = ids[order], keys[order], part[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for a, b in zip(first, np.append(first[1:], len(part))):
            yield part[a], ids[a:b].tobytes(), keys[a:b].tobytes()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, held = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                found = string_keys(data)
                whole = np.arange(len(found)) + LENGTH <= np.repeat(offsets[1:], np.diff(offsets))[: len(found)]
                first, _ = runs(found, whole)
                ids.append(np.asarray(part.column("own"), np.int64)[np.searchsorted(offsets, first, "right") - 1])
                keys.append(found[first])
                held += len(first)
                if held >= FLUSH:
                    yield from flush(ids, keys)
                    ids, keys, held = [], [], 0
        if held:
            yield from flush(ids, keys)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def several(ids: list[bytes], keys: list[bytes]) -> pa.RecordBatch:
            ids, keys = np.frombuffer(b"".join(ids), np.int64), np.frombuffer(b"".join(keys), np.uint64)
            order = np.argsort(keys, kind="stable")
            ids, keys = ids[order], keys[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sizes = np.diff(np.append(first, len(keys)))
            late = orders(ids)
            keep = np.repeat(np.minimum.reduceat(late, first) != np.maximum.reduceat(late, first), sizes)
            return rows(ids[keep], keys[keep])

        def rows(ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.view(np.int64))], ["id", "key"])

        at, ids, keys = None, [], []
        for batch in batches:
            for bucket, i, k in zip(*(batch.column(c).to_pylist() for c in names)):
                if bucket < 0:
                    yield rows(np.frombuffer(i, np.int64), np.frombuffer(k, np.uint64))
                    continue
                if bucket != at and ids:
                    yield several(ids, keys)
                    ids, keys = [], []
                at = bucket
                ids.append(i)
                keys.append(k)
        if ids:
            yield several(ids, keys)

    sent = texts.select("own", "text").mapInArrow(find, "bucket int, ids binary, keys binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "id long, key long")


def segments(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """Runs of strings that may be repeated: id, version, start, the segment's bytes and their digest."""
    lists = shared.groupBy(F.col("id").alias("own")).agg(F.collect_list("key").alias("keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                found = string_keys(data)
                whole = np.arange(len(found)) + LENGTH <= np.repeat(offsets[1:], np.diff(offsets))[: len(found)]
                first, sizes = runs(found, whole)
                row = np.searchsorted(offsets, first, "right") - 1
                lists_ = part.column("keys")
                owners = np.repeat(np.arange(len(part)), np.asarray(pc.list_value_length(lists_)))
                # Keys told apart by row; two alike by chance would only send a segment on in vain.
                wanted = np.sort(of_row(np.asarray(lists_.flatten(), np.int64).view(np.uint64), owners))
                sought = of_row(found[first], row)
                at = np.minimum(np.searchsorted(wanted, sought), len(wanted) - 1)
                keep = wanted[at] == sought
                begin = keep & (np.append(True, ~keep[:-1] | (row[1:] != row[:-1])) | (found[first] >> np.uint64(20) & CUT == 0))
                end = keep & np.append(begin[1:] | ~keep[1:], True)
                starts, ends = first[begin], first[end] + sizes[end] + LENGTH - 1
                raw = data.tobytes()
                texts_ = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts_]
                taken = pa.array(row[begin])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(taken), part.column("version").take(taken), pa.array(starts - offsets[row[begin]]),
                        pa.array(texts_, pa.binary()), pa.array(digests, pa.binary()),
                    ],
                    ["id", "version", "start", "bytes", "digest"],
                )

    def of_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
        return keys + mixed(row.astype(np.uint64) + _SEED)

    return texts.join(lists, "own").mapInArrow(run, "id long, version binary, start long, bytes binary, digest binary")


PIECE = "bucket long, key long, id long, version binary, start long, size int, bytes binary"
PIECE_NAMES = ["bucket", "key", "id", "version", "start", "size", "bytes"]


def byte_slices(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Parts of the data, which may overlap, as an Arrow column."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at])])


def cut(batch: pa.RecordBatch, level: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Segments cut into runs of one key, with the bucket of the key, about CUT_BYTES at a time."""
    data, offsets = text_bytes(batch.column("bytes"))
    keys = string_keys(data, level)
    row = row_of(offsets)[: len(keys)]
    whole = np.arange(len(keys)) + LENGTH <= offsets[1:][row]
    # A run ends with its segment too: the last places of a segment have no string.
    first, sizes = runs(keys, whole)
    if level >= LEVELS:
        first = np.flatnonzero(whole)
        sizes = np.ones(len(first), np.int64)
    own = row[first]
    at = (mixed(keys[first] + np.uint64(level)) % np.uint64(buckets)).astype(np.int64)
    start = np.asarray(batch.column("start"), np.int64)[own] + first - offsets[own]
    # Pieces overlap by LENGTH bytes, so short ones hold many times the bytes of the segments.
    turn = np.cumsum(sizes + LENGTH - 1) // CUT_BYTES
    edges = np.flatnonzero(np.append(True, turn[1:] != turn[:-1])) if len(turn) else []
    for a, b in zip(edges, np.append(edges[1:], len(turn))):
        taken = pa.array(own[a:b])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at[a:b]), pa.array(keys[first[a:b]].view(np.int64)), batch.column("id").take(taken), batch.column("version").take(taken),
                pa.array(start[a:b]), pa.array(sizes[a:b].astype(np.int32)), byte_slices(data, first[a:b], sizes[a:b] + LENGTH - 1),
            ],
            PIECE_NAMES,
        )


def sorted_spans(ids: np.ndarray, sizes: np.ndarray, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece, first place and past the last place of runs of strings that start under a smaller id.

    sizes: strings of each of a bucket's pieces; begins: where its bytes begin in the data.
    """
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    piece = row_of(offsets)
    within = np.arange(offsets[-1]) - offsets[piece]
    places = begins[piece] + within
    order, group = equal_groups(data, places)
    number = np.zeros(len(data), np.int64)
    number[places] = np.arange(len(places))
    string = number[order]
    owner = ids[piece[string]]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    least = np.minimum.reduceat(owner, first)
    bad = np.zeros(len(places), bool)
    bad[string] = least[group] < owner
    begin = bad & (np.append(True, ~bad[:-1]) | (within == 0))
    end = bad & (np.append(~bad[1:], True) | np.append(within[1:] == 0, True))
    return piece[begin], within[begin], within[end] + 1


def to_sort(codes: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces that are repeated as a whole, the other ones by code, and one of each code whose strings are to be sorted.

    codes: one number for equal pieces. They are sorted once, under their smallest id, and only
    if another id has a piece of the same key: equal strings have equal keys.
    """
    order = np.lexsort((ids, codes))
    first = np.flatnonzero(np.append(True, codes[order][1:] != codes[order][:-1]))
    late = ids[order] > np.repeat(ids[order[first]], np.diff(np.append(first, len(order))))
    one = order[first]
    one = one[np.argsort(keys[one], kind="stable")]
    first = np.flatnonzero(np.append(True, keys[one][1:] != keys[one][:-1]))
    several = np.minimum.reduceat(ids[one], first) != np.maximum.reduceat(ids[one], first)
    return order[late], order[~late], np.sort(one[np.repeat(several, np.diff(np.append(first, len(one))))])


def spans(pieces: DataFrame) -> DataFrame:
    """Removed spans from pieces dealt out by bucket; buckets over the limit come back as pieces."""

    def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.concat_batches(held) if len(held) > 1 else held[0]
        codes = np.asarray(whole.column("bytes").dictionary_encode().indices)
        ids, sizes = np.asarray(whole.column("id")), np.asarray(whole.column("size"))
        again, kept, left = to_sort(codes, np.asarray(whole.column("key")), ids)
        piece, low, high = again, np.zeros(len(again), np.int64), sizes[again]
        if len(left):
            data, offsets = text_bytes(whole.column("bytes").take(pa.array(left)))
            at, begin, end = sorted_spans(ids[left], sizes[left], data, offsets[:-1])
            # One id may have a piece several times; what is found of the one that was sorted holds for all of them.
            code = codes[left[at]]
            nth = np.searchsorted(codes[kept], code)
            times = np.searchsorted(codes[kept], code, "right") - nth
            alike = kept[np.repeat(nth - np.cumsum(times) + times, times) + np.arange(times.sum())]
            piece = np.concatenate([piece, alike])
            low, high = (np.concatenate([x, np.repeat(y, times)]) for x, y in ((low, begin), (high, end)))
        at = pa.array(piece)
        start = np.asarray(whole.column("start"))[piece] + low
        return pa.RecordBatch.from_arrays(
            [
                *(whole.column(c).take(at) for c in ("bucket", "key", "id", "version")),
                pa.array(start), pa.array((high - low).astype(np.int32)), pa.nulls(len(piece), pa.binary()),
            ],
            PIECE_NAMES,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size, over = None, [], 0, False
        for batch in batches:
            bucket = np.asarray(batch.column("bucket"))
            edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            for a, b in zip(edges, np.append(edges[1:], len(bucket))):
                part = batch.slice(a, b - a)
                if bucket[a] != at:
                    if held:
                        yield done(held)
                    at, held, size, over = bucket[a], [], 0, False
                size += int(np.asarray(part.column("size")).sum()) + (LENGTH - 1) * len(part)
                over = over or size > BUCKET_LIMIT
                held.append(part)
                if over:
                    yield from held
                    held = []
        if held:
            yield done(held)

    return pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, PIECE)


def removed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keyed texts, and their removed runs of strings: id, version, start and number of strings."""
    texts = keyed(docs)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # As many buckets of keys as keep one at a few MB, and some for every task.
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = 1 << (max(4 * parts, size // KEYS_BYTES) - 1).bit_length()
    found = written(segments(texts, shared_keys(texts, buckets)), "segments")
    # Sent back are those that several have; the others are the only ones of their digest.
    least = found.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
    placed = found.join(least, "digest", "left")
    count = F.length("bytes") - (LENGTH - 1)
    again = placed.where("id > least").select("id", "version", "start", count.cast("long").alias("size"))
    once = written(placed.where("least IS NULL OR id = least").select("id", "version", "start", "bytes"), "segments-once")
    total = once.agg(F.sum(F.length("bytes"))).first()[0] or 0
    result = again
    rows, level = once, 0
    while True:
        # Pieces of one key overlap; those of finer keys do so more.
        buckets = max(1, total * (4 + 2 * level) // BUCKET_BYTES)
        pieces = rows.mapInArrow(
            lambda batches, at=level, n=buckets: (x for b in batches for part in slices(b, "bytes") for x in cut(part, at, n)), PIECE
        )
        if level == LEVELS:
            # Single strings by now, of which very many are equal or lie in one key: an aggregate
            # combines them before it shuffles.
            pieces = written(pieces, "strings")
            least = pieces.groupBy("bytes").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
            again = pieces.join(least, "bytes").where("id > least")
            return texts, result.unionByName(again.select("id", "version", "start", F.col("size").cast("long").alias("size")))
        out = written(spans(pieces), "spans")
        result = result.unionByName(out.where("bytes is null").select("id", "version", "start", F.col("size").cast("long").alias("size")))
        rows = out.where("bytes is not null").select("id", "version", "start", "bytes")
        if rows.limit(1).count() == 0:
            return texts, result
        level += 1


def merged_spans(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes, as first and past the last, covered by runs of `sizes` strings from `starts`."""
    order = np.argsort(starts, kind="stable")
    low, high = starts[order], (starts + sizes)[order] + LENGTH - 1
    reach = np.maximum.accumulate(high)
    first = np.flatnonzero(np.append(True, low[1:] > reach[:-1]))
    return low[first], reach[np.append(first[1:], len(low)) - 1]


def _with_spans(docs: DataFrame, result: DataFrame, columns: list) -> DataFrame:
    # Own names, as the table may have columns of any.
    runs_ = result.groupBy(F.col("id").alias("__id"), F.col("version").alias("__version")).agg(
        F.collect_list("start").alias("__starts"), F.collect_list("size").alias("__sizes")
    )
    id_ = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST))
    version = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    joined = docs.join(runs_, (id_ == F.col("__id")) & (version == F.col("__version")), "left")
    return joined.select(*columns, "__starts", "__sizes")


def _row_spans(batch: pa.RecordBatch, i: int) -> list[tuple[int, int]]:
    starts = batch.column("__starts")[i]
    if not starts.is_valid:
        return []
    low, high = merged_spans(np.asarray(starts.values, np.int64), np.asarray(batch.column("__sizes")[i].values, np.int64))
    return list(zip(low.tolist(), high.tolist()))


def _kept(raw: bytes, cuts: list[tuple[int, int]]) -> bytes:
    return b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(raw)]))


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every document."""
    _, result = removed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, gone, counts, digests, cut_out = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw, cuts = (text or "").encode(), _row_spans(batch, i)
                sizes.append(len(raw))
                gone.append(sum(b - a for a, b in cuts))
                counts.append(len(cuts))
                digests.append(hashlib.sha256(_kept(raw, cuts)).hexdigest())
                cut_out.append([{"start": a, "end": b} for a, b in cuts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (sizes, gone, counts)), pa.array(digests), pa.array(cut_out, span)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    return _with_spans(docs, result, [docs["doc_id"].cast("long").alias("doc_id"), docs["text"]]).mapInArrow(run, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with the bytes removed, in their own columns.

    A character goes if all its bytes do. n_chars, where there is one, is counted anew.
    """
    _, result = removed(docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, text in enumerate(texts):
                if cuts := _row_spans(batch, i):
                    raw = text.encode()
                    whole = []
                    for a, b in cuts:
                        # A character cut by the edge of a span stays.
                        while a < b and raw[a] & 0xC0 == 0x80:
                            a += 1
                        end = b
                        while b < len(raw) and b > a and raw[b] & 0xC0 == 0x80:
                            b -= 1
                        whole.append((a, b if b < len(raw) or end == len(raw) else end))
                    texts[i] = _kept(raw, [(a, b) for a, b in whole if b > a]).decode()
            columns = []
            for name in names:
                column = batch.column(name)
                if name == "text":
                    column = pa.array(texts, column.type)
                elif name == "n_chars":
                    column = pa.array([None if t is None else len(t) for t in texts], column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names)

    return _with_spans(docs, result, [docs[c] for c in names]).mapInArrow(run, docs.schema)
