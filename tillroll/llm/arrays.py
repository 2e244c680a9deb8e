"""Words of texts as numpy arrays.

Texts come in Arrow batches. A batch is taken in slices of about SLICE_BYTES and SLICE_ROWS at
most, so the arrays of a slice stay small whatever the batch holds; one text longer than that is a slice.

A word is a run of ASCII letters, digits and bytes of non-ASCII characters, after lower-casing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 14

_WORD = np.zeros(256, bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; equal stays equal and different stays different."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS = np.multiply.accumulate(np.full(64, _ODD, np.uint64))


def powers(n: int) -> np.ndarray:
    """The first n powers of the odd multiplier, modulo 2**64."""
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate([_POWERS, _POWERS * _POWERS[-1]])
    return _POWERS[:n]


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of texts or byte strings (null: empty), and the n + 1 offsets of its rows."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    if lower:
        column = pc.utf8_lower(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch whose texts have about `limit` bytes, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        before = ends[low] - sizes[low]
        high = max(low + 1, min(low + SLICE_ROWS, int(np.searchsorted(ends, before + limit, "right"))))
        yield batch.slice(low, high - low)
        low = high


class Words(NamedTuple):
    """hashes: one per word; rows: offsets of each row's words; starts, ends: byte ranges in the slice.

    prefixes: for each length asked for, one hash per word of its first so many bytes.
    """

    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    prefixes: list[np.ndarray]


def words(column: pa.Array, prefixes: tuple[int, ...] = ()) -> Words:
    """The words of a column of texts."""
    data, offsets = text_bytes(column, lower=True)
    if not len(data):
        none = np.zeros(0, np.int64)
        empty = np.zeros(0, np.uint64)
        return Words(empty, np.zeros(len(offsets), np.int64), none, none, [empty] * len(prefixes))
    inside = _WORD[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        empty = np.zeros(0, np.uint64)
        return Words(empty, rows, starts, ends, [empty] * len(prefixes))
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    parts = _BYTE[data[inside]] * powers(int(sizes.max()))[place]
    hashes = np.add.reduceat(parts, first)
    shorter = [mixed(np.add.reduceat(np.where(place < n, parts, np.uint64(0)), first) + np.uint64(n)) for n in prefixes]
    return Words(mixed(hashes), rows, starts, ends, shorter)


def shingles(found: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `width` words, and the offsets of each row's.

    A row of fewer words, but one at least, has one shingle of all its words.
    """
    h, rows = found.hashes, found.rows
    counts = np.diff(rows)
    padded = np.concatenate([h, np.zeros(width, np.uint64)])
    position = np.arange(len(h))
    row_end = np.repeat(rows[1:], counts)
    whole = position + width <= row_end
    short = np.repeat(counts < width, counts) & (position == np.repeat(rows[:-1], counts))
    keep = np.flatnonzero(whole | short)
    total = np.zeros(len(keep), np.uint64)
    for k, power in enumerate(powers(width)):
        part = padded[keep + k]
        part[keep + k >= row_end[keep]] = 0
        total += part * power
    return mixed(total), np.concatenate([[0], np.cumsum(np.where(counts >= width, counts - width + 1, counts > 0))])


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each element of a ragged array."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
