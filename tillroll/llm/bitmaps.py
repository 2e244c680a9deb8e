"""A set of 64-bit hashes as a bitmap of fixed size, probed twice: it lets through every member and few others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# 2 MB, whatever the set's size; a set that fills it only lets more through.
FILTER_BITS = 1 << 24
PART_BYTES = 1 << 16


def bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of a table with one column of longs. Tasks fill bitmaps of their own; its parts, joined, reach the driver packed."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            found = np.asarray(batch.column(0).drop_null(), np.int64).view(np.uint64)
            for shift in (0, 32):
                bit = found >> np.uint64(shift) & np.uint64(FILTER_BITS - 1)
                np.bitwise_or.at(own, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        parts = own.reshape(-1, PART_BYTES)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[i].tobytes() for i in used], pa.binary())], ["part", "bits"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, bits in zip(batch.column("part").to_pylist(), batch.column("bits").to_pylist()):
                own = np.frombuffer(bits, np.uint8)
                sums[part] = sums[part] | own if part in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "bits"])

    schema = "part int, bits binary"
    result = np.zeros((FILTER_BITS // 8 // PART_BYTES, PART_BYTES), np.uint8)
    for row in hashes.mapInArrow(fill, schema).repartition("part").mapInArrow(join, schema).collect():
        result[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return result.ravel()


def let_through(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Indices of the hashes that may be in the set."""
    keep = np.arange(len(hashes))
    for shift in (0, 32):
        bit = hashes[keep] >> np.uint64(shift) & np.uint64(FILTER_BITS - 1)
        keep = keep[np.flatnonzero(table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)]
    return keep
