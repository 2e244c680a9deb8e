"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector is scaled to length 1 and rotated at random. Its code is the sign of every coordinate, one
bit each; stored with it is the correction factor, the inner product of the rotated vector with its
own code (a unit vector of +-1/sqrt(d)). For another vector q, <code, q> / factor is an unbiased
estimate of the cosine, and what it misses by lies across the coded vector alone: at a cosine of t
it is sqrt((1 - factor^2)(1 - t^2)) / factor times a coordinate of a random unit vector in d - 1
dimensions. So a pair whose estimate lies below threshold - SIGMAS standard deviations of that is
refused by its codes; every other pair gets its exact cosine. The side that stands for q is kept as
the rotated vector in four bits a coordinate, rounded with a fixed dither; the rounding widens the bound.
A pair is estimated from both sides and must pass both.

Which pairs are estimated at all: the same kind of rotation deals vectors into cells (the coordinate
of a rotation that is largest, with its sign; `hashes` of them together name a cell), in as many
tables as it takes for a pair at the threshold to share a cell but for a chance of MISS. That chance
is measured for the dimension at hand on simulated pairs, and `hashes` grows with the logarithm of
the number of vectors, so cells keep their size and only the number of tables grows.

Equal vectors are one node with a multiplicity. A cell is cut in blocks of about BLOCK nodes and
every two of its blocks meet in a task of their own, so a cell that holds a third of all vectors is
just more tasks. A pair that shares several cells counts in the first of those tables only. Tasks
give back rows per node, never per pair: first the nodes that have a partner left, whose vectors
are then sent for, then how many links every node has, and one edge per node to the least one it is
reached from. All pairs of a hot group are compared, since the links of each vector are asked for.

Bounds: at a cosine of exactly the threshold a link is missed with a chance of MISS (no shared cell)
plus 2 * 0.00003 (one of two estimates beyond SIGMAS); both fall quickly above it.

Defined cases: vectors that are null, empty, all zero or hold null or non-finite components are
rows of their own without links; vectors of different lengths never link; rows with one id, and rows
without an id, are vectors of their own; a component in which no row has an id has no id, and its
rows are all kept; an empty table gives an empty result; columns besides id and vector are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.graph import components
from tillroll.llm.scratch import written

THRESHOLD = 0.9
SIGMAS = 4.0
MISS = 1e-4
# Coordinates a cell's rotation keeps, nodes wanted in a cell, nodes of a block.
KEPT = 64
CELL = 2048
BLOCK = 2048
MOST_HASHES = 4
ROWS_AT_ONCE = 256


def hashes_for(nodes: int, dim: int) -> int:
    """How many coordinates name a cell, so that cells hold about CELL nodes."""
    cells, k = 2 * min(dim, KEPT), 1
    while k < MOST_HASHES and nodes / cells**k > CELL:
        k += 1
    return k


@lru_cache
def agreement(dim: int, threshold: float) -> float:
    """The chance that two vectors at a cosine of the threshold have the same largest coordinate."""
    rng, n, kept = np.random.default_rng(7), 20_000, min(dim, KEPT)
    wide = min(dim, 4 * KEPT)
    x, z = rng.normal(size=(n, wide)), rng.normal(size=(n, wide))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    size = np.linalg.norm(z, axis=1)[:, None]
    z = np.divide(z, size, out=np.zeros_like(z), where=size > 1e-9)
    y = threshold * x + np.sqrt(1 - threshold**2) * z
    x, y, rows = x[:, :kept], y[:, :kept], np.arange(n)
    i, j = np.abs(x).argmax(1), np.abs(y).argmax(1)
    return float(((i == j) & (x[rows, i] * y[rows, j] > 0)).mean())


def tables_for(dim: int, hashes: int, threshold: float, miss: float = MISS) -> int:
    p = min(agreement(dim, threshold), 1 - 1e-9) ** hashes
    return max(1, int(np.ceil(np.log(miss) / np.log1p(-p))))


class Plan(NamedTuple):
    """The rotation of the codes, those of the cells (tables, hashes, dim, kept), and the rounding's dither."""

    rotation: np.ndarray
    cells: np.ndarray
    dither: np.ndarray


def _rotation(rng: np.random.Generator, dim: int, kept: int) -> np.ndarray:
    q, r = np.linalg.qr(rng.normal(size=(dim, kept)))
    return q * np.sign(np.diag(r))


@lru_cache
def plan(dim: int, hashes: int, threshold: float) -> Plan:
    rng, kept = np.random.default_rng(dim), min(dim, KEPT)
    rotation, dither = _rotation(rng, dim, dim), rng.random(dim)
    cells = [[_rotation(rng, dim, kept) for _ in range(hashes)] for _ in range(tables_for(dim, hashes, threshold))]
    return Plan(rotation, np.array(cells), dither)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first to components of at most 1, so no square overflows."""
    vectors = vectors / np.abs(vectors).max(1)[:, None]
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def coded(vectors: np.ndarray, made: Plan) -> list[bytes]:
    """Sign bits, four bits a coordinate, and factor, least value and step, of each row of unit vectors."""
    turned = vectors @ made.rotation
    n, dim = turned.shape
    factor = np.abs(turned).sum(1) / np.sqrt(dim)
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / 15, 1e-12)
    quarter = np.clip(np.floor((turned - low[:, None]) / step[:, None] + made.dither), 0, 15).astype(np.uint8)
    if dim % 2:
        quarter = np.concatenate([quarter, np.zeros((n, 1), np.uint8)], axis=1)
    numbers = np.stack([factor, low, step], axis=1).astype(np.float32)
    packed = np.concatenate([np.packbits(turned > 0, axis=1), quarter[:, ::2] << 4 | quarter[:, 1::2], numbers.view(np.uint8)], axis=1)
    return [row.tobytes() for row in packed]


def celled(vectors: np.ndarray, made: Plan) -> np.ndarray:
    """The cell of every row in every table."""
    kept = made.cells.shape[3]
    result = np.zeros((len(vectors), len(made.cells)), np.int64)
    for t, rotations in enumerate(made.cells):
        for rotation in rotations:
            turned = vectors @ rotation
            at = np.abs(turned).argmax(1)
            result[:, t] = result[:, t] * (2 * kept) + 2 * at + (turned[np.arange(len(turned)), at] > 0)
    return result


class Codes(NamedTuple):
    signs: np.ndarray
    rotated: np.ndarray
    factor: np.ndarray
    step: np.ndarray


def decoded(payload: list[bytes], dim: int) -> Codes:
    data = np.frombuffer(b"".join(payload), np.uint8).reshape(len(payload), -1)
    bits, half = -(-dim // 8), -(-dim // 2)
    signs = (np.unpackbits(data[:, :bits], axis=1)[:, :dim].astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
    pairs = data[:, bits : bits + half]
    numbers = np.ascontiguousarray(data[:, bits + half :]).view(np.float32)
    rotated = np.stack([pairs >> 4, pairs & 15], axis=2).reshape(len(data), -1)[:, :dim] * numbers[:, 2:] + numbers[:, 1:2]
    return Codes(signs, rotated.astype(np.float32), numbers[:, 0], numbers[:, 2])


def least_estimate(coded_side: Codes, step: float, threshold: float, dim: int) -> np.ndarray:
    """Below this estimate a pair at the threshold falls once in 30,000 times."""
    f = coded_side.factor
    across = min(SIGMAS / np.sqrt(max(dim - 1, 1)), 1.0) * np.sqrt(np.maximum(1 - f * f, 0) * (1 - threshold**2)) / f
    return (threshold - np.sqrt(across**2 + (SIGMAS * step / 2 / f) ** 2) - 1e-5).astype(np.float32)


def later(keys: np.ndarray, others: np.ndarray, table: int) -> np.ndarray:
    """Whether each pair of rows shares no cell of an earlier table."""
    return ~(keys[:, :table] == others[:, :table]).any(1)


def left_over(a: Codes, b: Codes, keys: tuple[np.ndarray, np.ndarray], same: bool, table: int, threshold: float, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes of either side have a partner that the codes do not refuse and no earlier table has."""
    from_a, from_b = least_estimate(a, float(b.step.max()), threshold, dim), least_estimate(b, float(a.step.max()), threshold, dim)
    wanted = np.zeros(len(a.factor), bool), np.zeros(len(b.factor), bool)
    for first in range(0, len(a.factor), ROWS_AT_ONCE):
        rows = slice(first, first + ROWS_AT_ONCE)
        good = a.signs[rows] @ b.rotated.T >= (from_a * a.factor)[rows, None]
        good &= a.rotated[rows] @ b.signs.T >= (from_b * b.factor)[None, :]
        i, j = np.nonzero(good)
        i += first
        open_ = ~(wanted[0][i] & wanted[1][j])
        if same:
            open_ &= i < j
        i, j = i[open_], j[open_]
        new = later(keys[0][i], keys[1][j], table)
        for side, at in zip(wanted, (i[new], j[new])):
            side[at] = True
    if same:
        both = wanted[0] | wanted[1]
        return both, both
    return wanted


def exact_links(
    a: np.ndarray, b: np.ndarray, keys: tuple[np.ndarray, np.ndarray], same: bool, table: int, threshold: float
) -> np.ndarray:
    """Which pairs of unit vectors have a cosine of the threshold at least, those of earlier tables left out."""
    result = np.zeros((len(a), len(b)), bool)
    for first in range(0, len(a), ROWS_AT_ONCE):
        rows = slice(first, first + ROWS_AT_ONCE)
        i, j = np.nonzero(a[rows] @ b.T >= threshold - 1e-9)
        i += first
        if same:
            i, j = i[i < j], j[i < j]
        # A product of matrices depends on a row's place in the last bits; the cosine does not.
        good = later(keys[0][i], keys[1][j], table)
        i, j = i[good], j[good]
        for low in range(0, len(i), 1 << 14):
            part = slice(low, low + (1 << 14))
            result[i[part], j[part]] = (a[i[part]] * b[j[part]]).sum(1) >= threshold
    return result


def stars(linked: np.ndarray) -> list[tuple[int, int]]:
    """(first, member) of each connected class of a symmetric matrix, for every other member."""
    open_, found = linked.any(1), []
    while open_.any():
        first = int(open_.argmax())
        front = np.zeros(len(linked), bool)
        front[first] = True
        open_[first] = False
        while True:
            reached = linked[front].any(0) & open_
            if not reached.any():
                break
            open_ &= ~reached
            found += [(first, int(m)) for m in np.flatnonzero(reached)]
            front = reached
    return found


def vectors_of(vectors: DataFrame) -> DataFrame:
    """vec_id, node (digest of the components) and vector (bytes of doubles), both null where it takes no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            offsets = np.asarray(column.offsets)
            values = np.asarray(column.values.fill_null(float("nan")), float) + 0.0
            good = np.asarray(column.is_valid())
            nodes, data = [None] * len(batch), [None] * len(batch)
            for i in np.flatnonzero(good).tolist():
                v = values[offsets[i] : offsets[i + 1]]
                if len(v) and np.isfinite(v).all() and v.any():
                    data[i] = v.tobytes()
                    nodes[i] = hashlib.blake2b(data[i], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(nodes, pa.binary()), pa.array(data, pa.binary())], ["vec_id", "node", "vector"])

    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return chosen.mapInArrow(run, "vec_id long, node binary, vector binary")


def codes_of(nodes: DataFrame, count: int, threshold: float) -> DataFrame:
    """node, dim, payload (its code), keys (its cell in every table as 32-bit numbers) and cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("vector").to_pylist()
            sizes = np.array([len(d) // 8 for d in data], np.int64)
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                points = units(np.frombuffer(b"".join(data[i] for i in rows)).reshape(len(rows), dim))
                made = plan(dim, hashes_for(count, dim), threshold)
                cells = celled(points, made).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").take(pa.array(rows)), pa.array([dim] * len(rows), pa.int32()), pa.array(coded(points, made), pa.binary()),
                        pa.array([c.tobytes() for c in cells], pa.binary()), pa.array(list(cells), pa.list_(pa.int32())),
                    ],
                    ["node", "dim", "payload", "keys", "cells"],
                )

    return nodes.select("node", "vector").mapInArrow(run, "node binary, dim int, payload binary, keys binary, cells array<int>")


PLACE = ["dim", "at", "cell", "one", "two"]


def _sides(batch: pa.RecordBatch, k: int) -> tuple[pa.StructArray, list[np.ndarray], bool]:
    """The members of a row's meeting, which of them are on either side, and whether it is a block with itself."""
    members = batch.column("members")[k].values
    own = np.asarray(members.field("own"))
    one, two = batch.column("one")[k].as_py(), batch.column("two")[k].as_py()
    return members, [np.flatnonzero(own == side) for side in (one, two)], one == two


def _keys(members: pa.StructArray, rows: np.ndarray) -> np.ndarray:
    keys = members.field("keys").take(pa.array(rows)).to_pylist()
    return np.frombuffer(b"".join(keys), np.int32).reshape(len(rows), -1)


def open_nodes(codes: DataFrame, threshold: float) -> DataFrame:
    """Of every meeting of two blocks of a cell, the nodes that have a partner left to check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                members, rows, same = _sides(batch, k)
                if not all(map(len, rows)):
                    continue
                dim, table = batch.column("dim")[k].as_py(), batch.column("at")[k].as_py()
                sides = [decoded(members.field("payload").take(pa.array(r)).to_pylist(), dim) for r in rows]
                wanted = left_over(*sides, tuple(_keys(members, r) for r in rows), same, table, threshold, dim)
                keep = np.concatenate([rows[0][wanted[0]]] + ([] if same else [rows[1][wanted[1]]]))
                if len(keep):
                    taken = members.take(pa.array(keep))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(c)[k].as_py()] * len(keep), pa.int32()) for c in PLACE]
                        + [taken.field(c) for c in ("own", "node", "keys")],
                        [*PLACE, "own", "node", "keys"],
                    )

    placed = codes.select("dim", "node", "payload", "keys", F.posexplode("cells").alias("at", "cell"))
    cell = ["dim", "at", "cell"]
    sizes = placed.groupBy(*cell).agg(F.count("*").alias("n")).where("n > 1").select(*cell, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    meetings = (
        placed.join(sizes, cell)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        # Every two blocks of a cell meet.
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy(*cell, F.least("own", "with").alias("one"), F.greatest("own", "with").alias("two"))
        .agg(F.collect_list(F.struct("own", "node", "payload", "keys")).alias("members"))
    )
    return meetings.mapInArrow(run, ", ".join(f"{c} int" for c in (*PLACE, "own")) + ", node binary, keys binary")


def links_of(left: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, null, n): n links of node a, to be summed; (a, b, null): both are of one component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n = [], [], []
            for k in range(len(batch)):
                members, rows, same = _sides(batch, k)
                if not all(map(len, rows)):
                    continue
                table = batch.column("at")[k].as_py()
                times, names = np.asarray(members.field("n")), members.field("node").to_pylist()
                points = [units(np.frombuffer(b"".join(members.field("vector").take(pa.array(r)).to_pylist())).reshape(len(r), -1)) for r in rows]
                found = exact_links(*points, tuple(_keys(members, r) for r in rows), same, table, threshold)
                linked = np.zeros((len(names), len(names)), bool)
                linked[np.ix_(*rows)] = found
                linked |= linked.T
                for i in np.flatnonzero(linked.any(1)).tolist():
                    a.append(names[i])
                    b.append(None)
                    n.append(int(times[linked[i]].sum()))
                for i, j in stars(linked):
                    a.append(names[i])
                    b.append(names[j])
                    n.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], ["a", "b", "n"])

    meetings = (
        left.join(nodes.select("node", "vector", "n"), "node")
        .groupBy(*PLACE)
        .agg(F.collect_list(F.struct("own", "node", "keys", "vector", "n")).alias("members"))
    )
    return meetings.mapInArrow(run, "a binary, b binary, n long")


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = written(vectors_of(vectors), "vectors")
    nodes = written(
        rows.where("node is not null").groupBy("node").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")),
        "nodes",
    )
    codes = written(codes_of(nodes, nodes.count(), threshold), "codes")
    left = written(open_nodes(codes, threshold), "open")
    links = written(links_of(left, nodes, threshold), "links")
    counts = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    classes = components(links.where("b is not null").select("a", "b"))
    own = (
        nodes.select("node", "n", "least").join(counts, "node", "left").join(classes, "node", "left")
        .select("node", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    ids = own.groupBy("component").agg(F.min("least").alias("component_id"))
    known = own.join(ids, "component").select("node", "n_links", "component_id", F.lit(True).alias("part"))
    result = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("part"), F.col("component_id")).otherwise(F.col("vec_id"))
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")
    )
