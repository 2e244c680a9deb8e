"""Token counts of a byte-level BPE, by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens by the vocabulary's pattern. Pre-tokens not counted before lie in one
ragged numpy array of symbols; in each round every sequence merges all places of its own
lowest-rank pair at once, and sequences without a known pair leave. What survives are the tokens.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); special strings inside a text are
one token each, as the tokenizer's file says; repeated rows are counted each; an empty table gives
an empty result; columns besides id and text are not read. Texts are never cut: a long pre-token
only means more rounds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.arrays import slices

# Fixed value: the pre-token pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 1024
# Pre-tokens remembered by a task; beyond that it forgets them and counts anew.
REMEMBERED = 300_000
NO_PAIR = np.int64(1 << 40)


class Vocabulary(NamedTuple):
    """symbols: id of each byte; pairs: sorted keys of known pairs, with their ranks; merged: id made by each rank."""

    symbols: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    specials: tuple[str, ...]


def byte_names() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + len(names) - len(shown))
    return [names[b] for b in range(256)]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids = content["model"]["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
    keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
    order = np.argsort(keys, kind="stable")
    return Vocabulary(
        np.array([ids[n] for n in byte_names()], np.int64),
        keys[order],
        order.astype(np.int64),
        np.array([ids[a + b] for a, b in merges], np.int64),
        tuple(t["content"] for t in content["added_tokens"]),
    )


def merged_lengths(sequences: list[bytes], v: Vocabulary) -> np.ndarray:
    """How many symbols each non-empty byte sequence has once no pair of it is known."""
    sizes = np.array([len(s) for s in sequences], np.int64)
    result = sizes.copy()
    symbols = v.symbols[np.frombuffer(b"".join(sequences), np.uint8)]
    rows = np.repeat(np.arange(len(sizes)), sizes)
    while len(symbols) > 1:
        keys = symbols[:-1] << 32 | symbols[1:]
        found = np.minimum(np.searchsorted(v.pairs, keys), len(v.pairs) - 1)
        ranks = np.where((v.pairs[found] == keys) & (rows[:-1] == rows[1:]), v.ranks[found], NO_PAIR)
        ranks = np.append(ranks, NO_PAIR)
        starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        lengths = np.diff(np.append(starts, len(rows)))
        lowest = np.minimum.reduceat(ranks, starts)
        result[rows[starts]] = lengths
        lowest = np.repeat(lowest, lengths)
        merge = (ranks == lowest) & (ranks < NO_PAIR)
        # Of places that overlap, as in a run of one symbol, every second merges.
        at = np.flatnonzero(merge)
        if not len(at):
            break
        run = np.append(True, np.diff(at) != 1)
        nth = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        at = at[nth % 2 == 0]
        symbols[at] = v.merged[ranks[at]]
        keep = lowest < NO_PAIR
        keep[at + 1] = False
        symbols, rows = symbols[keep], rows[keep]
    return result


class Counter:
    """Counts tokens of texts and remembers pre-tokens."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}
        self.pieces = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, v.specials))) if v.specials else None

    def count(self, texts: list[str]) -> list[int]:
        parts, extra = [], []
        for text in texts:
            specials = 0
            if self.special is not None and any(s in text for s in self.v.specials):
                specials = len(self.special.findall(text))
                parts.append([p for piece in self.special.split(text) for p in self.pieces(piece)])
            else:
                parts.append(self.pieces(text))
            extra.append(specials)
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set().union(*parts) - self.known.keys())
        if new:
            self.known.update(zip(new, merged_lengths([p.encode() for p in new], self.v).tolist()))
        length = self.known.__getitem__
        return [sum(map(length, p)) + n for p, n in zip(parts, extra)]


def token_counts(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document. The vocabulary's size is that of its file."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                tokens = np.array(counter.count(texts), np.int64)
                sizes = np.array([len(t.encode()) for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
