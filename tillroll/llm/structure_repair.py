"""Repair of conversation structure by generalised LR parsing with edits.

The roles of a conversation form a sentence over their initials: an optional system turn, then pairs
of a user and an assistant turn, or nothing at all. The grammar, left-recursive so that stacks stay short:

    C -> (nothing) | T | s T        T -> u a | T u a

Every turn is kept (0, and TRUNCATED more where its text breaks off), reroled to user or assistant (REROLE,
and as much more), or deleted (DELETE, the only edit of blank and repeated turns); empty user or
assistant turns may be inserted anywhere (INSERT). The parser holds all stacks at once as a graph: a stack
is a state and the stack below, which many share. Stacks with equal tops are merged; the one of the least
(cost, audit) stays, where the audit is the edits' initials so far (D, I, K, R).

Two audits that both end with a turn's own edit never start with one another, so the order of
the audits is kept as a rank among the stacks at hand, and no audit is built before the end. A stack that costs
over SPREAD more than the cheapest cannot win, since any stack does what another could for that much more (an insertion
and a deletion). So there are few sets of stacks, and what a turn makes of one is looked up after it
was worked out once.

Codes of a conversation's turns, a byte each, stream through one task, as the audit is one value;
texts are never gathered: faults are found by aggregates over range-sorted turns, edits come back as
one row per turn, and the repaired text is hashed as its pieces stream by.

Defined cases: turns are ordered by turn (null first), then role and digest of role and text; null
roles and texts are one space; rows without a conv_id are one conversation; repeated rows are
duplicates; an empty role, like any whose initial is not s, u or a, must be reroled or deleted; a
conversation without turns has no edits; an empty table gives an empty result; columns besides
conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPREAD = INSERT + DELETE
# Codes of a turn: its initial, then 4 more if truncated, 8 more if it must go.
INITIALS = "sua"
OTHER, BROKEN, GONE = 3, 4, 8
NAMES = {"u": "user", "a": "assistant"}
LEGAL_NEIGHBOURS = {(0, 1), (1, 2), (2, 1)}

# The LR automaton of the grammar: states after shifts and after T, and how many symbols make a T.
SHIFT = {(0, "s"): 2, (0, "u"): 3, (2, "u"): 3, (3, "a"): 6, (4, "u"): 7, (5, "u"): 7, (7, "a"): 8}
MAKES_T = {6: 2, 8: 3}
AFTER_T = {0: 4, 2: 5}
ACCEPTS = {0, 4, 5}
BOTTOM = (0, None)


def shifted(stack: tuple, symbol: str) -> tuple | None:
    """The stack after a symbol and the reductions it completes, None if the symbol is not legal."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in MAKES_T:
        for _ in range(MAKES_T[stack[0]]):
            stack = stack[1]
        stack = (AFTER_T[stack[0]], stack)
    return stack


class Repairer:
    """Cheapest edits of conversations given as codes; what it worked out is kept for the next ones.

    A frontier is a tuple of heads (stack, cost above the cheapest, rank of the audit).
    """

    def __init__(self) -> None:
        self.steps: dict[tuple, tuple] = {}
        self.ends: dict[tuple, tuple] = {}

    @staticmethod
    def with_insertions(frontier: tuple) -> list[tuple]:
        """(cost, (rank, letters), stack, head) of the best stack of every top, empty turns inserted."""
        best = {stack[0]: (cost, (rank, ""), stack, k) for k, (stack, cost, rank) in enumerate(frontier)}
        open_ = list(best.values())
        while open_:
            cost, (rank, letters), stack, k = open_.pop()
            for symbol in NAMES:
                to = shifted(stack, symbol)
                if to is not None:
                    found = (cost + INSERT, (rank, letters + "I"), to, k)
                    if to[0] not in best or found[:2] < best[to[0]][:2]:
                        best[to[0]] = found
                        open_.append(found)
        return list(best.values())

    def step(self, frontier: tuple, code: int) -> tuple:
        """The frontier after a turn, what the cheapest head costs more, and (head before, letters) of every head."""
        best: dict[int, tuple] = {}
        more = TRUNCATED if code & BROKEN else 0
        for cost, (rank, letters), stack, k in self.with_insertions(frontier):
            ways = [("D", DELETE, stack)]
            if not code & GONE:
                if code & 3 != OTHER:
                    ways.append(("K", more, shifted(stack, INITIALS[code & 3])))
                ways += [("R", REROLE + more, shifted(stack, symbol)) for symbol in NAMES]
            for letter, price, to in ways:
                if to is not None:
                    found = (cost + price, (rank, letters + letter), to, k)
                    if to[0] not in best or found[:2] < best[to[0]][:2]:
                        best[to[0]] = found
        least = min(found[0] for found in best.values())
        heads = sorted((f for f in best.values() if f[0] <= least + SPREAD), key=lambda f: f[2][0])
        ranks = {audit: r for r, audit in enumerate(sorted({f[1] for f in heads}))}
        return tuple((f[2], f[0] - least, ranks[f[1]]) for f in heads), least, tuple((f[3], f[1][1]) for f in heads)

    def end(self, frontier: tuple) -> tuple[int, int, str]:
        """What ending costs more, the head it comes from, and the letters of empty turns at the end."""
        cost, (_, letters), _, k = min(f for f in self.with_insertions(frontier) if f[2][0] in ACCEPTS)
        return cost, k, letters

    def edits(self, codes: bytes) -> tuple[int, list[str], str]:
        """The least cost, the letters of every turn (insertions before it, then its own edit), and those at the end."""
        frontier, total, back = ((BOTTOM, 0, 0),), 0, []
        for code in codes:
            key = frontier, code
            if key not in self.steps:
                self.steps[key] = self.step(frontier, code)
            frontier, least, came = self.steps[key]
            total += least
            back.append(came)
        if frontier not in self.ends:
            self.ends[frontier] = self.end(frontier)
        cost, k, last = self.ends[frontier]
        letters = [""] * len(codes)
        for i in range(len(codes) - 1, -1, -1):
            k, letters[i] = back[i][k]
        return total + cost, letters, last


def inserted(stack: tuple, count: int) -> tuple[tuple, list[str]]:
    """The stack after so many empty turns, and their roles: in every state one of the two is legal."""
    roles = []
    for _ in range(count):
        symbol = next(s for s in NAMES if (stack[0], s) in SHIFT)
        roles.append(NAMES[symbol])
        stack = shifted(stack, symbol)
    return stack, roles


def replayed(codes: bytes, letters: list[str], last: str) -> tuple[list[str | None], list[list[str]], list[str]]:
    """New roles of reroled turns, roles of the empty turns before each turn, and those at the end."""
    stack, roles, before = BOTTOM, [], []
    for code, own in zip(codes, letters):
        stack, put_in = inserted(stack, len(own) - 1)
        role = None
        if own[-1] == "K":
            stack = shifted(stack, INITIALS[code & 3])
        elif own[-1] == "R":
            stack, (role,) = inserted(stack, 1)
        roles.append(role)
        before.append(put_in)
    return roles, before, inserted(stack, len(last))[1]


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults made by a hash of their place: dropped, emptied, without sentence ends, repeated, said by the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    draw = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("draw"))
        .where("draw != 0")
        .select(
            "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, place, turn, role, text, and blank, duplicate and truncated, of which at most one is true; written."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    chosen = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    chosen = chosen.withColumn("digest", F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text"))))
    order = ["conv_id", "turn", "role", "digest"]
    rows = written(chosen.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "turns")
    firsts = rows.groupBy("conv_id", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    again = F.col("first").isNull()
    ends = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    marked = rows.join(firsts, "place", "left").select(
        "conv_id", "place", "turn", "role", "text", blank.alias("blank"), (~blank & again).alias("duplicate"), (~blank & ~again & ~ends).alias("truncated")
    )
    return written(marked, "faults")


def code() -> Column:
    """A turn's code."""
    initial = F.substring("role", 1, 1)
    symbol = F.lit(OTHER)
    for k, letter in enumerate(INITIALS):
        symbol = F.when(initial == letter, k).otherwise(symbol)
    return symbol + F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), BROKEN).otherwise(0)


def edits(rows: DataFrame) -> DataFrame:
    """Per turn: place, edit, new_role, and the roles of empty turns before and after it; per conversation (no place): cost, audit and illegal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer()
        names = ["conv_id", "place", "edit", "new_role", "before", "after", "cost", "audit", "illegal"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.int64()]

        def done(conv_id: int | None, codes: bytearray, places: list[int]) -> list[tuple]:
            cost, letters, last = repairer.edits(bytes(codes))
            roles, before, after = replayed(codes, letters, last)
            found = [(conv_id, p, x[-1], r, b, [], None, None, None) for p, x, r, b in zip(places, letters, roles, before)]
            found[-1] = (*found[-1][:5], after, None, None, None)
            initials = [c & 3 for c in codes]
            illegal = sum(pair not in LEGAL_NEIGHBOURS for pair in zip(initials, initials[1:]))
            return found + [(conv_id, None, None, None, None, None, cost, "".join(letters) + last, illegal)]

        def table(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

        now, codes, places, found = None, bytearray(), [], []
        for batch in batches:
            for conv_id, place, c in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "place", "code"))):
                if codes and conv_id != now:
                    found += done(now, codes, places)
                    codes, places = bytearray(), []
                now = conv_id
                codes.append(c)
                places.append(place)
            for first in range(0, len(found), 4000):
                yield table(found[first : first + 4000])
            found = []
        if codes:
            found = done(now, codes, places)
            for first in range(0, len(found), 4000):
                yield table(found[first : first + 4000])

    order = ["conv_id", "place"]
    coded = rows.select(*order, code().alias("code")).repartition("conv_id").sortWithinPartitions(*order)
    schema = (
        "conv_id long, place long, edit string, new_role string, before array<string>, after array<string>, "
        "cost long, audit string, illegal long"
    )
    return written(coded.mapInArrow(run, schema), "edits")


def repaired(rows: DataFrame, made: DataFrame) -> DataFrame:
    """conv_id, place and piece: what is left of each turn, and the empty turns beside it, as `role:text` in lines."""
    joined = rows.select("conv_id", "place", "role", "text").join(made.where("place is not null").drop("conv_id", "cost", "audit", "illegal"), "place")
    own = F.when(F.col("edit") != "D", F.concat(F.coalesce("new_role", "role"), F.lit(":"), F.col("text")))
    empty = [F.transform(c, lambda r: F.concat(r, F.lit(":"))) for c in ("before", "after")]
    lines = F.concat(empty[0], F.when(own.isNotNull(), F.array(own)).otherwise(F.array().cast("array<string>")), empty[1])
    return joined.select("conv_id", "place", lines.alias("lines")).where("size(lines) > 0").select("conv_id", "place", F.array_join("lines", "\n").alias("piece"))


def hashed(pieces: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of a conversation's pieces, joined by newlines in order of place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done, found = [], []
            for conv_id, piece in zip(batch.column("conv_id").to_pylist(), batch.column("piece").to_pylist()):
                if state is None or conv_id != now:
                    if state is not None:
                        done.append(now)
                        found.append(state.hexdigest())
                    now, state = conv_id, hashlib.sha256(piece.encode())
                else:
                    state.update(b"\n")
                    state.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64()), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, "conv_id long, repaired_sha256 string")


def structure_report(turns: DataFrame, everyone: DataFrame | None = None) -> DataFrame:
    """One row per conversation: its faults, the least cost of repair, the edits, and a digest of the repaired text.

    everyone: a table whose conv_ids all get a row, also without turns; by default that of the turns.
    """
    rows = faults(turns)
    made = edits(rows)
    zero = F.lit(0).cast("long")
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), zero).alias("gaps"),
        *(F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")),
    )
    # Groups hold null ids together, which a join would not.
    parts = [
        (turns if everyone is None else everyone).select(F.col("conv_id").cast("long").alias("conv_id")).distinct(),
        counts,
        made.where("place is null").select("conv_id", "illegal", "cost", "audit"),
        hashed(repaired(rows, made)),
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = F.sha2(F.lit("").cast("binary"), 256)
    return both.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), zero).alias(c) for c in numbers),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), none).alias("repaired_sha256"),
    )
