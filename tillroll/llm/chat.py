"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn followed by user and assistant turns in
turn, starting with a user and ending with an assistant. The states of the automaton are the role of
the last turn so far. Dynamic programming finds the cheapest way to make a conversation legal:

- a turn may keep its role (0) or be relabelled (RELABEL, or UNKNOWN where its role is none of the three),
- it may begin a turn, or be merged into the one before (MERGE) under that one's role,
- empty turns may be inserted before it or at the end (INSERT each).

Ties are settled by the least cost of what follows, then in this order: merge, then a new turn of
the role system, user, assistant.

The step from one turn to the next is a matrix of costs between states, and matrices combine in any
grouping (least sums), so a conversation of any length is repaired in parts: turns are range-sorted
and stored with their place; every part reduces its stretch of a conversation to one matrix; a
pass over two matrices per part fixes the states at the parts' edges; then each part traces its own
way back. Only those matrices, two for a part, reach the driver. A part is laid out in its task, so
parts are made by the bytes and rows at hand (PART_BYTES, PART_ROWS), and equal rows, which no order
tells apart, are spread over parts too; one text longer than PART_BYTES makes a longer part.

Defined cases: turns are ordered by turn, role and text, nulls last; a null conversation id is one
conversation; null, unknown and differently spelled roles are read by ROLES, others are unknown;
null texts are empty; repeated rows are turns of their own; an empty table gives an empty result;
columns besides conv_id, turn, role and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written

ROLES = {
    "system": 0, "developer": 0, "user": 1, "human": 1, "customer": 1, "prompter": 1,
    "assistant": 2, "bot": 2, "ai": 2, "model": 2, "gpt": 2, "agent": 2,
}
NAMES = ("system", "user", "assistant")
STATES = 4  # the role of the last turn; 3: no turn yet
NONE = 3
RELABEL, UNKNOWN, MERGE, INSERT = 2.0, 1.0, 1.0, 3.0
FAR = 1e18
PART_BYTES = 64 << 20
PART_ROWS = 1 << 19
HEAD, TAIL, JOINT = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"
# What may follow what, and the empty turns that lead from one role to another in between.
FOLLOWS = {NONE: (0, 1), 0: (1,), 1: (2,), 2: (1,)}


def _ways() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest row of empty turns after a state so that a role may follow it."""
    found: dict[tuple[int, int], tuple[int, ...]] = {}
    for state in range(STATES):
        reach, front = {r: () for r in FOLLOWS[state]}, [((), state)]
        while front:
            path, last = front.pop(0)
            for role in FOLLOWS[last]:
                if len(path) < STATES and (role not in reach or len(path) <= len(reach[role])):
                    if role not in reach or len(path) < len(reach[role]):
                        reach[role] = path
                    if len(path) + 1 < STATES:
                        front.append((path + (role,), role))
        found.update({(state, role): path for role, path in reach.items()})
    return found


WAYS = _ways()


class Step(NamedTuple):
    """Least cost of each pair of states before and after a turn, and whether the turn is merged."""

    cost: np.ndarray
    merged: np.ndarray


def _step(role: int) -> Step:
    """The step of a turn with that role; 3: unknown."""
    cost, merged = np.full((STATES, STATES), FAR), np.zeros((STATES, STATES), bool)
    for new in range(3):
        relabel = 0.0 if new == role else UNKNOWN if role == NONE else RELABEL
        for state in range(STATES):
            if (state, new) in WAYS:
                cost[state, new] = relabel + INSERT * len(WAYS[state, new])
        if relabel + MERGE <= cost[new, new]:
            cost[new, new], merged[new, new] = relabel + MERGE, True
    return Step(cost, merged)


STEPS = [_step(r) for r in range(4)]
# To end: after an assistant, or after no turn at all.
END_WAYS = {NONE: (), 0: (1, 2), 1: (2,), 2: ()}
END = np.array([INSERT * len(END_WAYS[s]) for s in range(STATES)])


def role_codes(column: pa.Array) -> np.ndarray:
    return np.array([ROLES.get((r or "").strip().lower(), NONE) for r in column.to_pylist()], np.int64)


def combined(roles: np.ndarray) -> np.ndarray:
    """The matrix of a stretch of turns."""
    total = np.where(np.eye(STATES, dtype=bool), 0.0, FAR)
    for role in roles:
        total = np.minimum((total[:, :, None] + STEPS[role].cost[None, :, :]).min(1), FAR)
    return total


def traced(roles: np.ndarray, before: int, after: int | None) -> np.ndarray:
    """The states after each turn of a stretch on a cheapest way; `after` is the last one, None: that from which ending is cheapest."""
    n = len(roles)
    rest = np.empty((n + 1, STATES))
    rest[n] = END if after is None else np.where(np.arange(STATES) == after, 0.0, FAR)
    for t in range(n - 1, -1, -1):
        rest[t] = np.minimum((STEPS[roles[t]].cost + rest[t + 1][None, :]).min(1), FAR)
    states, state = np.empty(n, np.int64), before
    for t in range(n):
        step = STEPS[roles[t]]
        options = step.cost[state] + rest[t + 1]
        best = np.flatnonzero(options <= options.min() + 1e-9)
        merged = [s for s in best if step.merged[state, s]]
        state = int(merged[0] if merged else best[0])
        states[t] = state
    return states


def edges(parts: list[tuple[int, object, bool, bool, np.ndarray]]) -> dict[tuple[int, bool], tuple[int, int | None]]:
    """States before and after the stretches of conversations that cross parts.

    parts: in order, (part, conversation, begins here, ends here, matrix) of every stretch that does
    not both begin and end in its part. The key of the result tells a part's last stretch from its first.
    """
    result, chain = {}, []
    for part, conversation, begins, ends, matrix in parts:
        if begins:
            chain = []
        chain.append((part, begins, matrix))
        if not ends:
            continue
        rest = [END]
        for _, _, m in reversed(chain):
            rest.append(np.minimum((m + rest[-1][None, :]).min(1), FAR))
        rest.reverse()
        state = NONE
        for k, (at, first, m) in enumerate(chain):
            after = int(np.argmin(m[state] + rest[k + 1]))
            result[at, first] = (state, None if k == len(chain) - 1 else after)
            state = after
    return result


def repaired(turns: DataFrame) -> DataFrame:
    """One row per turn: its place, old and new role, what was done, and its piece of the rendered conversation.

    The pieces of a conversation, joined by place, are the whole of it.
    """
    spark = turns.sparkSession
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text")]
    chosen = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    size = chosen.agg(F.count("*").alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes")).first()
    parts = max(-(-size["n"] // PART_ROWS), -(-(size["bytes"] or 0) // PART_BYTES), spark.sparkContext.defaultParallelism)
    # The place numbers rows by part and order within it; stored, so that every pass sees the same cut.
    spread = chosen.withColumn("spread", F.rand(1))
    order.append(F.col("spread").asc())
    placed = written(
        spread.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("spread").withColumn("place", F.monotonically_increasing_id()),
        "turns",
    )
    placed = placed.withColumn("part", F.shiftright("place", 33).cast("int"))
    # Whether a conversation goes on in other parts: at most two of a part do, found from the parts' edges.
    ends = placed.groupBy("part").agg(
        F.min_by("conv_id", "place").alias("first"), F.max_by("conv_id", "place").alias("last"), F.count("*").alias("n")
    ).orderBy("part").collect()
    goes_on = {a["part"]: a["last"] == b["first"] for a, b in zip(ends, ends[1:])}
    came_in = {b["part"]: a["last"] == b["first"] for a, b in zip(ends, ends[1:])}
    cuts = spark.sparkContext.broadcast((goes_on, came_in))

    def stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bool, bool]]:
        """First and past the last row of each conversation, and whether it begins and ends in this part."""
        on, came = cuts.value
        part = batch.column("part")[0].as_py()
        ids = np.asarray(batch.column("conv_id").fill_null(0))
        null = np.asarray(batch.column("conv_id").is_null())
        first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])))
        for k, (a, b) in enumerate(zip(first, np.append(first[1:], len(ids)))):
            yield a, b, not (k == 0 and came.get(part, False)), not (b == len(ids) and on.get(part, False))

    def whole(table: pa.Table) -> pa.RecordBatch:
        return table.sort_by("place").combine_chunks().to_batches()[0]

    def reduce(table: pa.Table) -> pa.Table:
        batch = whole(table)
        roles = role_codes(batch.column("role"))
        found = [(b_, e_, combined(roles[a:b])) for a, b, b_, e_ in stretches(batch) if not (b_ and e_)]
        part = batch.column("part")[0].as_py()
        return pa.table(
            {
                "part": pa.array([part] * len(found), pa.int32()),
                "begins": pa.array([x[0] for x in found], pa.bool_()),
                "ends": pa.array([x[1] for x in found], pa.bool_()),
                "matrix": pa.array([x[2].tobytes() for x in found], pa.binary()),
            }
        )

    crossing = sorted({p for p, on in goes_on.items() if on} | {p for p, on in came_in.items() if on})
    fixed = {}
    if crossing:
        rows = (
            placed.where(F.col("part").isin(crossing))
            .groupBy("part")
            .applyInArrow(reduce, "part int, begins boolean, ends boolean, matrix binary")
            .collect()
        )
        rows.sort(key=lambda r: (r["part"], r["begins"]))
        fixed = edges([(r["part"], None, r["begins"], r["ends"], np.frombuffer(r["matrix"]).reshape(STATES, STATES)) for r in rows])
    states = spark.sparkContext.broadcast(fixed)

    def render(table: pa.Table) -> pa.Table:
        batch = whole(table)
        part = batch.column("part")[0].as_py()
        roles = role_codes(batch.column("role"))
        texts = batch.column("text").to_pylist()
        out = {"new_role": [], "action": [], "inserted": [], "cost": [], "piece": []}
        for a, b, begins, ends in stretches(batch):
            before, after = (NONE, None) if begins and ends else states.value[part, begins]
            way = traced(roles[a:b], before, after)
            for t in range(a, b):
                role, new = int(roles[t]), int(way[t - a])
                step = STEPS[role]
                merged = bool(step.merged[before, new])
                put_in = () if merged else WAYS[before, new]
                last = t == b - 1 and ends
                closing = END_WAYS[new] if last else ()
                piece = JOINT if merged else (TAIL if before != NONE else "") + "".join(HEAD.format(NAMES[r]) + TAIL for r in put_in) + HEAD.format(NAMES[new])
                piece += texts[t] or ""
                if last:
                    piece += TAIL + "".join(HEAD.format(NAMES[r]) + TAIL for r in closing)
                out["new_role"].append(NAMES[new])
                out["action"].append("+".join(x for x, y in (("merge", merged), ("relabel", new != role)) if y) or "keep")
                out["inserted"].append([NAMES[r] for r in (*put_in, *closing)])
                out["cost"].append(float(step.cost[before, new] + (INSERT * len(closing))))
                out["piece"].append(piece)
                before = new
        return pa.table(
            {
                **{c: batch.column(c) for c in ("conv_id", "place", "turn", "role")},
                "new_role": pa.array(out["new_role"], pa.string()),
                "action": pa.array(out["action"], pa.string()),
                "inserted": pa.array(out["inserted"], pa.list_(pa.string())),
                "cost": pa.array(out["cost"], pa.float64()),
                "piece": pa.array(out["piece"], pa.string()),
            }
        )

    schema = "conv_id long, place long, turn long, role string, new_role string, action string, inserted array<string>, cost double, piece string"
    return placed.groupBy("part").applyInArrow(render, schema)


def rendered(pieces: DataFrame) -> DataFrame:
    """conv_id, cost and the rendered text of each conversation that fits in a row."""
    parts = F.array_sort(F.collect_list(F.struct("place", "piece")))
    return pieces.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias("rendered")
    )
