"""Embedding links, the prefix trie and structure repair against brute force, on small tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tillroll.llm import embedding_links, prefix_trie, structure_repair
from tillroll.llm.scratch import ready

VECTORS = "vec_id long, embedding array<float>, label int, node string, n long"
TURNS = "conv_id long, turn long, role string, text string, place long, node string"


# --- embedding links ----------------------------------------------------------


def brute_links(rows):
    """(vec_id, n_links, component_id, kept) of rows of (vec_id, vector)."""
    def unit(v):
        v = np.array([np.nan if x is None else x for x in v or []], np.float32).astype(float)
        return v / np.linalg.norm(v) if len(v) and np.isfinite(v).all() and v.any() else None

    units = [unit(v) for _, v in rows]
    near = [[j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9] for i, a in enumerate(units)]
    out = []
    for i, (id_, _) in enumerate(rows):
        seen, front = {i}, [i]
        while front:
            new = [j for j in near[front.pop()] if j not in seen]
            seen.update(new)
            front += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((id_, len(near[i]), min(ids, default=None), id_ == min(ids, default=None)))
    return sorted(out, key=str)


def links(spark, rows):
    table = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)
    return sorted((tuple(r) for r in embedding_links.embedding_links(table).collect()), key=str)


def family(rng, dim, spread, n):
    centre = rng.normal(size=dim)
    return [(centre + rng.normal(size=dim) * spread).tolist() for _ in range(n)]


@pytest.mark.parametrize("block", [embedding_links.BLOCK, 16])
def test_links_like_all_pairs(spark, monkeypatch, block):
    """Groups around the threshold and tight ones, copies, scaled copies; also in blocks of few nodes."""
    monkeypatch.setattr(embedding_links, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [v for spread in (0.05, 0.2, 0.33, 0.4) for v in family(rng, 24, spread, 40)]
    rows += [rows[0]] * 30 + [[2 * x for x in rows[5]]] + [(-np.array(rows[5])).tolist()] + [rng.normal(size=24).tolist() for _ in range(60)]
    rows = list(enumerate(rows))
    assert links(spark, rows) == brute_links(rows)


def test_links_of_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 2.0]), (6, [float("inf"), 1.0, 0.0])]
    rows += [(7, v), (7, v), (8, v), (8, [-x for x in v]), (9, v[:2]), (None, v), (None, [9.0, -1.0, 0.0]), (12, [1.0]), (13, [5.0]), (14, [-1.0]), (15, [3e38, 3e38, 3e38]), (16, [1e-30, 1e-30, 1e-30])]
    expected = [(i, n, c, True if i is None and c is None else k) for i, n, c, k in brute_links(rows)]
    assert links(spark, rows) == sorted(expected, key=str)
    assert links(spark, []) == []


def test_only_rows_per_node_come_back(spark, monkeypatch):
    """A group in which all are linked with all gives no more rows than nodes and tables."""
    rng = np.random.default_rng(5)
    rows = list(enumerate(family(rng, 16, 0.05, 300)))
    sizes = []
    real = embedding_links.written
    monkeypatch.setattr(embedding_links, "written", lambda df, label, **k: [d := real(df, label, **k), sizes.append((label, d.count()))][0])
    assert {r[1] for r in links(spark, rows)} == {299}
    tables = embedding_links.tables_for(16, embedding_links.hashes_for(300, 16), 0.9)
    assert all(n <= 300 * tables for label, n in sizes if label == "open")
    assert all(n <= 2 * 300 * tables for label, n in sizes if label == "links")


@pytest.mark.parametrize("dim", [2, 7, 64, 200])
def test_estimates_are_unbiased_and_bounded(dim):
    rng = np.random.default_rng(dim)
    x = embedding_links.units(rng.normal(size=(3000, dim)))
    z = rng.normal(size=(3000, dim))
    z = embedding_links.units(z - (z * x).sum(1)[:, None] * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    made = embedding_links.plan(dim, 1, 0.9)
    a, b = (embedding_links.decoded(embedding_links.coded(v, made), dim) for v in (x, y))
    estimate = (a.signs * b.rotated).sum(1) / a.factor
    if dim > 2:  # in the plane one rotation is one angle
        assert abs(estimate.mean() - 0.9) < 0.01
    low = embedding_links.least_estimate(a, float(b.step.max()), 0.9, dim)
    assert (estimate < low).mean() < 0.001


def test_tables_reach_the_stated_chance():
    for dim in (8, 64, 300):
        rng = np.random.default_rng(1)
        x = embedding_links.units(rng.normal(size=(400, dim)))
        z = rng.normal(size=(400, dim))
        y = 0.9 * x + np.sqrt(0.19) * embedding_links.units(z - (z * x).sum(1)[:, None] * x)
        for hashes in (1, 2):
            made = embedding_links.plan(dim, hashes, 0.9)
            assert (embedding_links.celled(x, made) == embedding_links.celled(y, made)).any(1).mean() > 0.99


# --- prefix trie --------------------------------------------------------------


def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            convs[conv].append(((turn is not None, turn or 0), role or "", hashlib.md5(text.encode()).hexdigest(), text))
    convs = {c: [(t[1], t[3]) for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = convs.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    nodes, kids, totals = defaultdict(list), defaultdict(list), {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    for node in nodes:
        if node:
            kids[node[:-1]].append(node)
    for node in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [totals[k] for k in kids[node]]
        totals[node] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(nodes[node]) - 1) * words)
    out = []
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(node))
        above = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), above, len(members), len(kids[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows):
    table = ready(spark).createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(table).collect()), key=str)


def conversations(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 2, 3, 5])):
            rows.append((c * rng.choice([1, 1, 3]), t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "a b\tc"])))
    return rows


def test_trie_like_brute_force(spark, monkeypatch):
    """With copies, null values, repeated turns, absent stems, negative ids, one long conversation, and small blocks."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 8)
    rows = conversations(random.Random(4), 60) + [(200 + c, t, "user", "same") for c in range(40) for t in range(3)]
    rows += [(77, t, "user", "deep") for t in range(45)] + [(97, t, "user", "deep") for t in range(30)]
    rows += [(-5, 0, "user", "x"), (-25, 0, "user", "y"), (None, 1, "user", "z"), (500007, 0, "user", "only")]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_no_turns(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 0, "user", "x")]) == []


def test_contraction_of_a_chain_and_a_star(spark):
    """A chain of 40 under a root with 30 leaves; rounds stay few."""
    edges = [("r", None)] + [(f"c{i}", f"c{i - 1}" if i else "r") for i in range(40)] + [(f"s{i}", "r") for i in range(30)]
    nodes = spark.createDataFrame([(n, p, 1) for n, p in edges], "node string, parent string, w long")
    found = {r["node"]: r["w"] for r in prefix_trie.subtree_totals(nodes, ["w"]).collect()}
    assert found["r"] == 71 and all(found[f"c{i}"] == 40 - i for i in range(40)) and all(found[f"s{i}"] == 1 for i in range(30))
    assert len(found) == len(edges)


# --- structure repair ---------------------------------------------------------

STEPS = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def cheapest(symbols, gone, more):
    """Least (cost, audit) and what is left, over a plain automaton with whole audits."""
    def put(layer, state, value):
        if state and (state not in layer or value[:2] < layer[state][:2]):
            layer[state] = value
            return True

    def closed(layer):
        work = list(layer)
        while work:
            state = work.pop()
            cost, audit, left = layer[state]
            for s in "ua":
                if put(layer, STEPS.get((state, s)), (cost + 5, audit + "I", (*left, (s, None)))):
                    work.append(STEPS[state, s])
        return layer

    layer = closed({"0": (0, "", ())})
    for i, own in enumerate(symbols):
        new = {}
        for state, (cost, audit, left) in layer.items():
            put(new, state, (cost + 2, audit + "D", left))
            if not gone[i]:
                put(new, STEPS.get((state, own)), (cost + more[i], audit + "K", (*left, (None, i))))
                for s in "ua":
                    put(new, STEPS.get((state, s)), (cost + 1 + more[i], audit + "R", (*left, (s, i))))
        layer = closed(new)
    return min(layer[s] for s in "0A" if s in layer)


def brute_report(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = convs[conv]
        role = "user" if draw == 4 else role
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
        own += [((turn is not None, turn or 0, role.encode(), digest), turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[0])
        places = [t[1] for t in turns if t[1] is not None]
        gaps = max(places) - min(places) + 1 - len(set(places)) if places else 0
        kinds, seen = [], set()
        for _, _, role, text in turns:
            bare = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [t[2][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, left = cheapest(initials, [k in ("blank", "duplicate") for k in kinds], [5 * (k == "truncated") for k in kinds])
        name = {"u": "user", "a": "assistant"}
        text = "\n".join((name[s] if s else turns[i][2]) + ":" + ("" if i is None else turns[i][3]) for s, i in left)
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def report(spark, rows):
    table = ready(spark).createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    found = structure_repair.structure_report(structure_repair.damaged(table), table)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_repair_like_brute_force(spark):
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", " ", None, "User", "unknown"]
    texts = ["Yes.", "No!", "why?", "broken", "", " \t", None, "two. parts", "ends.\n", "x. "]
    rows = [(c, t if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts)) for c in range(80) for t in range(rng.randint(1, 9))]
    rows += [(200, t, ("user", "assistant")[t % 2], f"fine {t}.") for t in range(300)] + [(None, t, "user", f"{t}.") for t in range(4)]
    rows += rows[:40]
    assert report(spark, rows) == brute_report(rows)
    assert report(spark, []) == []


def test_repair_of_a_conversation_that_loses_all_turns(spark):
    lost = [(c, 0, "user", "hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert lost and report(spark, lost) == brute_report(lost)
    assert {r[1:8] for r in report(spark, lost)} == {(0, 0, 0, 0, 0, 0, "")}


def test_parser_like_brute_force():
    rng, parser = random.Random(1), structure_repair.Repairer()
    for n in range(6000):
        codes = bytes(rng.choice([0, 1, 2, 3, 1, 2, 4, 5, 6, 8, 9, 10]) for _ in range(rng.randint(0, 8 if n % 10 else 40)))
        cost, letters, last = parser.edits(codes)
        expected = cheapest(["sua?"[c & 3] for c in codes], [bool(c & 8) for c in codes], [5 * bool(c & 4) for c in codes])
        assert (cost, "".join(letters) + last) == expected[:2]


def test_few_sets_of_stacks():
    """The parser's memory does not grow with a conversation's length."""
    rng, parser = random.Random(2), structure_repair.Repairer()
    codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 9]) for _ in range(200_000))
    parser.edits(codes[:100_000])
    known = len(parser.steps)
    assert known < 20_000
    parser.edits(codes)
    assert len(parser.steps) < 1.2 * known
