"""Operators for training data against brute force, on small tables."""

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import chat, curriculum, decontamination, licenses, near_duplicates, nearest, suffix_dedup, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to") for b in ("ba", "de", "fi", "go", "hu", "ja", "ke", "lu")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in texts], DOCS)


# --- near-duplicates ----------------------------------------------------------


def shingle_counts(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(texts):
    """Classes of a list of (id, text) by all pairs."""
    sets = {i: shingle_counts(t) for i, t in texts}
    df = Counter(s for c in sets.values() for s in c)
    n = sum(1 for c in sets.values() if c)
    weight = {s: 1 + near_duplicates.IDF_SHARE * np.log1p(n / df[s]) for s in df}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    plain = dict(texts)
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            same = plain[a] and plain[a] == plain[b]
            if not same and sets[a] and sets[b]:
                low = sum(weight[s] * min(sets[a][s], sets[b][s]) for s in sets[a].keys() & sets[b].keys())
                high = sum(weight[s] * max(sets[a][s], sets[b][s]) for s in sets[a].keys() | sets[b].keys())
                same = low / high >= 0.8
            if same:
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: root(i) for i in ids}


def near_fixture(rng):
    texts = []
    for g in range(12):
        words = prose(rng, 150).split()
        for c in range(rng.choice([1, 2, 5])):
            copy = list(words)
            for _ in range(c):
                copy[rng.randrange(len(copy))] = "odd" + str(rng.randrange(10**6))
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0], "one two three", "one two three", "", None, "***", "***", prose(rng, 6000)]
    return list(enumerate(texts))


def test_near_duplicates_like_all_pairs(spark):
    texts = near_fixture(random.Random(4))
    found = {r["doc_id"]: (r["class_id"], r["stays"]) for r in near_duplicates.classes(documents(spark, texts)).collect()}
    wanted = brute_classes(texts)
    assert found == {i: (c, c == i) for i, c in wanted.items()}


def test_large_group_in_blocks(spark, monkeypatch):
    """A bucket of many blocks: every near copy is found, though not all pairs are made."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    rng = random.Random(9)
    words = prose(rng, 200).split()
    texts = []
    for i in range(150):
        copy = list(words)
        copy[i] = "odd" + str(i)
        texts.append((i, " ".join(copy)))
    texts += [(i, prose(rng, 200)) for i in range(150, 160)]
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(documents(spark, texts)).collect()}
    assert all(found[i] == 0 for i in range(150)) and all(found[i] == i for i in range(150, 160))


def substituted(rng, words, places):
    return [f"odd{rng.randrange(10**9)}" if k in places else w for k, w in enumerate(words)]


def families(rng, groups, partners):
    """In each group two texts at 0.81 of each other, each with partners at 0.76, and all others below that."""
    texts = []
    for _ in range(groups):
        words, places = prose(rng, 200).split(), range(5, 195, 5)
        four = rng.sample(places, 4)
        for own in (four[:2], four[2:]):
            centre = substituted(rng, words, own)
            texts.append(" ".join(centre))
            for _ in range(partners):
                texts.append(" ".join(substituted(rng, centre, rng.sample([p for p in places if p not in four], 5))))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_link_behind_many_closer_looking_partners(spark):
    texts = families(random.Random(6), 6, 24)
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(documents(spark, texts)).collect()}
    wanted = brute_classes(texts)
    assert len(texts) - len(set(wanted.values())) == 6 and found == wanted


def test_all_blocks_of_a_bucket_meet(spark, monkeypatch):
    """Two nodes of any blocks whose samples agree are in a meeting together, unless they are of one class already."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    rng = np.random.default_rng(5)
    drawn = rng.integers(0, 2**32, (60, near_duplicates.SAMPLES), np.uint32)
    for k in range(30):
        drawn[30 + k, :20] = drawn[k, :20]
    rows = [(7, 0, bytes([i]) * 16, bytearray(d.tobytes()), 60, 15) for i, d in enumerate(drawn)]
    members = spark.createDataFrame(rows, "key long, band int, node binary, drawn binary, n long, blocks long")
    found = spark.createDataFrame([(bytes([i]) * 16, bytes([1]) * 16) for i in (1, 31)], "node binary, component binary")
    meetings = defaultdict(set)
    for r in near_duplicates.partnered(near_duplicates.across_blocks(members, found)).collect():
        meetings[r["one"], r["two"]].add(r["node"][0])
    met = {(k, 30 + k) for k in range(30) if any({k, 30 + k} <= m for m in meetings.values())}
    assert met == {(k, 30 + k) for k in range(30) if k != 1}
    inside = {(r["node"][0]) % 30 for r in near_duplicates.partnered(near_duplicates.within_blocks(members)).collect()}
    assert len(inside) < 30


def test_bound_on_agreeing_samples():
    rng = np.random.default_rng(8)
    drawn = rng.integers(0, 2**32, (4, near_duplicates.SAMPLES), np.uint32)
    drawn[1, :15], drawn[3, :14] = drawn[0, :15], drawn[2, :14]
    sides = near_duplicates.Sides(drawn, np.arange(4), np.arange(4), np.arange(4))
    (rows, found), = near_duplicates.likely(sides, 0, True)
    assert rows.tolist() == [0, 1, 2, 3] and np.argwhere(found).tolist() == [[0, 1]]
    assert not next(near_duplicates.likely(sides, 1, True))[1].any() and next(near_duplicates.likely(sides, 1, False))[1].any()
    one_class = near_duplicates.Sides(drawn, np.zeros(4, int), np.arange(4), np.arange(4))
    assert not next(near_duplicates.likely(one_class, 0, True))[1].any()


def test_rows_of_a_family_do_not_grow_with_its_pairs(spark, monkeypatch):
    """Texts at about 0.72 of each other: every pair is likely, none is a link, and rows stay within nodes and bands."""
    rng = random.Random(3)
    words, sizes = prose(rng, 300).split(), {}
    real = near_duplicates.written
    monkeypatch.setattr(near_duplicates, "written", lambda df, label, **k: [d := real(df, label, **k), sizes.setdefault(label, []).append(d.count())][0])
    texts = [(i, " ".join(substituted(rng, words, rng.sample(range(2, 298, 4), 10)))) for i in range(150)]
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates.classes(documents(spark, texts)).collect()}
    assert found == brute_classes(texts)
    assert all(n <= 150 * near_duplicates.BANDS for label, n in ((label, n) for label, ns in sizes.items() for n in ns))
    assert max(sizes["partnered"]) > 150 and sum(sizes["links"]) < 150


def test_sample_agreement_estimates_similarity():
    rng = np.random.default_rng(0)
    tables = near_duplicates.random_tables()
    agree = []
    for _ in range(40):
        shared, a, b = (np.sort(rng.integers(0, 2**48, n).astype(np.uint64)) for n in (300, 50, 50))
        drawn = []
        for own in (a, b):
            keys = np.sort(np.concatenate([shared, own]))
            drawn.append(near_duplicates.samples(keys, np.zeros(len(keys), np.float32), np.array([0, len(keys)]), tables)[0])
        agree.append((drawn[0] == drawn[1]).mean())
    assert abs(np.mean(agree) - 0.75) < 0.04


# --- suffix arrays ------------------------------------------------------------


def brute_removal(rows):
    first = {}
    last = suffix_dedup.LAST
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, last), last if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < (last if i is None else i):
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def suffix_rows():
    rng = random.Random(5)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(0, 300))) for _ in range(30)]
    rows = [
        (i, "".join(rng.choice(base)[rng.randint(0, 50) : rng.randint(40, 300)] for _ in range(rng.randint(0, 4))))
        for i in range(120)
    ]
    return rows + [(300, None), (301, ""), (None, base[0] * 2), (7, base[3]), (7, base[3]), (400, "a" * 5000), (401, "a" * 49), (402, "a" * 70)]


@pytest.mark.parametrize("limit", [None, 2000])
def test_suffix_removal_like_all_strings(spark, monkeypatch, limit):
    """Also with buckets so small that strings are dealt out anew by finer keys."""
    if limit:
        monkeypatch.setattr(suffix_dedup, "BUCKET_LIMIT", limit)
    rows = suffix_rows()
    found = suffix_dedup.deduplicated(documents(spark, rows)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute_removal(rows)


def test_only_pieces_that_another_id_may_share_are_sorted(spark, monkeypatch):
    """Equal pieces go into a suffix array once and share what is found, and pieces of a key that no other id has then do not at all."""
    real = suffix_dedup.sorted_spans

    def watched(ids, sizes, data, begins):
        assert sorted(ids.tolist()) == [1, 6] and len(data) == 2 * 59, "sorted more than it needs"
        return real(ids, sizes, data, begins)

    monkeypatch.setattr(suffix_dedup, "sorted_spans", watched)
    text = bytes(range(33, 93))
    rows = [(0, key, i, bytes([i]), 100 * i, 10, piece) for key, i, piece in [
        # Key 5: one piece under three ids and another that overlaps with it; 6: equal pieces; 7, 8: one id each.
        (5, 4, text[:59]), (5, 1, text[:59]), (5, 4, text[:59]), (5, 6, text[1:]), (5, 6, text[1:]), (5, 7, text[1:]),
        (6, 3, b"y" * 59), (6, 2, b"y" * 59), (7, 5, b"z" * 59), (7, 5, b"u" + b"z" * 58), (8, 9, b"w" * 59),
    ]]
    pieces = spark.createDataFrame(rows, suffix_dedup.PIECE).coalesce(1)
    found = suffix_dedup.spans(pieces).collect()
    assert sorted((r["id"], r["start"], r["size"]) for r in found) == [(3, 300, 10), (4, 400, 10), (4, 400, 10), (6, 600, 9), (6, 600, 9), (7, 700, 10)]


def test_segments_of_many_texts_at_once(spark):
    """Texts of one batch keep their own keys, also where rows of one id have short and long texts."""
    rng = random.Random(3)
    passages = [prose(rng, 40) for _ in range(4)]
    rows = [(i, passages[i % 4] + (passages[(i + 1) % 4] if i % 3 else "")) for i in range(60)]
    rows += [(61, "short"), (61, passages[0]), (62, prose(rng, 40)), (None, "short"), (None, passages[1] * 2)]
    found = suffix_dedup.deduplicated(documents(spark, rows).coalesce(1)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute_removal(rows)


def test_passages_that_a_document_repeats_in_itself(spark):
    """All copies within one document lose what an earlier document shares with a part of the passage."""
    rng = random.Random(11)
    for at in (0, 40, 80):
        passage = prose(rng, 40)
        rows = [(1, prose(rng, 10) + passage[at : at + 120] + prose(rng, 10)), (2, prose(rng, 10).join([passage] * 4)), (3, passage * 3)]
        rows += [(2, passage + prose(rng, 5)), (None, passage * 2), (None, prose(rng, 9) + passage[20:])]
        found = suffix_dedup.deduplicated(documents(spark, rows)).collect()
        assert sorted((tuple(r)[:5] for r in found), key=str) == brute_removal(rows)


def test_rows_without_an_id_get_the_keys_of_their_own_text(spark, monkeypatch):
    """A third of all rows has no id; what shares a passage with an earlier document is found, and lists of keys stay short."""
    rng = random.Random(9)
    passage = prose(rng, 30)
    rows = [(i if i % 3 else None, prose(rng, 20) + (passage if i % 4 == 0 else "") + prose(rng, 20)) for i in range(300)]
    rows += [rows[0], rows[3]]
    sent = []
    real = suffix_dedup.segments
    monkeypatch.setattr(suffix_dedup, "segments", lambda texts, shared: real(texts, sent.append(suffix_dedup.written(shared, "keys")) or sent[-1]))
    found = suffix_dedup.deduplicated(documents(spark, rows)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute_removal(rows)
    lists = [r["count"] for r in sent[0].groupBy("id").count().collect()]
    assert len(lists) > 60 and max(lists) < 100


def test_suffix_removal_keeps_characters_whole(spark):
    rows = [(1, "é" * 60 + "x" * 60), (2, "A" + "é" * 60 + "B" + "x" * 60)]
    found = {r["doc_id"]: r for r in suffix_dedup.without_repeats(documents(spark, rows)).collect()}
    assert found[1]["text"] == rows[0][1] and found[2]["text"] == "AB" and found[2]["n_chars"] == 2


def test_suffix_ranks_sort():
    rng = np.random.default_rng(0)
    for size, symbols in ((3000, 2), (5000, 60), (4000, 200)):
        x = rng.integers(0, symbols, size).astype(np.uint8)
        x[1000:1400] = x[100:500]
        data = np.concatenate([x, x[:300], x[:49]])
        places = np.sort(rng.choice(len(data) - 50, 1000, replace=False))
        order, group = suffix_dedup.equal_groups(data, places)
        prefixes = [data[p : p + 50].tobytes() for p in order]
        assert prefixes == sorted(prefixes)
        assert all((a == b) == (g == h) for a, b, g, h in zip(prefixes, prefixes[1:], group, group[1:]))


# --- decontamination ----------------------------------------------------------


def brute_overlap(text, item):
    """The longest stretch along any alignment with at least 0.8 agreeing words."""
    t, q = (re.findall(r"[^\W_]+", x.lower()) for x in (text or "", item or ""))
    best = 0
    for shift in range(-len(q) + 1, len(t)):
        agree = [t[i] == q[i - shift] for i in range(max(0, shift), min(len(t), shift + len(q)))]
        for a in range(len(agree)):
            for b in range(len(agree), a + best, -1):
                if sum(agree[a:b]) >= 0.8 * (b - a):
                    best = max(best, b - a)
                    break
    return best, len(q)


def test_decontamination_like_all_alignments(spark):
    rng = random.Random(2)
    items = [(k, prose(rng, rng.randint(7, 40))) for k in range(12)] + [(50, "too short"), (51, None), (52, "")]
    items.append((60, items[0][1]))
    texts = []
    for k in range(40):
        words = items[k % 12][1].split()
        if k % 3 == 1:
            words = words[: max(8, len(words) // 2)]
        if k % 4 == 2:
            for at in range(4, len(words), 7):
                words[at] = "other"
        passage = " ".join(words) if k % 5 else ""
        texts.append((k, f"{prose(rng, rng.randint(0, 30))} {passage} {prose(rng, rng.randint(0, 30))}"))
    texts += [(90, None), (91, ""), (None, items[3][1])]
    found = decontamination.overlaps(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r["doc_id"], r["item_id"]): r["n_tokens"] for r in found}
    wanted = {}
    for i, t in texts:
        for k, q in items[:12]:
            length, size = brute_overlap(t, q)
            if size >= decontamination.MIN_ITEM and length >= min(decontamination.MIN_TOKENS, size):
                wanted[i, k] = length
    assert pairs.keys() == wanted.keys()
    kept = decontamination.without_benchmark(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in texts} - {i for i, _ in wanted}


def test_items_without_an_id_are_found(spark):
    rng = random.Random(3)
    texts, items = [(k, prose(rng, 40)) for k in range(4)], []
    items = [(None, " ".join(texts[0][1].split()[5:25])), (None, " ".join(texts[1][1].split()[5:25])), (8, prose(rng, 20))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = [(r["doc_id"], r["item_id"], r["n_tokens"]) for r in decontamination.overlaps(documents(spark, texts), benchmark).collect()]
    assert sorted(found) == [(0, None, 20), (1, None, 20)]
    assert {r["doc_id"] for r in decontamination.without_benchmark(documents(spark, texts), benchmark).collect()} == {2, 3}


def test_common_openings_of_many_items(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 16)
    monkeypatch.setattr(decontamination, "REGION_BLOCK_BITS", 3)
    rng = random.Random(8)
    opening = "which of these answers is the right one".split()

    def fresh(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    items = [opening + fresh(rng.randint(6, 30)) for _ in range(60)]
    texts = [" ".join(fresh(5) + opening + fresh(40)) for _ in range(80)]
    for k in range(0, 60, 4):
        words = list(items[k])
        words[10] = "other"
        texts.append(" ".join(fresh(rng.randint(0, 200)) + words + fresh(20)))
    rows = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    kept = []
    real = decontamination.alignments_of_many

    def counted(*args):
        found = real(*args)
        kept.append(found.distinct().count())
        return found

    monkeypatch.setattr(decontamination, "alignments_of_many", counted)
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(documents(spark, list(enumerate(texts))), rows).collect()}
    assert found == {(80 + k // 4, k) for k in range(0, 60, 4)}
    assert kept == [len(found)]  # rows of findings, not of 95 texts times 60 items
    monkeypatch.setattr(decontamination, "FEW", 10**6)
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(documents(spark, list(enumerate(texts))), rows).collect()} == found


@pytest.mark.parametrize("seed", range(3))
def test_long_enough_like_every_stretch(seed):
    rng = np.random.default_rng(seed)
    agree = rng.random((60, 40)) < rng.uniform(0.5, 0.95, (60, 1))
    least = rng.integers(3, 20, 60)
    expected = [
        any(agree[r, a:b].sum() >= 0.8 * (b - a) - 1e-9 for a in range(40) for b in range(a + least[r], 41)) for r in range(60)
    ]
    assert decontamination.long_enough(agree, least, 0.8).tolist() == expected


def test_very_short_items_where_asked_for(spark):
    texts = ["alpha beta gamma delta epsilon", "say alpha twice", "alpha beta other delta epsilon", "", None, "beta alpha"]
    items = spark.createDataFrame([(1, "Beta alpha"), (2, "alpha beta gamma delta epsilon"), (3, "twice")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(documents(spark, list(enumerate(texts))), items, min_item=1).collect()}
    assert found == {(5, 1), (0, 2), (2, 2), (1, 3)}
    assert decontamination.overlaps(documents(spark, list(enumerate(texts))), items).count() == 0


def test_short_items_with_all_allowed_substitutions(spark):
    """Items of 6 to 12 words with every pattern of one substitution, or two from 10 words on; one more is too many."""
    rng = random.Random(12)
    items = [(n, " ".join(rng.sample(WORDS, n))) for n in range(6, 13)]
    texts, wanted = [], set()
    for n, item in items:
        allowed = n // 5
        for count in (allowed, allowed + 1):
            for places in combinations(range(n), count):
                if count == allowed:
                    wanted.add((len(texts), n))
                texts.append((len(texts), f"before it {' '.join(substituted(rng, item.split(), places))} behind it"))
    found = decontamination.overlaps(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == wanted


# --- token counts -------------------------------------------------------------


def test_token_counts_like_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(0)
    letters = "aaab  \n\t\r\x1c\x85  éñ’'sdl'll 012٣中😀‍.,!?<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 5000, " " * 3000, "ab" * 3000, "", None]
    library = Tokenizer.from_file(path)
    wanted = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    found = token_counts.token_counts(documents(spark, list(enumerate(texts))), token_counts.read_vocabulary(path)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found} == {
        i: (len((t or "").encode()), n, n > 1024) for i, (t, n) in enumerate(zip(texts, wanted))
    }


# --- licenses -----------------------------------------------------------------


def test_licenses_like_all_templates(spark):
    rng = random.Random(1)
    templates = list(licenses.TEMPLATES.items())
    texts = []
    for k in range(60):
        name, template = templates[k % len(templates)]
        words = template.split()
        if k % 3 == 1:
            words = words[: len(words) * 2 // 3]
        texts.append((k, f"{prose(rng, rng.randint(0, 60))} {' '.join(words).upper() if k % 2 else ' '.join(words)} {prose(rng, 30)}"))
    texts += [(80, None), (81, ""), (82, "the license"), (None, templates[0][1]), (None, templates[0][1]), (83, prose(rng, 5000))]
    wanted = set()
    for i, t in texts:
        words = re.findall(r"[^\W_]+", (t or "").lower())
        own = {" ".join(words[k : k + 5]) for k in range(len(words) - 4)}
        for name, template in templates:
            part = set(licenses.template_shingles(template))
            if len(part & own) >= 0.8 * len(part):
                wanted.add((i, name))
    found = licenses.licenses(documents(spark, texts)).collect()
    assert {(r["doc_id"], r["license"]) for r in found} == wanted and len(found) == len(wanted)


def test_cover_words_hit_every_shingle():
    every = {s for t in licenses.TEMPLATES.values() for s in licenses.template_shingles(t)}
    cover = set(licenses.cover_words(every))
    assert all(cover & set(s.split(" ")) for s in every)
    with pytest.raises(ValueError):
        licenses.template_shingles("only four words here")


# --- chat ---------------------------------------------------------------------


def cheapest(roles):
    """Least cost by a search over (turn, state)."""
    codes = [chat.ROLES.get((r or "").strip().lower(), chat.NONE) for r in roles]
    follows = {3: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
    seen, heap = set(), [(0.0, 0, 3)]
    while heap:
        cost, turn, state = heapq.heappop(heap)
        if (turn, state) in seen:
            continue
        seen.add((turn, state))
        if turn == len(codes) and state == 2:
            return cost
        for role in follows[state]:
            heapq.heappush(heap, (cost + chat.INSERT, turn, role))
        if turn < len(codes):
            for role in range(3):
                change = 0 if role == codes[turn] else chat.UNKNOWN if codes[turn] == 3 else chat.RELABEL
                if role in follows[state]:
                    heapq.heappush(heap, (cost + change, turn + 1, role))
                if role == state:
                    heapq.heappush(heap, (cost + change + chat.MERGE, turn + 1, role))


def test_chat_repair_is_cheapest_and_legal(spark):
    """A conversation of thousands of turns crosses many parts."""
    rng = random.Random(1)
    names = ["system", "user", "assistant", "Human ", "bot", "weird", None]
    talks = {c: [rng.choice(names) for _ in range(rng.randint(1, 9))] for c in range(150)}
    talks[1000] = [rng.choice(names) for _ in range(3000)]
    talks[None] = ["user", "user"]
    rows = [(c, i, r, f"t{i}" if i % 5 else None) for c, rs in talks.items() for i, r in enumerate(rs)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    pieces = chat.repaired(turns)
    found = {r["conv_id"]: (r["cost"], r["rendered"]) for r in chat.rendered(pieces).collect()}
    assert pieces.count() == len(rows) and found.keys() == talks.keys()
    legal = {("system", "user"), ("user", "assistant"), ("assistant", "user")}
    for c, (cost, text) in found.items():
        assert cost == pytest.approx(cheapest(talks[c]))
        turns_ = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
        roles = [r for r, _ in turns_]
        assert roles[0] in ("system", "user") and roles[-1] == "assistant" and set(zip(roles, roles[1:])) <= legal
        assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns_) == text
        assert [t for x in turns_ for t in x[1].split("\n\n") if t] == [f"t{i}" for i in range(len(talks[c])) if i % 5]
    assert chat.repaired(turns.limit(0)).count() == 0


def test_chat_repair_of_one_row_many_times(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_ROWS", 100)
    rows = [(1, 1, "user", "same")] * 1500 + [(None, 2, "assistant", "end")] * 300 + [(2, 1, "user", "q"), (2, 2, "bot", "a")]
    done = chat.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    parts = {r["part"]: r["count"] for r in done.selectExpr("shiftright(place, 33) part").groupBy("part").count().collect()}
    assert sum(parts.values()) == 1802 and max(parts.values()) < 400
    cost = {r["conv_id"]: r["cost"] for r in chat.rendered(done).select("conv_id", "cost").collect()}
    # All but one are merged; one is relabelled, which is cheaper than a merge and an empty turn.
    assert cost == {1: 1498 * chat.MERGE + chat.RELABEL, None: 298 * chat.MERGE + chat.RELABEL, 2: 0.0}


# --- nearest neighbours -------------------------------------------------------


def test_nearest_recall_and_order(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(6000, 16)).astype(np.float32)
    points[100:2100] = points[0]  # a third are one vector
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [None] * 16), (9080, [1.0] * 3), (None, [1.0] * 16), (9100, [float("inf")] * 16)]
    rows += rows[:3]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(8)
    from pyspark.sql import functions as F

    found = defaultdict(list)
    for r in nearest.nearest(table, F.col("vec_id") % 200 == 0, 20).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    exact = points.astype(float)
    hits = 0
    assert set(found) == set(range(0, 6000, 200))
    for q, rows_ in found.items():
        scores = (exact * exact[q]).sum(1)
        order = [i for i in np.lexsort((np.arange(6000), -scores)) if i != q][:20]
        assert len(rows_) == 20 and all(abs(scores[i] - s) < 1e-9 for i, s in rows_)
        assert rows_ == sorted(rows_, key=lambda x: (-x[1], x[0]))
        hits += len({i for i, _ in rows_} & set(order))
    assert hits / (20 * len(found)) >= 0.9
    assert nearest.nearest(table.limit(0), F.col("vec_id") % 2 == 0, 3).count() == 0
    few = nearest.nearest(table.where("vec_id < 3"), F.col("vec_id") == 0, 20)
    assert [r["vec_id"] for r in few.orderBy("rank").collect()] == sorted([1, 2], key=lambda i: -(exact[i] @ exact[0]))


def test_nearest_of_all_cells_is_exact(spark, monkeypatch):
    from pyspark.sql import functions as F

    for name, value in (("BLOCK", 64), ("BUNDLE", 3), ("QUERY_BLOCK", 8), ("TURNS", 2)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(5)
    points = rng.normal(size=(900, 8))
    points[:300] = points[0]  # a third in one cell
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(700, (3 * points[0] + rng.normal(size=8) / 9).tolist()) for _ in range(90)]  # one id, many near rows
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = defaultdict(list)
    for r in nearest.nearest(table, F.col("vec_id") % 10 == 0, 7, share=1.0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    ids, exact = np.array([i for i, _ in rows]), np.array([p for _, p in rows])
    for q in range(0, 900, 10):
        score = (exact[:, None, :] * exact[ids == q][None, :, :]).sum(2).max(1)
        best = {}
        for i, x in zip(ids.tolist(), score.tolist()):
            if i != q:
                best[i] = max(x, best.get(i, -np.inf))
        assert found[q] == sorted(best, key=lambda i: (-round(best[i], 9), i))[:7]


def test_best_of_each_query():
    queries, ids = np.array([2, 1, 2, 2, 1, 2]), np.array([5, 5, 5, 4, 3, 9])
    scores = np.array([1.0, 2.0, 3.0, 3.0, 2.0, 0.5])
    assert [x.tolist() for x in nearest.best_of_each(queries, ids, scores, 2)] == [[1, 1, 2, 2], [3, 5, 4, 5], [2.0, 2.0, 3.0, 3.0]]


# --- curriculum ---------------------------------------------------------------


def test_curriculum_targets_and_positions(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(0, 80)), "en", rng.choice(["a", "b", "b", "b", "c", None]), 0) for i in range(600)]
    rows += [(600, None, None, "d", 0), (601, "", None, "d", 0), (None, "x y z", None, "a", 0), (602, prose(rng, 20_000), "en", "b", 0)]
    mix = curriculum.curriculum(spark.createDataFrame(rows, DOCS)).collect()
    assert len(mix) == len(rows)
    sizes = {(r["doc_id"], r["source"]): r["size"] for r in mix}
    assert all(sizes[i, s] == len((t or "").split()) for i, t, _, s, _ in rows)
    total, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in mix:
        total[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"] and len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
    # Reshare step by step, as the contract words it.
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, wanted = 1.5 * sum(total.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= 2 * total[s]}
        for s in above or open_:
            wanted[s] = 2 * total[s] if above else share[s]
        left -= sum(wanted[s] for s in above)
        open_ = open_ - above if above else set()
    for s in names:
        assert target[s] == pytest.approx(wanted[s], abs=1e-5)
        largest = max(r["size"] for r in mix if r["source"] == s)
        assert abs(taken[s] - target[s]) <= largest / 2 + 1
    order = curriculum.training_order(curriculum.curriculum(spark.createDataFrame(rows, DOCS))).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)
    assert curriculum.curriculum(spark.createDataFrame([], DOCS)).count() == 0


def test_rows_without_an_id_are_dealt_out_by_their_text(spark, monkeypatch):
    """Two thirds of a source without ids: they lie in many slots, and the source's target is met."""
    stored = []
    real = curriculum.written
    monkeypatch.setattr(curriculum, "written", lambda df, label, **k: stored.append(real(df, label, **k)) or stored[-1])
    rng = random.Random(3)
    rows = [(i if i % 3 == 0 else None, prose(rng, 5 + i % 7), "en", "a", 1) for i in range(600)] + [(None, None, "en", "b", 0), (None, None, "en", "b", 0)]
    mix = curriculum.curriculum(spark.createDataFrame(rows, DOCS)).collect()
    slots = Counter(r["slot"] for r in stored[0].where("doc_id is null and source = 'a'").collect())
    assert len(slots) > 300 and max(slots.values()) < 8
    own = [r for r in mix if r["source"] == "a"]
    assert len(mix) == 602 and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 20
