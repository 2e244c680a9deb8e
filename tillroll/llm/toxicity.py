"""Toxicity: a convolutional text classifier, trained in numpy.

A word's embedding is the sum of the hashed embeddings of the word and of its first few bytes, so
inflected and compound forms share what their stems have learned. Filters of several widths slide
over them, each keeps its largest response in the whole text (max pooling), and a logistic layer
turns those into a score. A last
step rescales the score on rows kept apart, so that 0.5 is where either label is as likely, and
finds a threshold per language there.

Training takes every labelled row that `learnable` lets through. Rows are dealt into parts by their id, a task learns
from one part in turn, and after each pass the parts' parameters are averaged, a word's embedding over the parts that
have the word. Texts are dealt into parts once; every pass reads them where they lie. Scores are rescaled, and
thresholds set, by the counts of all rows kept apart. Language, source and id are no inputs of a score.

Defined cases: a null or empty text is scored as one without words and never called toxic; languages without a threshold
of their own, null too, use the common one; null labels are left out, and of several labels of one
document the highest counts; repeated rows are scored each; an empty table gives an empty result;
without labels of both kinds every score is the share of label 1 (0 if there are none).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tillroll.llm.arrays import slices, words
from tillroll.llm.scratch import written
from tillroll.session import scratch_dir
from tillroll.sinks.buckets import write_bucketed

BUCKETS = 1 << 15
PREFIXES = (4, 5, 6)
EMBEDDING = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
# Labels with more rows than this weigh alike in training, up to a weight of MAX_WEIGHT a row.
ALIKE_FROM = 2500
MAX_WEIGHT = 10.0
# A part of the rows that one task learns from, and passes over all parts if there are several.
PART_ROWS = 16_384
PART_CHARS = 1 << 26
PASSES = 3
# Buckets a part, so that few parts share a task.
BUCKETS_PER_PART = 4
EPOCHS = 6
BATCH = 32
RATE = 0.01
DECAY = 1e-4
WORD_DROPOUT = 0.2
MIN_FOR_THRESHOLD = 30


@dataclass
class Model:
    """table: responses of each bucket, FILTERS columns for every place of every width."""

    table: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    scale: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None
    threshold: float = 0.5
    thresholds: dict[str, float] = field(default_factory=dict)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and their stems, each text followed by padding, and the texts' first places."""
    found = words(column, PREFIXES)
    pad = max(WIDTHS)
    n = len(found.rows) - 1
    counts = np.diff(found.rows)
    starts = found.rows[:-1] + pad * np.arange(n)
    laid = np.full((1 + len(PREFIXES), len(found.hashes) + pad * n), BUCKETS, np.int32)
    at = np.arange(len(found.hashes)) + pad * np.repeat(np.arange(n), counts)
    for row, hashes in zip(laid, [found.hashes, *found.prefixes]):
        row[at] = (hashes % np.uint64(BUCKETS)).astype(np.int32)
    return laid, starts


def pooled(model: Model, laid: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest response of every filter in every text."""
    responses = model.table[laid[0]]
    for row in laid[1:]:
        responses += model.table[row]
    size, column, columns = len(responses), 0, []
    for width in WIDTHS:
        response = responses[:, column : column + FILTERS]
        for k in range(1, width):
            low = column + k * FILTERS
            response[: size - k] += responses[k:, low : low + FILTERS]
        column += width * FILTERS
        columns.append(np.maximum.reduceat(response, starts, axis=0))
    return np.maximum(np.concatenate(columns, axis=1) + model.bias, 0)


def raw_scores(model: Model, column: pa.Array) -> np.ndarray:
    if model.constant is not None or not len(column):
        return np.zeros(len(column))
    return pooled(model, *tokens(column)) @ model.weights + model.offset


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scores(model: Model, column: pa.Array) -> np.ndarray:
    """Scores in 0..1 of a column of texts."""
    if model.constant is not None:
        return np.full(len(column), model.constant)
    a, b = model.scale
    return sigmoid(a * raw_scores(model, column).astype(float) + b)


def unlearned_parameters(rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = {
        "e": rng.normal(0, 0.3, (BUCKETS + 1, EMBEDDING)),
        "v": rng.normal(0, 0.3, len(WIDTHS) * FILTERS),
        "b": np.zeros(len(WIDTHS) * FILTERS),
        "o": np.zeros(1),
        **{f"w{w}": rng.normal(0, 0.5 / np.sqrt(w), (w, EMBEDDING, FILTERS)) for w in WIDTHS},
    }
    p = {k: x.astype(np.float32) for k, x in p.items()}
    p["e"][BUCKETS] = 0
    return p


def model_of(p: dict[str, np.ndarray]) -> Model:
    table = np.concatenate([p["e"] @ p[f"w{w}"][k] for w in WIDTHS for k in range(w)], axis=1).astype(np.float32)
    return Model(table, p["b"], p["v"], float(p["o"][0]))


def train(texts: list[str], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    rng = np.random.default_rng(seed)
    p = unlearned_parameters(rng)
    learn(p, rng, texts, labels, np.ones(len(labels)), epochs)
    return model_of(p)


def learn(
    p: dict[str, np.ndarray], rng: np.random.Generator, texts: list[str], labels: np.ndarray, weights: np.ndarray, epochs: int
) -> np.ndarray:
    """Fit embeddings, filters and the last layer with Adam; only the pooled places pass gradients back.

    Changes the parameters and gives back how many texts have each bucket.
    """
    first, second = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    seen = np.zeros(BUCKETS + 1, np.float32)
    docs = []
    for text in texts:
        laid, _ = tokens(pa.array([text], pa.string()))
        docs.append(laid)
        seen[np.unique(laid)] += 1
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            laid = np.concatenate([docs[i] for i in chosen], axis=1)
            laid = np.where(rng.random(laid.shape) < WORD_DROPOUT, BUCKETS, laid)
            sizes = np.array([docs[i].shape[1] for i in chosen])
            ends = np.cumsum(sizes)
            vectors = p["e"][laid].sum(0)
            size = len(vectors)
            maxima, places = [], []
            for w in WIDTHS:
                response = vectors @ p[f"w{w}"][0]
                for k in range(1, w):
                    response[: size - k] += vectors[k:] @ p[f"w{w}"][k]
                # The places of one text start a filter; its padding ends it.
                at = np.stack([e - n + response[e - n : max(e - max(WIDTHS), e - n + 1)].argmax(0) for e, n in zip(ends, sizes)])
                places.append(at)
                maxima.append(np.take_along_axis(response, at, 0))
            z = np.concatenate(maxima, 1) + p["b"]
            active = np.maximum(z, 0)
            error = weights[chosen] * (sigmoid(active @ p["v"] + p["o"][0]) - labels[chosen]) / len(chosen)
            g = {k: np.zeros_like(x) for k, x in p.items()}
            g["v"], g["o"][0] = active.T @ error, error.sum()
            back = (error[:, None] * p["v"]) * (z > 0)
            g["b"] = back.sum(0)
            for j, w in enumerate(WIDTHS):
                part = back[:, j * FILTERS : (j + 1) * FILTERS].astype(np.float32)
                for k in range(w):
                    place = np.minimum(places[j] + k, size - 1)
                    g[f"w{w}"][k] = np.einsum("df,dfe->ef", part, vectors[place])
                    pull = (part[:, :, None] * p[f"w{w}"][k].T[None]).reshape(-1, EMBEDDING)
                    for row in laid:
                        np.add.at(g["e"], row[place].ravel(), pull)
            g["e"][BUCKETS] = 0
            step += 1
            for k in p:
                grad = g[k] + DECAY * p[k]
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                p[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            p["e"][BUCKETS] = 0
    return seen


def best_threshold(z: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The raw score with the fewest weighted errors from there on, half-way between two rows' scores."""
    order = np.argsort(-z, kind="stable")
    gain = np.cumsum(np.where(label[order] == 1, weight[order], -weight[order]))
    last = np.append(z[order][1:] != z[order][:-1], True)
    gain = np.where(last, gain, -np.inf)
    at = int(np.argmax(gain))
    if gain[at] <= 0:
        return float(z.max() + 1)
    following = z[order][at + 1] if at + 1 < len(z) else z[order][at] - 2
    return float((z[order][at] + following) / 2)


def calibrate(model: Model, found: list[str] | np.ndarray, labels: np.ndarray, weights: np.ndarray, langs: list[str | None]) -> Model:
    """Rescale scores by logistic regression on rows kept apart, centred where errors are fewest; then a threshold per language.

    found: their texts or raw scores; a weight is a number of rows.
    """
    z = found if isinstance(found, np.ndarray) else raw_scores(model, pa.array(found, pa.string())).astype(float)
    a, b = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(a * z + b)
        d = weights * (p - labels)
        s = weights * p * (1 - p)
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-3]])
        move = np.linalg.solve(h, np.array([(d * z).sum() + 1e-3 * (a - 1), d.sum() + 1e-3 * b]))
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    a = max(a, 1e-3)
    model.scale = (float(a), float(-a * best_threshold(z, labels, weights)))
    langs = np.array([x or "" for x in langs])
    for lang in sorted(set(langs) - {""}):
        own = langs == lang
        if (labels * weights)[own].sum() >= MIN_FOR_THRESHOLD:
            limit = sigmoid(np.array([model.scale[0] * best_threshold(z[own], labels[own], weights[own]) + model.scale[1]]))[0]
            model.thresholds[str(lang)] = float(np.clip(limit, 0.05, 0.95))
    return model


def averaged(parts: list[tuple[dict, np.ndarray, float]]) -> tuple[dict, np.ndarray, float]:
    """Parameters over several parts, by their rows; embeddings by the texts that have them."""
    rows = sum(n for _, _, n in parts)
    p = {k: sum(q[k] * np.float32(n / rows) for q, _, n in parts) for k in parts[0][0] if k != "e"}
    seen = sum(s for _, s, _ in parts)
    p["e"] = sum(q["e"] * np.where(seen > 0, s / np.maximum(seen, 1), n / rows)[:, None].astype(np.float32) for q, s, n in parts)
    return p, seen, rows


def fit(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, label: str = "toxic") -> Model:
    """Train on all labelled documents; no task holds more than one part of them, and the driver holds parameters only."""
    known = labels.select("doc_id", F.col(label).alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.where(~held_out(F.col("doc_id")) if learnable is None else learnable)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0, constant=float(1 in counts))
    at = F.xxhash64("doc_id")
    rows = docs.select("doc_id", "text", "lang").join(known, "doc_id").dropDuplicates(["doc_id"])
    rows = rows.select(at.alias("at"), F.coalesce("text", F.lit("")).alias("text"), "lang", F.col("label").cast("double").alias("label"))
    rows = written(rows.withColumn("apart", F.pmod(F.shiftright("at", 20), F.lit(4)) == 3), "labelled")
    sizes = rows.groupBy("label", "apart").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()
    if len({r["label"] for r in sizes}) < 2:
        return unlearned(counts)
    if len(sizes) == 4:
        learned, kept = rows.where("not apart"), rows.where("apart")
        sizes = [r for r in sizes if not r["apart"]]
    else:  # too few rows of a kind to keep some apart
        learned = kept = rows
    per_label = {y: sum(r["n"] for r in sizes if r["label"] == y) for y in (0.0, 1.0)}
    n, chars = sum(per_label.values()), sum(r["chars"] for r in sizes)
    p = trained(learned, per_label, max(-(-n // PART_ROWS), -(-chars // PART_CHARS)))
    model = model_of(p)
    z = binned(kept, model)
    columns = ([float(r["z"]) for r in z], [r["label"] for r in z], [float(r["n"]) for r in z])
    return calibrate(model, *[np.array(c) for c in columns], [r["lang"] for r in z])


def dealt_out(rows: DataFrame, parts: int) -> DataFrame:
    """The rows by part. Several parts are stored in buckets, so that a pass over them shuffles no text."""
    dealt = rows.select(F.pmod("at", F.lit(parts)).alias("part"), "at", "text", "label")
    if parts == 1:
        return dealt
    path = scratch_dir(rows.sparkSession, "parts")
    return write_bucketed(dealt, path, "part", parts * BUCKETS_PER_PART, compression="zstd")


def trained(rows: DataFrame, per_label: dict[float, int], parts: int, seed: int = 7) -> dict[str, np.ndarray]:
    """The parameters after all passes. A part is learned in one task; averages are made in tasks, the driver gets the square root of them."""
    spark = rows.sparkSession
    rng = np.random.default_rng(seed)
    p = unlearned_parameters(rng)
    share = {y: min(n, ALIKE_FROM) / n for y, n in per_label.items()}
    level = sum(per_label.values()) / sum(share[y] * n for y, n in per_label.items())
    weight = {y: min(share[y] * level, MAX_WEIGHT) for y in per_label}
    groups = int(np.ceil(np.sqrt(parts)))
    dealt = dealt_out(rows, parts)
    for turn in range(1 if parts == 1 else PASSES):
        shared = spark.sparkContext.broadcast((p, rng))

        def learn_part(table: pa.Table) -> pa.Table:
            start, random = pickle.loads(pickle.dumps(shared.value))
            table = table.sort_by([("at", "ascending"), ("text", "ascending")])
            part = table.column("part")[0].as_py()
            if parts > 1:
                random = np.random.default_rng([seed, turn, part])
            y = table.column("label").to_numpy().astype(float)
            weights = np.where(y == 1, weight[1.0], weight[0.0])
            seen = learn(start, random, table.column("text").to_pylist(), y, weights, EPOCHS if parts == 1 else 1)
            return pa.table({"part": [part % groups], "model": pa.array([pickle.dumps((start, seen, float(len(y))))], pa.binary())})

        def average(table: pa.Table) -> pa.Table:
            found = averaged([pickle.loads(m) for m in table.column("model").to_pylist()])
            return pa.table({"part": [table.column("part")[0].as_py()], "model": pa.array([pickle.dumps(found)], pa.binary())})

        made = dealt.groupBy("part").applyInArrow(learn_part, "part long, model binary")
        made = made.groupBy("part").applyInArrow(average, "part long, model binary")
        held = sorted(made.collect(), key=lambda r: r["part"])
        p = averaged([pickle.loads(r["model"]) for r in held])[0]
        shared.unpersist()
    return p


def binned(rows: DataFrame, model: Model) -> list[Row]:
    """How many rows have each raw score, to a thousandth, label and language; languages with few rows of label 1 are one."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                z = np.round(raw_scores(shared.value, part.column("text")).astype(float), 3)
                yield pa.RecordBatch.from_arrays([pa.array(z), part.column("label"), part.column("lang")], ["z", "label", "lang"])

    found = rows.select("text", "label", "lang").mapInArrow(score, "z double, label double, lang string")
    counted = found.groupBy("lang", "label", "z").agg(F.count(F.lit(1)).alias("n"))
    toxic = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).over(Window.partitionBy("lang"))
    own = counted.withColumn("toxic", toxic).withColumn("lang", F.when(F.col("toxic") >= MIN_FOR_THRESHOLD, F.col("lang")))
    return own.groupBy("lang", "label", "z").agg(F.sum("n").alias("n")).orderBy("z", "label", "lang").collect()


def unlearned(counts: dict[int, int]) -> Model:
    """Without texts of both kinds: every score is the share of label 1."""
    return Model(np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0, constant=counts.get(1, 0) / max(sum(counts.values()), 1))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a score and `toxic`, whether it reaches their language's threshold."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    score, toxic = fresh_names(docs, "score", "toxic")
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType()), StructField(toxic, BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = scores(m, part.column("text"))
                limits = np.array([m.thresholds.get(x, m.threshold) for x in part.column("lang").to_pylist()])
                some = np.array([bool(t) and not t.isspace() for t in part.column("text").to_pylist()], bool)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found), pa.array((found >= limits) & some)], [*part.schema.names, score, toxic]
                )

    return docs.mapInArrow(run, schema)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put in front where the table has them."""
    taken = {c.lower() for c in df.columns}
    result = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        result.append(name)
    return result


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns only."""
    scored = toxicity_scores(docs, model)
    return scored.where(~F.col(scored.columns[-1])).select(*docs.columns)
