"""Trained operators, the registered queries and the pipeline."""

import time
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import compare
import corpus_pipeline
from tillroll.llm import chat, curriculum, decontamination, licenses, main_text, near_duplicates, queries, suffix_dedup, token_counts, toxicity
from tillroll.llm.scratch import ready, written

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
needs_larger = pytest.mark.skipif(not Path(LARGER).exists(), reason="no test tables")

# Columns whose names the operators use themselves, and one more spelling of score.
ODD = "doc_id long, text string, lang string, source string, n_chars long, SCORE double, toxic string, node string, starts long, stays boolean"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties and repeated rows."""
    long = "palabra larga " * 20_000
    rows = [
        (1, "a clean text of some words that nobody minds at all", "en", "a", 51, 0.5, "x", "n", 1, True),
        (1, "a clean text of some words that nobody minds at all", "en", "a", 51, 0.5, "x", "n", 1, True),
        (2, None, None, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, None, None, None, None, False),
        (None, "a text without an id but with quite a few words of its own", "de", None, 58, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None, None),
        (4, long, "es", "b", len(long), None, None, None, None, None),
        (5, "*** !!! ***", "fr", "b", 11, None, None, None, None, None),
        (6, "a clean text of some words that nobody minds at all", "en", "c", 51, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="module")
def labelled(spark, odd):
    rows = [(i, f"{'nasty' if i % 2 else 'kindly'} words number {i} follow here", i % 2) for i in range(100, 220)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").withColumn("lang", F.lit("en"))
    labels = [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (1, 0, None), (100, 1, 0), (7777, 0, 1)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def rows_of(df):
    return sorted(map(str, df.collect()))


# --- toxicity -----------------------------------------------------------------


def test_gradients_learn_a_word_and_its_forms():
    texts = [f"some plain words and {'lowly' + str(i) if i % 2 else 'kind' + str(i)} more" for i in range(400)]
    labels = np.array([i % 2 for i in range(400)], float)
    model = toxicity.train(texts, labels)
    model = toxicity.calibrate(model, texts, labels, np.ones(400), ["en", None] * 200)
    unseen = pa.array(["a lowlyzz here", "a kindzz here", "", None])
    found = toxicity.scores(model, unseen)
    assert found[0] > 0.5 > found[1] and found[2] == found[3]


@needs_larger
def test_held_out_accuracy(spark):
    docs, labels = (queries.table(spark, LARGER, n) for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.toxicity_scores(docs.select("doc_id", "text", "lang"), model).join(labels.withColumnRenamed("toxic", "truth"), "doc_id")
    rows = scored.where(toxicity.held_out(F.col("doc_id"))).select("doc_id", "score", "truth").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    truth, guess = np.array([r["truth"] for r in rows]), np.array([r["score"] for r in rows]) >= 0.5
    assert (truth == guess).mean() > 0.97 and truth[guess].mean() > 0.9


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Words that only some of the rows beyond the first 2,500 of a label have; in one part and in several."""
    n = 12_000
    text = F.concat(F.lit("plain words here "), F.when(F.col("doc_id") % 2 == 1, F.lit("zorgle")).otherwise(F.lit("meadow")))
    docs = spark.range(n).select(F.col("id").alias("doc_id")).select("doc_id", text.alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    rank = {r.doc_id: i for y in (0, 1) for i, r in enumerate(labels.where((F.col("toxic") == y) & ~toxicity.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect())}
    late = spark.createDataFrame([(k,) for k, i in rank.items() if i >= 2500], "doc_id long").withColumn("late", F.lit(" blibber"))
    rare = F.when(F.col("late").isNotNull() & (F.col("doc_id") % 2 == 1), F.col("late")).otherwise(F.lit(""))
    docs = docs.join(late, "doc_id", "left").select("doc_id", F.when(rare != "", F.lit("plain words here blibber")).otherwise(F.col("text")).alias("text"), "lang")
    for rows in (1 << 20, 2000):
        monkeypatch.setattr(toxicity, "PART_ROWS", rows)
        model = toxicity.fit(docs, labels)
        found = toxicity.scores(model, pa.array(["plain words here blibber", "plain words here meadow"]))
        assert found[0] > 0.5 > found[1]


def test_passes_over_parts_shuffle_no_text(spark):
    """Texts move once, into parts; what a pass shuffles are the parts' parameters."""
    text = F.concat_ws(" ", F.lit("some words"), "id")
    rows = spark.range(300).select(F.xxhash64("id").alias("at"), text.alias("text"), F.lit("en").alias("lang"), (F.col("id") % 2).cast("double").alias("label"))
    dealt = toxicity.dealt_out(rows, 5)
    assert sorted(dealt.select("at", "text", "label").collect()) == sorted(rows.select("at", "text", "label").collect())

    def texts(part: pa.Table) -> pa.Table:
        return pa.table({"part": part.column("part")[:1], "n": [part.num_rows], "parts": [len(part.column("part").unique())]})

    learned = dealt.groupBy("part").applyInArrow(texts, "part long, n long, parts long")
    found = learned.collect()
    assert sorted(r["part"] for r in found) == list(range(5)) and {r["parts"] for r in found} == {1} and sum(r["n"] for r in found) == 300
    assert "Exchange" not in learned._jdf.queryExecution().executedPlan().toString()


def test_toxicity_of_odd_rows(spark, odd, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    scored = toxicity.toxicity_scores(odd, model)
    assert scored.columns == [*odd.columns, "_score", "_toxic"]
    assert scored.count() == odd.count() and all(0 <= r["_score"] <= 1 for r in scored.collect())
    assert toxicity.without_toxic(odd, model).columns == odd.columns
    nothing = toxicity.fit(docs, labels.limit(0))
    assert {r["_score"] for r in toxicity.toxicity_scores(odd, nothing).collect()} == {0.0}
    assert toxicity.toxicity_scores(odd.limit(0), model).count() == 0


# --- main text ----------------------------------------------------------------


def test_blocks_of_untidy_markup():
    page = (
        "<html><body><!-- <p>no</p> --><script>var t='</p>';</script><nav><a href='/a>b'>Menu</a></nav>"
        "<div class='ad'>Buy</div><article><p><b>One &amp; two<br>three<p>Four\n  five</article><ul><li>x<li>y"
    )
    found = main_text.blocks(page)
    assert [b.text for b in found] == ["Menu", "Buy", "One & two three", "Four five", "x", "y"]
    assert found[1].path == ("html", "body", "div", "class=ad") and found[5].path == ("html", "body", "ul", "li")
    assert [main_text.own_label(b.path) for b in found] == [False, False, True, True, None, None]
    assert main_text.blocks("") == [] and main_text.blocks("<p>") == [] and main_text.blocks("a < b")[0].text == "a < b"


def test_blocks_keep_what_icons_and_formulas_stand_before():
    page = (
        "<header><svg viewBox='0 0 1 1'/><svg><text>no</text></svg></header><math/><article><p>Let <math><mi>x</mi></math> be"
        "<object data='a'>in place of a</object><noscript><p>without scripts</p></noscript><p>end</article><svg class=\"a\" />last"
    )
    assert [b.text for b in main_text.blocks(page)] == ["Let x be", "in place of a", "without scripts", "end", "last"]


@needs_tables
def test_labeller_on_known_and_disguised_pages():
    pages = [main_text.blocks(h) for h in pq.read_table(f"{SMALL}/pages.parquet").column("html").to_pylist()]
    known = [(p, [main_text.own_label(b.path) is True for b in p]) for p in pages]
    rng, phrases = np.random.default_rng(0), [b.text for p in pages for b in p]
    half = len(known) // 2
    learn = known[:half] + [main_text.disguised(p, y, phrases, rng) for p, y in known[:half] for _ in range(4)]
    model = main_text.train([p for p, _ in learn], [y for _, y in learn], epochs=8)
    for sample, least in ((known[half:], 0.999), ([main_text.disguised(p, y, phrases, rng) for p, y in known[half:]], 0.97)):
        found = main_text.label(model, [p for p, _ in sample])
        assert np.mean(np.concatenate([f == np.array(y) for f, (_, y) in zip(found, sample)])) >= least


ONE = "The old mill by the river was rebuilt after the flood, and people came from far away to see it turn again."
TWO = "Its wheel, made of oak, weighs more than two tons and was lifted with ropes by forty men from the village."
THREE = "On market days the miller opens the doors and explains how grain becomes flour, which children like best."
# Pages written by hand: markup, and the blocks of main text in it.
WRITTEN = {
    "kinds of blocks": (
        f"<html><head><title>Mill</title></head><body><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav><article><h1>The old mill</h1>"
        f"<p>{ONE}</p><p>{TWO}</p><p>{THREE}</p><h2>Prices</h2><ul><li>Bread, two coins<li>Flour, one coin</ul><table><tr><td>Monday</td><td>closed</td></tr>"
        f"</table><pre>turn(wheel, 3)</pre><blockquote>Water never sleeps, said the miller.</blockquote><figure><img src=a><figcaption>The wheel at dusk"
        f"</figcaption></figure><p>{ONE}</p></article><footer>Copyright 2020 The Mill</footer></body></html>",
        ["The old mill", ONE, TWO, THREE, "Prices", "Bread, two coins", "Flour, one coin", "Monday", "closed", "turn(wheel, 3)",
         "Water never sleeps, said the miller.", "The wheel at dusk", ONE],
    ),
    "a container named like a widget": (
        f"<html><body><header><a href=/>Logo</a></header><article><div class='elementor-widget'><h1>The old mill</h1><p>{ONE}</p><p>{TWO}</p></div></article>"
        "<footer><p>All rights reserved.</p></footer></body></html>",
        ["The old mill", ONE, TWO],
    ),
    "a title in a container named like a header": (
        f"<html><body><div class=menu><a href=/>Home</a></div><article><div class='post-header'><h1>The old mill</h1></div><p>{ONE}</p><p>{TWO}</p></article>"
        "<div class=footer>Imprint</div></body></html>",
        ["The old mill", ONE, TWO],
    ),
    "no article": (
        f"<html><body><nav><a href=/>Home</a></nav><div class=content><h1>The old mill</h1><p>{ONE}</p><p>{TWO}</p><p>{THREE}</p></div><footer>Imprint</footer></body></html>",
        ["The old mill", ONE, TWO, THREE],
    ),
    "an article's own header": (
        f"<html><body><nav><a href=/>Home</a></nav><article><header><h1>The old mill</h1></header><p>{ONE}</p><p>{TWO}</p></article><footer>Imprint</footer></body></html>",
        ["The old mill", ONE, TWO],
    ),
    "everything that is no main text": (
        "<html><head><style>p{}</style><script>x()</script></head><body><header><h2>Mill Times</h2><nav><ul><li><a href=/a>Home</a><li><a href=/b>Sport</a></ul></nav>"
        "</header><div class='cookie-notice'><p>We use cookies to make this page better for you, please accept them.</p><button>Accept</button></div><main><article>"
        f"<h1>The old mill</h1><p>{ONE}</p><div class=ad>Buy cheap flour now!</div><p>{TWO}</p><ul><li>Oak wheel<li>Stone walls</ul><p>{THREE}</p></article></main>"
        "<aside><h3>Popular</h3><ul><li><a href=/1>Ten bakeries you must see</a><li><a href=/2>Bread of the year</a></ul></aside><section class=comments><h3>Comments"
        "</h3><div class=comment><p>I was there last week and it was wonderful, my children loved it.</p></div><div class=comment><p>Too many people.</p></div></section>"
        "<form><label>Your name</label><button>Send</button></form><footer><p>Copyright</p><ul><li><a href=/i>Imprint</a></ul></footer></body></html>",
        ["The old mill", ONE, TWO, "Oak wheel", "Stone walls", THREE],
    ),
}


@pytest.fixture(scope="module")
def labeller(spark):
    return main_text.fit(queries.table(spark, SMALL, "pages"))


@needs_tables
def test_pages_written_by_hand(spark, labeller):
    table = spark.createDataFrame([(i, name, page) for i, (name, (page, _)) in enumerate(WRITTEN.items())], "page_id long, url string, html string")
    found = {r["url"]: r["text"] for r in main_text.main_text(table, labeller).collect()}
    assert found == {name: "\n".join(text) for name, (_, text) in WRITTEN.items()}


@needs_tables
def test_long_pages_take_little_memory(labeller):
    """A page of 60,000 blocks beside short ones."""
    pages = [main_text.blocks("<article>" + "<p>text of a cell</p>" * 60_000 + "</article>")] + [main_text.blocks(p) for p, _ in WRITTEN.values()] * 10
    tracemalloc.start()
    found = main_text.label(labeller, pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[0].mean() > 0.99 and [len(f) for f in found] == [len(p) for p in pages] and peak < 500 << 20


def test_doubtful_parts_of_an_article_are_not_learnt_from():
    page = main_text.blocks("<nav>a</nav><article><header><h1>b</h1></header><p>c</p><div class=share>d</div><form>e</form></article><p>f</p><aside><article>g</article></aside>")
    assert [b.text for b in page] == list("abcdefg") and main_text.taught(page) == [0, 0.5, 1, 0.5, 0, 0, 0]


def test_lstm_gradients():
    """Against differences of the loss."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4, 2, 5))
    there = np.array([[1, 1], [1, 1], [1, 0], [1, 0]], bool)
    h = main_text.HIDDEN
    w, u, b = rng.normal(0, 0.3, (5, 4 * h)), rng.normal(0, 0.3, (h, 4 * h)), rng.normal(0, 0.3, 4 * h)
    pull = rng.normal(size=(4, 2, h)) * there[:, :, None]
    loss = lambda: float((main_text.forward(x, there, w, u, b)[0] * pull).sum())
    grads = main_text.backward(x, there, u, main_text.forward(x, there, w, u, b)[1], pull)
    for p, g in zip((w, u, b), grads):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(6)]:
            p[at] += 1e-3
            high = loss()
            p[at] -= 2e-3
            slope = (high - loss()) / 2e-3
            p[at] += 1e-3
            assert abs(slope - g[at]) < 2e-3 * max(1, abs(slope))


def test_main_text_of_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>text</p></article>"), (3, "w", "<p>" + "long " * 50_000), (3, "w", "plain")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = main_text.main_text(pages, None).collect()
    assert len(found) == 5 and {r["page_id"]: r["text"] for r in found}[None] == "text"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert main_text.fit(pages.limit(0)) is None and main_text.main_text(pages.limit(0), None).count() == 0


# --- odd rows through the other operators -------------------------------------


def test_odd_rows_everywhere(spark, odd):
    benchmark = spark.createDataFrame(
        [(1, "a clean text of some words that nobody minds at all"), (None, None), (2, ""), (2, "short")], "item_id long, text string"
    )
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(odd, benchmark).collect()} == {(1, 1), (6, 1)}
    kept = decontamination.without_benchmark(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == 6
    assert decontamination.without_benchmark(odd, benchmark.limit(0)).count() == odd.count()

    classes = near_duplicates.classes(odd)
    assert classes.count() == odd.count()
    assert {r["doc_id"]: r["class_id"] for r in classes.collect() if r["doc_id"]} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 1}
    single = near_duplicates.without_near_duplicates(odd)
    assert single.columns == odd.columns and {r["doc_id"] for r in single.collect()} == {None, 1, 2, 3, 4, 5}

    removed = {r["doc_id"]: r for r in suffix_dedup.deduplicated(odd).collect() if r["doc_id"]}
    assert removed[6]["n_removed"] == removed[6]["n_bytes"] == 51 and removed[1]["n_removed"] == removed[4]["n_removed"] == 0
    cleaned = suffix_dedup.without_repeats(odd)
    assert cleaned.schema == odd.schema and cleaned.count() == odd.count()

    mix = curriculum.curriculum(odd)
    assert mix.count() == odd.count()
    vocabulary = token_counts.read_vocabulary(queries.public_tokenizers.path(queries.VOCABULARY))
    assert token_counts.token_counts(odd, vocabulary).count() == odd.count()
    assert licenses.licenses(odd).count() == 0
    for empty in (
        decontamination.overlaps(odd.limit(0), benchmark), near_duplicates.classes(odd.limit(0)), suffix_dedup.deduplicated(odd.limit(0)),
        curriculum.curriculum(odd.limit(0)), token_counts.token_counts(odd.limit(0), vocabulary), licenses.licenses(odd.limit(0)),
    ):
        assert empty.count() == 0


def test_rows_without_an_id_go_one_by_one(spark):
    """Only the duplicate or contaminated rows without an id go, and one row of a class without ids stays."""
    many = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcd"}
    rows = [(1, many["a"]), (None, many["a"]), (None, many["b"]), (None, many["c"]), (None, many["c"]), (None, many["c"] + " more")]
    rows += [(None, ""), (None, None), (2, many["d"]), (2, many["a"])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, extra string")
    classes = near_duplicates.classes(docs)
    assert classes.count() == len(rows) and classes.where("stays").count() == 6
    kept = near_duplicates.without_near_duplicates(docs)
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert kept.columns == docs.columns and sum((t or "").startswith("c0") for _, t in found) == 1
    others = [f for f in found if not (f[1] or "").startswith("c0")]
    assert sorted(others, key=str) == sorted([(1, many["a"]), (None, many["b"]), (None, ""), (None, None), (2, many["d"])], key=str)

    benchmark = spark.createDataFrame([(1, many["a"])], "item_id long, text string")
    clean = [(r["doc_id"], r["text"]) for r in decontamination.without_benchmark(docs, benchmark).collect()]
    assert sorted(clean, key=str) == sorted([r for r in rows if r[1] != many["a"]], key=str)


def test_odd_turns(spark):
    rows = [(None, None, None, None), (1, 2, "user", ""), (1, 2, "user", ""), (1, None, "USER ", None), (2, 1, "weird", "x" * 200_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1))
    assert chat.repaired(turns).count() == 5


# --- queries and pipeline -----------------------------------------------------


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_like_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    assert compare.differences(df, compare.connect(SMALL), queries.SQL[name]) == []


def test_every_query_is_registered():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n in queries.QUERIES) == list(range(1, 14))
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run


def test_stages_keep_columns_and_clean_rows(spark, odd, tmp_path, labelled):
    """On odd rows, with the other tables of the folder present."""
    docs, labels = labelled
    benchmark = spark.createDataFrame([(1, "nothing that any of these documents holds in any place at all")], "item_id long, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    table = odd.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        docs.withColumns({"source": F.lit("z"), "n_chars": F.length("text").cast("long")})
    )
    toxic = {r["doc_id"] for r in docs.where("text like 'nasty%'").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table.write.parquet(str(tmp_path / name))
        before = spark.read.parquet(str(tmp_path / name))
        table = stage(spark, before, str(tmp_path))
        assert table.columns == before.columns
    ids = {r["doc_id"] for r in table.collect()}
    # The toy labels know two words, so what they say of other words is left open.
    assert {2, 3} <= ids and 6 not in ids
    assert len(ids & toxic) <= 3
    last = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path))
    assert last.count() == table.count()


@needs_tables
def test_pipeline_runs_all_stages(spark):
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(found) < queries.table(spark, SMALL, "documents").count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "suffix-array", "decontamination", "mix"]


def test_shuffle_files_go_with_their_step(spark):
    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())

    def shuffled():
        return {f.name for folder in folders for f in Path(folder).rglob("shuffle_*.data")}

    before = shuffled()
    once = written(ready(spark).range(100_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    until = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    frame = once.groupBy("count").agg(F.sum("k").alias("k"))
    assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, frame.collect())) == [(14285, 11), (14286, 10)]
