"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import chat, curriculum, decontamination, embedding_links, licenses, main_text, near_duplicates, nearest, prefix_trie, structure_repair, suffix_dedup, token_counts, toxicity
from tillroll.llm.scratch import ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(function):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(ready(spark), folder)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


@query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a test item that overlap."""
    return decontamination.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The class of every document, and whether it is the one that stays."""
    return near_duplicates.classes(table(spark, folder, "documents"))


@query
def op3_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of every conversation with its repaired role and its piece of the rendered text."""
    return chat.repaired(table(spark, folder, "conversations"))


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings that start in an earlier one."""
    return suffix_dedup.deduplicated(table(spark, folder, "documents"))


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    vocabulary = token_counts.read_vocabulary(public_tokenizers.path(VOCABULARY))
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary)


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; predicted tells on which side of 0.5 the score is."""
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.toxicity_scores(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "toxic",
    )


@query
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, folder, "pages")
    return main_text.main_text(pages, main_text.fit(pages))


@query
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses that documents state."""
    return licenses.licenses(table(spark, folder, "documents"))


@query
def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors found of every twentieth one."""
    return nearest.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op10_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of every document, range-sorted by its first training position."""
    mix = curriculum.curriculum(table(spark, folder, "documents"))
    first = F.round(F.try_element_at("positions", F.lit(1)), 9)
    return mix.select(
        "doc_id", "size", "source_size", "target", "taken", "copies", first.alias("position")
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


@query
def op11_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_links.embedding_links(table(spark, folder, "embeddings"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations with their subtree totals."""
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


@query
def op13_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    turns = table(spark, folder, "conversations")
    return structure_repair.structure_report(structure_repair.damaged(turns), turns)


SQL: dict[str, str] = {}


def _license_sql() -> str:
    rows = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in sorted(licenses.TEMPLATES.items())
    )
    words = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
    return f"""
WITH templates(license, text) AS (VALUES {rows}),
template_words AS (SELECT license, {words} AS w FROM templates),
wanted AS (
    SELECT DISTINCT license, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM template_words)
),
sizes AS (SELECT license, count(*) AS n FROM wanted GROUP BY license),
doc_words AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents WHERE text IS NOT NULL),
shingles AS (
    SELECT r, doc_id, i, array_to_string(w[i : i + 4], ' ') AS shingle
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words)
)
SELECT DISTINCT doc_id, s.license, round(CAST(count(DISTINCT s.shingle) AS DOUBLE) / max(n), 6) AS containment, min(i) AS first_word
FROM shingles s0 JOIN wanted s ON s0.shingle = s.shingle JOIN sizes z ON z.license = s.license
GROUP BY r, doc_id, s.license
HAVING round(CAST(count(DISTINCT s.shingle) AS DOUBLE) / max(n), 6) >= 0.8
"""


SQL["op8_license_scan"] = _license_sql()
SQL["op10_curriculum"] = r"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '/' || md5(coalesce(text, '')))) AS key,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
),
totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sized GROUP BY source
),
weighed AS (
    SELECT *, CAST([5.0, 2.0, 1.0][rank % 3 + 1] AS DOUBLE) AS weight, source_size * CAST(2 AS DOUBLE) AS cap FROM totals
),
levels AS (
    SELECT *, cap / weight AS cap_at,
           (sum(CAST(source_size AS DOUBLE)) OVER () * 1.5
            - (sum(cap) OVER (ORDER BY cap / weight, rank) - cap))
           / (sum(weight) OVER () - sum(weight) OVER (ORDER BY cap / weight, rank) + weight) AS level
    FROM weighed
),
targets AS (
    SELECT source, source_size, rank,
           round(least(cap, coalesce(weight * first_value(CASE WHEN level <= cap_at THEN level END IGNORE NULLS)
               OVER (ORDER BY cap_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), cap)), 6) AS target
    FROM levels
),
placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           CAST([0.5, 0.0, -0.5][t.rank % 3 + 1] AS DOUBLE) AS tilt,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size) - s.size AS start,
           CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS INTEGER) ELSE 0 END AS passes
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
taken AS (
    SELECT *, CASE WHEN size = 0 THEN 0
                   ELSE passes + CASE WHEN start + CAST(size AS DOUBLE) / 2 <= target - passes * source_size THEN 1 ELSE 0 END
              END AS copies,
           least(1.0, (start + CAST(size AS DOUBLE) / 2) / greatest(target, 1e-9)) AS share
    FROM placed
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies,
       CASE WHEN copies > 0
            THEN round(2 * share / ((1 - tilt) + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share)), 9) END AS position
FROM taken
"""

# The second engine has no crc32: bit by bit, over the digits of a number.
CRC32 = """(4294967295 - list_reduce([4294967295] || list_transform(string_split(CAST({} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
    lambda c, d: list_reduce([xor(c, d)] || [CAST(0 AS BIGINT) FOR i IN range(8)], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
SQL["op12_prefix_trie"] = rf"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS stem, {CRC32.format("conv_id")} % 4 AS open FROM turns GROUP BY conv_id
),
mixed AS (
    SELECT c.conv_id, 0 AS own, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.stem AND place <= open
    UNION ALL
    SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > open
),
placed AS (
    SELECT conv_id, md5(length(role) || ':' || role || text) AS step,
           len(regexp_extract_all(text, '[^ 	-
]+')) AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth
    FROM mixed
),
paths AS (
    SELECT conv_id, depth, words, md5(string_agg(step, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
           max(depth) OVER (PARTITION BY conv_id) AS length
    FROM placed
    UNION ALL
    SELECT conv_id, 0, 0, '', coalesce((SELECT max(depth) FROM placed p WHERE p.conv_id = c.conv_id), 0) FROM convs c
),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(CASE WHEN depth = length THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM paths GROUP BY node, depth
),
parents AS (
    SELECT n.node, a.node AS parent, a_node.conv_id AS parent_conv_id
    FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.depth = n.depth - 1 JOIN nodes a_node ON a_node.node = a.node
),
children AS (SELECT parent AS node, count(*) AS n_children FROM parents GROUP BY parent),
totals AS (
    SELECT a.node, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
    FROM nodes n JOIN paths a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.node = n.node
    GROUP BY a.node
)
SELECT CAST(n.conv_id AS BIGINT) AS conv_id, CAST(n.depth AS BIGINT) AS depth, CAST(p.parent_conv_id AS BIGINT) AS parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs, CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children,
       CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN parents p ON p.node = n.node LEFT JOIN children c ON c.node = n.node JOIN totals t ON t.node = n.node
"""
