"""The corpus pipeline: documents through the filtering stages to the training mix.

Every stage is a function of (session, documents so far, folder); it is written as Parquet and
read again before the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import curriculum, decontamination, near_duplicates, suffix_dedup, toxicity
from tillroll.llm.queries import table
from tillroll.llm.scratch import ready, written


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    ready(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ready(spark)
    return near_duplicates.without_near_duplicates(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the strings that start in an earlier document."""
    ready(spark)
    return suffix_dedup.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the documents that overlap with a test item."""
    return decontamination.without_benchmark(docs, table(ready(spark), folder, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Words taken of every document and its training positions, in order of the first one."""
    ready(spark)
    first = F.try_element_at("positions", F.lit(1))
    return curriculum.curriculum(docs).orderBy(first.asc_nulls_last(), "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("suffix-array", drop_repeats),
    ("decontamination", drop_contaminated),
    ("mix", mix_sources),
]

# Training a classifier and weighted sampling are beyond SQL; tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
