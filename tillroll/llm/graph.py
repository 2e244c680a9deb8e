"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written


def renamed(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges between the labels of their ends, each once, without loops. A node without a label is its own."""
    for end in ("a", "b"):
        to = labels.select(F.col("node").alias(end), F.col("component").alias("to"))
        edges = edges.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return (
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; edges are (a, b) in any direction.

    Nodes should be hashes: each round every node gives way to the least of itself and its
    neighbours, and edges are drawn anew between those that stay. With ids in no order, stars go in
    one round and chains shrink by a share per round. A round's edges are written, so lineage stays
    short and rounds get smaller; nothing but whether edges are left reaches the driver.
    """
    edges = written(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", slim=True)
    found, turn = None, 0
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        step = written(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("component")), "labels", slim=True)
        found, turn = step if found is None else composed(found, step), turn + 1
        if turn % 4 == 0:
            found = written(found, "labels", slim=True)
        edges = written(renamed(edges, step), "edges", slim=True)
        if not edges.limit(1).count():
            return found


def composed(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels of labels: more says what became of the labels and adds nodes of its own."""
    then = more.select(F.col("node").alias("component"), F.col("component").alias("next"))
    known = labels.join(then, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return known.unionByName(more.join(labels.select("node"), "node", "left_anti"))
