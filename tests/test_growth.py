"""What grows with the tables: files of a stored fact, tasks that read small files, shuffle files that are kept."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll import session
from tillroll.sinks import tables
from tillroll.sources.raw import sorted_out


def lines(spark, orders):
    return spark.range(orders * 3).selectExpr("id div 3 AS order_id", "id % 3 AS product_id", "1 AS reordered")


def files_of(path):
    return list(Path(path).rglob("part-*.parquet"))


@pytest.fixture
def many_tasks(spark):
    """Tables of a test are joined into one task otherwise."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, held)


def test_a_small_block_is_one_file(spark, tmp_path, many_tasks):
    """As many files as blocks, and not blocks times tasks of them."""
    path = str(tmp_path / "fact")
    stored = tables.write_fact(lines(spark, 4000), path, orders_per_block=100)
    assert stored.count() == 12_000
    assert len(files_of(path)) == 40
    merged = tables.merge_into_fact(spark, path, lines(spark, 4000).where("order_id >= 2000").withColumn("reordered", F.lit(7)), 1999, orders_per_block=100)
    assert len(files_of(path)) == 60  # the touched blocks anew, beside the folders of the version before
    assert sorted((r.reordered, r["count"]) for r in merged.groupBy("reordered").count().collect()) == [(1, 6000), (7, 6000)]


def test_slices_lie_within_blocks(spark, tmp_path, many_tasks):
    """A large block is in several slices, a file in one block; orders below zero and null ones have their blocks too."""
    path = str(tmp_path / "fact")
    fct = lines(spark, 60_000).withColumn("order_id", F.col("order_id") - 30_000).unionByName(spark.sql("SELECT bigint(null) AS order_id, 1L AS product_id, 1 AS reordered"))
    stored = tables.write_fact(fct, path, orders_per_block=30_000)
    found = {r.order_block: (r.n, r.lo, r.hi) for r in stored.groupBy("order_block").agg(F.count("*").alias("n"), F.min("order_id").alias("lo"), F.max("order_id").alias("hi")).collect()}
    assert found == {-1: (90_000, -30_000, -1), 0: (90_000, 0, 29_999), None: (1, None, None)}
    assert 2 < len(files_of(path)) <= 7


def test_raw_text_of_rows_that_do_not_fit(spark):
    text = spark.createDataFrame([("1", "2", "3", "0", "f"), ("1", "x", None, "0", "f")], "order_id string, product_id string, add_to_cart_order string, reordered string, file string")
    good, bad = sorted_out(text, "order_products", keep=["file"]).orderBy("rejected").collect()
    assert (good.raw_text, good.problems, good.file) == (None, None, "f")
    assert bad.raw_text == '{"order_id":"1","product_id":"x","add_to_cart_order":null,"reordered":"0"}'


def test_small_files_share_a_task(spark, tmp_path):
    names = [*session.TASK_LIMITS, session.FIRST_PARTITIONS]
    held = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in session.TASK_LIMITS:
            spark.conf.unset(n)
        session.bound_tasks(spark)
        path = str(tmp_path / "small")
        spark.range(800).repartition(80).write.parquet(path)
        assert spark.read.parquet(path).rdd.getNumPartitions() <= 16  # two to a task before
    finally:
        for n, value in held.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_shuffle_files_go_with_their_step(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(name, None)

    def kept():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        found = set()
        while files.hasNext():
            found.add(files.next().getName())
        return {n for n in found if n.startswith("shuffle_")}

    try:
        spark.conf.unset(name)
        session.tune(spark)
        before = kept()
        tables.write_mart(lines(spark, 1000), str(tmp_path / "mart"), sort_by=["product_id"])
        until = time.time() + 20
        while kept() - before and time.time() < until:  # they are removed beside
            time.sleep(0.2)
        assert not kept() - before
    finally:
        spark.conf.unset(name) if held is None else spark.conf.set(name, held)
