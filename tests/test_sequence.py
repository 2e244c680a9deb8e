import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import LINES, day
from tillroll.operators.numbering import number_in_blocks, number_rows
from tillroll.operators.sequence import derive_order_sequence, derive_reordered, order_blocks


@pytest.fixture(scope="module")
def skewed(spark):
    """User 1 holds a third of all orders, many of them on one day."""
    rng = random.Random(7)
    rows = []
    for order_id in range(1, 601):
        hot = order_id % 3 == 0
        user = 1 if hot else rng.randint(2, 80)
        when = day(3) if hot and rng.random() < 0.5 else day(rng.randint(0, 60))
        rows.append((order_id, user, when))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "order_id long, user_id long, order_date date")


def plain_sequence(orders):
    w = Window.partitionBy("user_id").orderBy("order_date", "order_id")
    return orders.select(
        "*",
        F.row_number().over(w).alias("order_number"),
        F.datediff("order_date", F.lag("order_date").over(w)).alias("days_since_prior_order"),
    )


def test_parts_equal_one_window(skewed):
    assert sorted(derive_order_sequence(skewed).collect()) == sorted(plain_sequence(skewed).collect())


def test_blocks_equal_one_window(spark):
    """Null keys and dates, and a key whose rows lie in many blocks, one of them large."""
    df = spark.sql(
        "SELECT CASE WHEN id % 3 = 0 THEN NULL ELSE id % 5 END AS user_id, CASE WHEN id % 11 > 0 THEN DATE '2024-01-01' + CAST(id % 7 AS INT) END AS order_date, "
        "id * 300007 AS order_id FROM range(5000)"
    )
    out = number_in_blocks(df, "user_id", order_blocks(), ["order_date", "order_id"], "n", carry="order_date", previous="before")
    w = Window.partitionBy("user_id").orderBy("order_date", "order_id")
    plain = df.select("*", F.row_number().over(w).alias("n"), F.lag("order_date").over(w).alias("before"))
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0 and out.count() == 5000


def test_number_rows_without_carry(spark):
    df = spark.createDataFrame([(1, i // 4, i) for i in range(20)] + [(2, 0, 5)], "k long, a long, b long")
    out = number_rows(df, "k", ["a", "b"], "pos").collect()
    assert sorted((r.k, r.b, r.pos) for r in out) == [(1, i, i + 1) for i in range(20)] + [(2, 5, 1)]


@pytest.mark.parametrize(
    "rows",
    [
        # One order of 100,000 lines, one with ids far apart, and a third of the keys missing.
        "SELECT 1L AS k, id AS a, id AS b FROM range(100000)",
        "SELECT id % 2 AS k, id * 461168601842738 AS a, -id AS b FROM range(20000)",
        "SELECT CASE WHEN id % 3 = 0 THEN NULL ELSE id % 50 END AS k, id % 7 AS a, id AS b FROM range(30000)",
    ],
)
def test_no_task_gets_a_whole_key(spark, rows):
    """Every key is numbered exactly, and the parts that number it are about even."""
    df = spark.sql(rows).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the parts are small here
    out = number_rows(df, "k", ["a", "b"], "pos", carry="a", previous="before")
    w = Window.partitionBy("k").orderBy("a", "b")
    plain = df.select("*", F.row_number().over(w).alias("pos"), F.lag("a").over(w).alias("before"))
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = out.inputFiles()
    per_part = spark.read.parquet(*stored).groupBy((F.col("_place") / 2**33).cast("int")).count()
    sizes = [r["count"] for r in per_part.collect()]
    assert len(sizes) > 1 and max(sizes) <= 2 * df.count() / len(sizes)


def test_first_order_has_no_gap_and_same_day_has_gap_zero(spark):
    orders = spark.createDataFrame(
        [(5, 1, day(2)), (4, 1, day(2)), (9, 1, day(10))], "order_id long, user_id long, order_date date"
    )
    got = {r.order_id: (r.order_number, r.days_since_prior_order) for r in derive_order_sequence(orders).collect()}
    assert got == {4: (1, None), 5: (2, 0), 9: (3, 8)}


def test_reordered_means_bought_in_an_earlier_order(spark):
    orders = spark.createDataFrame(
        [(1, 7, day(0)), (2, 7, day(0)), (3, 7, day(5)), (4, 8, day(9))],
        "order_id long, user_id long, order_date date",
    )
    lines = spark.createDataFrame(
        [(1, 10, 1, 0), (2, 10, 1, 0), (3, 20, 1, 0), (3, 10, 2, 0), (4, 10, 1, 0)], LINES
    )
    got = {(r.order_id, r.product_id): r.reordered for r in derive_reordered(orders, lines).collect()}
    assert got == {(1, 10): 0, (2, 10): 1, (3, 20): 0, (3, 10): 1, (4, 10): 0}
