import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import PRODUCTS
from tillroll.operators.history import OPEN_END, dim_products_scd, scd2_as_of, scd2_merge
from tillroll.operators.upsert import upsert_fact
from tillroll.session import scratch_dir
from tillroll.sinks import tables

D0, D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def snapshot(spark, *rows):
    return spark.createDataFrame([(i, f"p{i}", 1, dept) for i, dept in rows], PRODUCTS)


def versions(history):
    rows = [(r.product_id, r.department_id, r.valid_from, r.valid_to, r.is_current) for r in history.collect()]
    return sorted(rows, key=lambda r: (r[0], r[2]))


@pytest.fixture()
def first(spark):
    return dim_products_scd(snapshot(spark, (1, 5), (2, 5), (3, 5)), D0)


def test_new_changed_removed_unchanged(spark, first):
    merged = scd2_merge(first, snapshot(spark, (1, 5), (2, 7), (4, 5)), D1)
    assert versions(merged) == [
        (1, 5, D0, OPEN_END, True),
        (2, 5, D0, D1, False),
        (2, 7, D1, OPEN_END, True),
        (3, 5, D0, D1, False),
        (4, 5, D1, OPEN_END, True),
    ]


def test_unchanged_input_changes_nothing(spark, first):
    assert versions(scd2_merge(first, snapshot(spark, (1, 5), (2, 5), (3, 5)), D1)) == versions(first)


def test_returning_product_gets_a_new_version(spark, first):
    gone = scd2_merge(first, snapshot(spark, (1, 5), (2, 5)), D1)
    back = scd2_merge(gone, snapshot(spark, (1, 5), (2, 5), (3, 6)), D2)
    assert [v for v in versions(back) if v[0] == 3] == [(3, 5, D0, D1, False), (3, 6, D2, OPEN_END, True)]


def test_second_change_on_one_day_replaces_the_version(spark, first):
    once = scd2_merge(first, snapshot(spark, (1, 6), (2, 5), (3, 5)), D1)
    twice = scd2_merge(once, snapshot(spark, (1, 7), (2, 5), (3, 5)), D1)
    assert [v for v in versions(twice) if v[0] == 1] == [(1, 5, D0, D1, False), (1, 7, D1, OPEN_END, True)]


def test_opened_and_removed_on_one_day_leaves_nothing(spark, first):
    once = scd2_merge(first, snapshot(spark, (1, 5), (2, 5), (3, 5), (9, 5)), D1)
    twice = scd2_merge(once, snapshot(spark, (1, 5), (2, 5), (3, 5)), D1)
    assert [v for v in versions(twice) if v[0] == 9] == []


def test_null_attribute_is_a_value(spark):
    start = dim_products_scd(snapshot(spark, (1, None)), D0)
    assert versions(scd2_merge(start, snapshot(spark, (1, None)), D1)) == [(1, None, D0, OPEN_END, True)]
    assert len(versions(scd2_merge(start, snapshot(spark, (1, 4)), D1))) == 2


def test_lookup_by_date(spark, first):
    merged = scd2_merge(first, snapshot(spark, (1, 5), (2, 7)), D1)
    probes = spark.createDataFrame(
        [(2, D0), (2, D1 - dt.timedelta(1)), (2, D1), (3, D1), (1, dt.date(2023, 1, 1))], "product_id long, asked date"
    )
    got = {(r.product_id, r.asked): r.department_id for r in scd2_as_of(merged, probes, "asked").collect()}
    assert got == {
        (2, D0): 5, (2, D1 - dt.timedelta(1)): 5, (2, D1): 7, (3, D1): None, (1, dt.date(2023, 1, 1)): None,
    }


FACT = "order_id long, product_id long, add_to_cart_order int"


@pytest.fixture()
def stored(spark):
    return spark.createDataFrame([(1, 1, 1), (2, 1, 1), (2, 2, 2), (5, 1, 1)], FACT)


def keyed(df):
    return sorted((r.order_id, r.product_id, r.add_to_cart_order) for r in df.collect())


def test_default_takes_newer_orders_only(spark, stored):
    batch = spark.createDataFrame([(2, 2, 99), (5, 1, 99), (6, 1, 1)], FACT)
    assert keyed(upsert_fact(stored, batch)) == keyed(stored) + [(6, 1, 1)]


def test_late_lines_replace_their_key(spark, stored):
    batch = spark.createDataFrame([(1, 1, 99), (2, 2, 99), (2, 3, 3), (6, 1, 1)], FACT)
    assert keyed(upsert_fact(stored, batch, after_order=1)) == [
        (1, 1, 1), (2, 1, 1), (2, 2, 99), (2, 3, 3), (5, 1, 1), (6, 1, 1),
    ]


def test_twice_equals_once(spark, stored):
    batch = spark.createDataFrame([(2, 2, 99), (7, 1, 1)], FACT)
    once = upsert_fact(stored, batch, after_order=0)
    assert keyed(upsert_fact(once, batch, after_order=0)) == keyed(once)
    assert keyed(upsert_fact(upsert_fact(stored, batch), batch)) == keyed(upsert_fact(stored, batch))


def test_first_load_into_nothing(spark, stored):
    nothing = spark.createDataFrame([], FACT)
    assert keyed(upsert_fact(nothing, stored)) == keyed(stored)


def test_stored_fact_takes_batches(spark, stored):
    path = scratch_dir(spark, "fact")
    tables.write_fact(stored, path, orders_per_block=2)
    late = spark.createDataFrame([(2, 2, 99), (3, 1, 1)], FACT)
    merged = tables.merge_into_fact(spark, path, late, after_order=1, orders_per_block=2)
    assert keyed(merged) == [(1, 1, 1), (2, 1, 1), (2, 2, 99), (3, 1, 1), (5, 1, 1)]
    newer = spark.createDataFrame([(5, 1, 99), (6, 1, 1)], FACT)
    merged = tables.merge_into_fact(spark, path, newer, orders_per_block=2)
    assert keyed(merged) == [(1, 1, 1), (2, 1, 1), (2, 2, 99), (3, 1, 1), (5, 1, 1), (6, 1, 1)]
    nothing = spark.createDataFrame([], FACT)
    assert keyed(tables.merge_into_fact(spark, path, nothing, after_order=1, orders_per_block=2)) == keyed(merged)


def test_merge_into_two_far_blocks_leaves_those_between_alone(spark):
    path = scratch_dir(spark, "fact")
    fact = spark.range(20).selectExpr("id AS order_id", "1L AS product_id", "1 AS add_to_cart_order")
    tables.write_fact(fact, path, orders_per_block=2)

    def files():
        found = tables.read_fact(spark, path).select("order_block", F.input_file_name().alias("file")).distinct()
        return {(r.order_block, r.file) for r in found.collect()}

    before = files()
    batch = spark.createDataFrame([(1, 1, 99), (19, 1, 99)], FACT)
    merged = tables.merge_into_fact(spark, path, batch, after_order=0, orders_per_block=2)
    assert [k for k in keyed(merged) if k[2] == 99] == [(1, 1, 99), (19, 1, 99)] and merged.count() == 20
    kept = {f for f in before if f[0] not in (0, 9)}
    assert kept <= files() and not (before - kept) & files()
    assert tables.newest_order(tables.read_fact(spark, path)) == 19


def test_merge_leaves_other_blocks_alone(spark, stored):
    path = scratch_dir(spark, "fact")
    tables.write_fact(stored, path, orders_per_block=2)

    def files(condition):
        found = tables.read_fact(spark, path).where(condition).select(F.input_file_name()).distinct()
        return {r[0] for r in found.collect()}

    before, touched = files("order_block < 2"), files("order_block = 2")
    batch = spark.createDataFrame([(5, 1, 99)], FACT)
    merged = tables.merge_into_fact(spark, path, batch, after_order=4, orders_per_block=2)
    assert (5, 1, 99) in keyed(merged) and (5, 1, 1) not in keyed(merged)
    assert files("order_block < 2") == before
    assert not files("order_block = 2") & touched
