"""Tables that change together: all of a write is seen or nothing, a broken one goes on, copies are equal."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tillroll.operators import daily_states, sequence
from tillroll.operators.validation import SPECS
from tillroll.plans import batch as batches
from tillroll.plans import star
from tillroll.plans.warehouse import Warehouse
from tillroll.session import scratch_dir
from tillroll.sinks import files, tables, tablesets
from tillroll.sinks.buckets import open_bucketed, write_bucketed
from tillroll.sources import inference, raw
from tillroll.streaming import arrivals
from test_runs_sinks_and_batch import FILES, SMALL, write_inputs

FACT = "order_id long, product_id long, add_to_cart_order int"
DAY = dt.date(2024, 5, 1)


class Crash(Exception):
    pass


def keyed(df):
    return sorted((r.order_id, r.product_id, r.add_to_cart_order) for r in df.collect())


@pytest.mark.parametrize("after", [None, 1])
def test_a_merge_that_breaks_off_leaves_the_old_fact(spark, monkeypatch, after):
    """Broken off before each of its steps in turn: the old rows until it is through, then the new ones."""
    path = scratch_dir(spark, "fact")
    tables.write_fact(spark.createDataFrame([(1, 1, 1), (2, 1, 1), (5, 1, 1)], FACT), path, orders_per_block=2)
    old = keyed(tables.read_fact(spark, path))
    batch = spark.createDataFrame([(2, 1, 99), (6, 1, 1)], FACT)
    real, steps = {}, {"left": 0}

    def breaking(name, owner):
        real[name] = getattr(owner, name)

        def call(*args, **kwargs):
            if not steps["left"]:
                raise Crash(name)
            steps["left"] -= 1
            return real[name](*args, **kwargs)

        monkeypatch.setattr(owner, name, call)

    breaking("_write", tablesets.Draft)
    breaking("put_text", files)
    breaking("_sorted_blocks", tables)
    for allowed in range(10):
        steps["left"] = allowed
        try:
            tables.merge_into_fact(spark, path, batch, after_order=after, orders_per_block=2)
            break
        except Crash:
            assert keyed(tables.read_fact(spark, path)) == old
    assert allowed >= 3
    new = [(1, 1, 1), (2, 1, 1 if after is None else 99), (5, 1, 1), (6, 1, 1)]
    assert keyed(tables.read_fact(spark, path)) == new
    steps["left"] = 99
    tables.merge_into_fact(spark, path, batch, after_order=after, orders_per_block=2)
    assert keyed(tables.read_fact(spark, path)) == new


def test_old_versions_can_be_read_and_dropped(spark):
    store = tablesets.TableSet(spark, scratch_dir(spark, "set"))
    for k in range(3):
        draft = store.draft(f"k{k}")
        draft.write("numbers", lambda k=k: spark.range(k + 1))
        if not k:
            draft.write("same", lambda: spark.range(7).withColumn("half", F.col("id") % 2), by="half")
        draft.publish()
    broken = store.draft("broken")
    broken.write("numbers", lambda: spark.range(50))
    assert [store.read("numbers", v).count() for v in store.versions()] == [1, 2, 3]
    store.drop_old()
    assert store.versions() == [3] and store.read("numbers").count() == 3 and store.read("same").count() == 7
    assert len(files.names(spark, f"{store.root}/_data/numbers")) == 2  # the last version's, and that of a draft at work
    broken.publish()
    assert store.read("numbers").count() == 50 and store.measures("numbers") == {"rows": 50}


def test_of_two_writers_one_is_refused(spark):
    store = tablesets.TableSet(spark, scratch_dir(spark, "set"))
    first, second = store.draft("a"), store.draft("b")
    first.write("t", lambda: spark.range(1))
    second.write("t", lambda: spark.range(2))
    first.publish()
    with pytest.raises(tablesets.PublishedMeanwhile):
        second.publish()
    assert store.read("t").count() == 1


def test_empty_tables_have_versions_too(spark):
    path = scratch_dir(spark, "fact")
    assert tables.write_fact(spark.createDataFrame([], FACT), path).count() == 0
    merged = tables.merge_into_fact(spark, path, spark.createDataFrame([(1, 1, 1)], FACT))
    assert keyed(merged) == [(1, 1, 1)] and tablesets.TableSet(spark, path).measures("fact") == {"rows": 1}


# --- the batch ----------------------------------------------------------------


def test_failing_tests_leave_published_marts(spark, tmp_path):
    out = str(tmp_path / "out")
    batches.run_batch(spark, write_inputs(tmp_path / "one"), out, DAY, SMALL)
    store = tablesets.TableSet(spark, f"{out}/warehouse")
    before = store.read("dim_products").drop("created_at", "updated_at").collect()
    # A product without a department: its mart row has a NULL that a test forbids.
    bad = write_inputs(tmp_path / "two", **{"products.csv": FILES["products.csv"] + "30,,1,5\n"})
    with pytest.raises(batches.TestsFailed, match="product_name"):
        batches.run_batch(spark, bad, out, DAY + dt.timedelta(1), SMALL)
    assert store.versions() == [1] and store.read("dim_products").drop("created_at", "updated_at").collect() == before
    log = spark.read.parquet(f"{out}/ops/pipeline_runs").orderBy("started_at").collect()
    assert [r.status for r in log] == ["success", "failed"]
    batches.run_batch(spark, bad, out, DAY + dt.timedelta(1), SMALL, publish_failing=True)
    assert store.versions() == [1, 2] and store.read("dim_products").count() == 3


def test_a_batch_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    out, inputs = str(tmp_path / "out"), write_inputs(tmp_path / "one")
    real = tablesets.Draft._write
    made = []

    def write(self, name, *args):
        if name == "user_retention" and name not in made:
            made.append(name)
            raise Crash(name)
        made.append(name)
        return real(self, name, *args)

    monkeypatch.setattr(tablesets.Draft, "_write", write)
    with pytest.raises(Crash):
        batches.run_batch(spark, inputs, out, DAY, SMALL)
    done = set(made) - {"user_retention"}
    made[:] = ["user_retention"]
    result = batches.run_batch(spark, inputs, out, DAY, SMALL)
    assert {"text_orders", "validation", "stg_orders", "order_lines"} <= done
    assert not done & set(made[1:]) and "user_retention" in made[1:] and "tests" in made
    assert result.marts["fct_orders"].count() == 3 and result.run.first().status == "success"


def test_changed_inputs_start_anew(spark, tmp_path):
    inputs = write_inputs(tmp_path / "one")
    before = batches.inputs_key(spark, inputs, DAY, SMALL, 0.0)
    assert batches.inputs_key(spark, inputs, DAY, SMALL, 0.0) == before != batches.inputs_key(spark, inputs, DAY, SMALL, 0.1)
    with open(f"{inputs}/orders.csv", "a") as f:
        f.write("9,100,3,1,9,7.0\n")
    assert batches.inputs_key(spark, inputs, DAY, SMALL, 0.0) != before


def test_rows_that_do_not_fit_are_kept_and_counted(spark, tmp_path):
    bad = FILES["orders.csv"] + "four,100,3,1,9,7.0\n5,200,2,Monday,x,7.0\n6,200,3,2,11,\n"
    inputs = write_inputs(tmp_path / "raw", **{"orders.csv": bad})
    result = batches.run_batch(spark, inputs, str(tmp_path / "out"), DAY, SMALL, tolerated=0.4)
    found = {(r.file, r.column_name, r.value, r.wanted) for r in result.rejected.collect()}
    assert found == {
        ("orders.csv", "order_id", "four", "long"), ("orders.csv", "order_dow", "Monday", "int"), ("orders.csv", "order_hour_of_day", "x", "int")
    }
    assert result.marts["stg_orders"].count() == 4
    assert spark.read.parquet(str(tmp_path / "out" / "ops" / "pipeline_runs")).first().rows_failed == 2
    with pytest.raises(batches.TooManyRejected, match="2 of 6"):
        batches.run_batch(spark, inputs, str(tmp_path / "strict"), DAY, SMALL, tolerated=0.3)
    assert spark.read.parquet(str(tmp_path / "strict" / "ops" / "pipeline_runs")).first().rows_failed == 2


# --- copies -------------------------------------------------------------------


def test_a_changed_value_in_a_copy_is_reported(spark):
    source = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (2, "b", None), (3, None, 0.5), (None, "x", 1.0)], "k long, t string, v double")
    assert all(r.equal for r in tables.compare_copies(source, source.repartition(3).orderBy("t"), "k").collect())
    other = source.withColumn("v", F.when(F.col("k") == 3, 0.25).otherwise(F.col("v")))
    assert {(r.part, r.equal) for r in tables.compare_copies(source, other, "k").collect()} == {("1", True), ("2", True), ("3", False), (None, True)}
    assert [r.equal for r in tables.compare_copies(source, source.distinct()).collect()] == [False]
    assert [r.equal for r in tables.compare_copies(source, source.where("false")).collect()] == [False]


def test_unchanged_parts_of_a_copy_are_not_written(spark):
    target = tablesets.TableSet(spark, scratch_dir(spark, "copy"))
    source = spark.range(20).selectExpr("id", "CASE WHEN id < 18 THEN id % 3 END AS k")
    assert {r.written for r in tables.publish_changes("t", source, target, "k").collect()} == {True}
    before = target.state()["tables"]["t"]["parts"]
    changed = source.where("id != 4").unionByName(spark.createDataFrame([(99, 7)], "id long, k long")).where("id < 18 OR id > 18")
    found = {r.part: (r.written, r.equal) for r in tables.publish_changes("t", changed, target, "k").collect()}
    assert found == {"0": (False, True), "1": (True, True), "2": (False, True), "7": (True, True), None: (True, True)}
    after = target.state()["tables"]["t"]["parts"]
    assert {p for p in before if before[p] == after[p]} == {"0", "2"}
    assert sorted(r.id for r in target.read("t").collect()) == sorted(r.id for r in changed.collect())
    # Gone altogether.
    last = {r.part: (r.source_rows, r.copy_rows) for r in tables.publish_changes("t", changed.where("k != 7 OR k IS NULL"), target, "k").collect()}
    assert "7" not in last and target.read("t").where("k = 7").count() == 0


# --- by batch -----------------------------------------------------------------


@pytest.fixture(scope="module")
def shop_days(spark):
    rng = random.Random(3)
    orders, lines = [], []
    for o in range(120):
        day = DAY + dt.timedelta(rng.randrange(9))
        orders.append((o, rng.choice([1, 1, 1, 2, 3, 70_000, 140_000, None]), 1, day.isoweekday() % 7, 8, None, day))
        lines += [(o, p, 1, rng.randrange(2)) for p in rng.sample(range(6), rng.randrange(4))]
    schema = "order_id long, user_id long, order_number int, order_dow int, order_hour_of_day int, days_since_prior_order int, order_date date"
    orders = spark.createDataFrame(orders, schema)
    lines = spark.createDataFrame(lines, "order_id long, product_id long, add_to_cart_order int, reordered int")
    products = spark.createDataFrame([(p, f"p{p}", 1, p % 2) for p in range(5)], "product_id long, product_name string, aisle_id int, department_id int")
    return orders, lines, products


def rows_of(df, *without):
    return sorted((str(sorted(r.asDict().items())) for r in df.drop(*without).collect()))


def test_daily_marts_from_states_equal_a_full_build(spark, shop_days):
    orders, lines, products = shop_days
    store = tablesets.TableSet(spark, scratch_dir(spark, "states"))
    for k in range(3):
        part = star.order_lines(orders, lines).where(F.floor(F.col("order_id") / 40) == k)
        draft = store.draft(f"k{k}")
        daily_states.update_states(draft, part)
        draft.publish()
    states = {n: store.read(n) for n in daily_states.STATES}
    whole = Warehouse(orders, lines, products, None, None, DAY)
    named = products.selectExpr("*", "0 AS reorder_count")
    whole.__dict__["dim_products"] = named
    assert rows_of(daily_states.daily_product_metrics(states["product_state"], named)) == rows_of(whole.daily_product_metrics)
    assert rows_of(daily_states.product_funnel(states, products)) == rows_of(whole.product_funnel)
    by_day = orders.groupBy("order_dow").agg(F.countDistinct("user_id").alias("users"))
    assert rows_of(daily_states.users_by(states, "order_dow")) == rows_of(by_day)


def test_an_update_reads_the_touched_days_alone(spark, shop_days, monkeypatch):
    orders, lines, _ = shop_days
    store = tablesets.TableSet(spark, scratch_dir(spark, "states"))
    first = store.draft("a")
    daily_states.update_states(first, star.order_lines(orders, lines))
    first.publish()
    before = store.state()["tables"]
    opened = []
    real = tablesets.TableSet.open
    monkeypatch.setattr(tablesets.TableSet, "open", lambda self, n, e, parts=None: (opened.append((n, parts)), real(self, n, e, parts))[1])
    new = orders.limit(1).selectExpr("1000 AS order_id", "user_id", "order_number", "3 AS order_dow", "order_hour_of_day", "days_since_prior_order", f"DATE '{DAY}' AS order_date")
    second = store.draft("b")
    daily_states.update_states(second, star.order_lines(new, lines.selectExpr("1000L AS order_id", "product_id", "add_to_cart_order", "reordered").limit(2)))
    assert {tuple(p) for n, p in opened if p is not None} == {(str(DAY),)}
    after = second.entries
    for name in daily_states.STATES:
        assert {p for p in after[name]["parts"] if after[name]["parts"][p] != before[name]["parts"].get(p)} == {str(DAY)}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_of_orders_gives_the_same_sequence(spark, shop_days, seed):
    orders = shop_days[0].select("order_id", "user_id", "order_date")
    wanted = rows_of(sequence.derive_order_sequence(orders))
    store = tablesets.TableSet(spark, scratch_dir(spark, "sequence"))
    rng = random.Random(seed)
    cut = {o: rng.randrange(4) for o in range(120)}
    split = spark.createDataFrame(list(cut.items()), "order_id long, batch int")
    for k in range(4):
        draft = store.draft(f"k{k}")
        sequence.extend_stored_sequence(draft, orders.join(split.where(f"batch = {k}"), "order_id").drop("batch"), blocks=4)
        draft.publish()
    assert rows_of(store.read("sequence"), "user_block") == wanted


def test_first_purchases_by_batch(spark, shop_days):
    orders, lines, _ = shop_days
    whole = sequence.extend_firsts(spark.createDataFrame([], "user_id long, product_id long, first struct<order_date: date, order_id: long>"), orders, lines)
    parts = spark.createDataFrame([], whole.schema)
    for k in (2, 0, 1):
        parts = sequence.extend_firsts(parts, orders.where(f"order_id % 3 = {k}"), lines.where(f"order_id % 3 = {k}"))
    assert rows_of(parts) == rows_of(whole)


# --- files as they arrive -----------------------------------------------------


def test_drops_are_taken_in_once(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("drops", "lines", "checkpoint"))
    header = "order_id,product_id,add_to_cart_order,reordered\n"
    drops = [header + "1,1,1,0\n1,2,2,0\n", header + "2,1,1,0\nx,9,9,9\n1,2,7,1\n", header + "1,1,1,0\n1,2,2,0\n"]
    (tmp_path / "drops").mkdir()
    for k, text in enumerate(drops[:2]):
        (tmp_path / "drops" / f"{k}.csv").write_text(text)
        arrivals.take_in(spark, folder, target, checkpoint)
        arrivals.take_in(spark, folder, target, checkpoint)
    wanted = [(1, 1, 1), (1, 2, 7), (2, 1, 1)]
    store = tablesets.TableSet(spark, target)
    assert keyed(tables.read_fact(spark, target)) == wanted and store.versions() == [1, 2]
    assert [(r.file.rsplit("/")[-1], r.batch) for r in store.read("rejected").collect()] == [("1.csv", 1)]
    # A batch that comes again after a crash is refused; the first drop under another name puts its own lines back.
    again = spark.createDataFrame([("1", "1", "50", "1", dt.datetime(2024, 1, 1), "f")], "order_id string, product_id string, add_to_cart_order string, reordered string, changed timestamp, file string")
    assert not arrivals.merge_batch(spark, again, 1, target) and keyed(tables.read_fact(spark, target)) == wanted
    (tmp_path / "drops" / "2.csv").write_text(drops[2])
    arrivals.take_in(spark, folder, target, checkpoint)
    assert keyed(tables.read_fact(spark, target)) == [(1, 1, 1), (1, 2, 2), (2, 1, 1)]


# --- inputs and storage -------------------------------------------------------


def test_types_of_odd_columns(spark):
    columns = {
        "long": (["1", "-20", "+3", None], "long"), "wide": (["1", "99999999999999999999"], "double"), "double": (["1", "1.", ".5", "1e3"], "double"),
        "date": (["2024-02-29", None], "date"), "no_date": (["2023-02-29"], "string"), "moment": (["2024-01-01", "2024-01-01 10:00:00.5"], "timestamp"),
        "flag": (["true", "FALSE"], "boolean"), "last": (["1"] * 3 + ["x"], "string"), "none": ([None], None), "empty": ([""], "string"), "space": ([" 1"], "string"),
    }
    n = max(len(v) for v, _ in columns.values())
    rows = [tuple((v + [None] * n)[i] for v, _ in columns.values()) for i in range(n)]
    found = inference.infer_types(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)), {"last": "long", "wide": "long", "none": "int", "long": "double"})
    got = {r.column_name: r for r in found.collect()}
    assert {c: got[c].inferred_type for c in columns} == {c: t for c, (_, t) in columns.items()}
    assert {c for c in columns if got[c].drift} == {"last", "wide"} and got["long"].null_count == n - 3
    assert inference.infer_types(spark.createDataFrame([], "a string")).first().inferred_type is None


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_lines_need_no_shuffle_by_order(spark, shop_days):
    orders, lines, products = shop_days
    path = scratch_dir(spark, "lines")
    stored = write_bucketed(star.order_lines(orders, lines), path, "order_id", 4)
    for read in (stored, open_bucketed(spark, path, stored.schema, "order_id", 4)):
        assert rows_of(read) == rows_of(star.order_lines(orders, lines))
        for frame in (star.baskets(read, "user_id"), star.baskets(read, "order_date", "order_dow"), read.groupBy("order_id").count(), read.join(read.select("order_id").distinct(), "order_id", "left_semi")):
            assert "Exchange hashpartitioning" not in executed(frame)
    marts = Warehouse(orders, lines, products, None, None, DAY)
    marts.__dict__["order_lines"] = stored
    for name in ("dim_users", "product_funnel"):
        exchanges = [line for line in executed(getattr(marts, name)).splitlines() if "Exchange hashpartitioning(order_id" in line]
        assert not exchanges, name


def test_marts_by_department_read_no_lines(spark, shop_days):
    """Over the two stored aggregates, M7 and M8 scan neither lines nor orders."""
    orders, lines, products = shop_days
    plain = Warehouse(orders, lines, products, None, None, DAY)
    stored = {n: tables.write_mart(getattr(plain, n), scratch_dir(spark, n)) for n in ("order_departments", "product_days")}
    over = Warehouse(orders, lines, products, None, None, DAY)
    over.__dict__.update(stored)
    for name in ("department_performance", "department_dow_cohorts"):
        assert rows_of(getattr(over, name)) == rows_of(getattr(plain, name))
        assert "add_to_cart_order" not in executed(getattr(over, name))


def test_all_references_in_one_scan(spark, shop_days):
    from tillroll.operators import assertions

    orders, lines, products = shop_days
    fact = tables.write_mart(Warehouse(orders, lines, products, None, None, DAY).fct_orders, scratch_dir(spark, "fact"))
    parents = {
        "dim_products": ("product_id", products.where("product_id != 2")), "dim_users": ("user_id", orders.select("user_id").where("user_id < 3")),
        "dim_time": ("order_date", orders.select("order_date")),
    }
    found = assertions.references(fact, parents)
    wanted = {p: fact.where(F.col(c).isNotNull()).join(df, c, "left_anti").count() for p, (c, df) in parents.items()}
    assert {r.parent_table: r.failures for r in found.collect()} == wanted and wanted["dim_users"] > 0 == wanted["dim_time"]
    assert executed(found).split("== Initial Plan ==")[-1].count("FileScan") == 1


def test_counts_come_with_the_write(spark):
    target = scratch_dir(spark, "published")
    spark.sparkContext.setJobGroup("copies", "")
    try:
        found = tables.publish_marts({"a": spark.range(5), "b": spark.range(2)}, target, ["a", "b"], at_once=1)
        assert {r.table_name: r.row_count for r in found.collect()} == {"a": 5, "b": 2}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_raw_text_of_rejected_rows(spark):
    text = spark.createDataFrame([("1", "2", "x", None), ("1", None, "3", "1")], "order_id string, product_id string, add_to_cart_order string, reordered string")
    found = raw.rejected(raw.sorted_out(text, "order_products"), "order_products").collect()
    assert [(r.column_name, r.value, r.raw_text) for r in found] == [
        ("add_to_cart_order", "x", '{"order_id":"1","product_id":"2","add_to_cart_order":"x","reordered":null}')
    ]
    assert raw.accepted(raw.sorted_out(text, "order_products"), "order_products").count() == 1


def test_specs_are_part_of_the_key(spark, tmp_path):
    inputs = write_inputs(tmp_path / "one")
    other = {n: replace(s, min_rows=2) for n, s in SPECS.items()}
    assert batches.inputs_key(spark, inputs, DAY, SMALL, 0.0) != batches.inputs_key(spark, inputs, DAY, other, 0.0)
