"""Cases that the tables at hand do not hold, and the fixed values both sides of the comparison share."""

import datetime as dt
from dataclasses import replace

from tillroll.operators import assertions, history, personal_data, scorecard
from tillroll.operators.sequence import derive_reordered
from tillroll.plans import headlines, runs
from tillroll.operators.validation import SPECS
from tillroll.plans.batch import run_batch, text_columns
from tillroll.sinks import tables
from tillroll.sources.raw import load_staging, source_inventory


def write_inputs(folder, product='1,"Pizza 12"" thin",1,1\n2,"Say ""Cheese"", please",1,1'):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "orders.csv").write_text(
        "order_id,user_id,order_number,order_dow,order_hour_of_day,days_since_prior_order\n1,1,1,0,8,\n2,1,2,1,9,7.0\n"
    )
    (folder / "products.csv").write_text(f"product_id,product_name,aisle_id,department_id\n{product}\n")
    (folder / "aisles.csv").write_text("aisle_id,aisle\n1,one\n")
    (folder / "departments.csv").write_text("department_id,department\n1,one\n")
    (folder / "order_products__train.csv").write_text("order_id,product_id,add_to_cart_order,reordered\n1,1,1,0\n2,1,1,1\n")
    return str(folder)


def test_doubled_quotes_and_commas(spark, tmp_path):
    loaded = load_staging(spark, write_inputs(tmp_path / "raw"))
    names = {r.product_id: r.product_name for r in loaded["stg_products"].collect()}
    assert names == {1: 'Pizza 12" thin', 2: 'Say "Cheese", please'}


def test_files_below_the_folder_do_not_count(spark, tmp_path):
    raw = write_inputs(tmp_path / "raw + %41")
    (tmp_path / "raw + %41" / "archive").mkdir()
    (tmp_path / "raw + %41" / "archive" / "returns.csv").write_text("a\n1\n")
    (tmp_path / "raw + %41" / "archive" / "orders.csv").write_text("a\n1\n2\n3\n")
    found = {r["name"]: (r["rows"], r["present"]) for r in source_inventory(spark, raw, ["orders.csv", "returns.csv"]).collect()}
    assert found == {"orders.csv": (2, True), "returns.csv": (None, False)}


def test_half_a_second_over_the_limit_is_a_breach(spark):
    start = dt.datetime(2024, 1, 1, 12)
    raw = spark.createDataFrame(
        [(start, start + dt.timedelta(seconds=s), 1, 1.0, "success") for s in (1800, 1800.5, 1801)],
        "started_at timestamp, completed_at timestamp, rows_processed long, quality_score double, status string",
    )
    log = runs.log_runs(raw)
    assert log.where("NOT sla_met").count() == runs.sla_breaches(log).count() == 2


def test_lines_of_orders_without_a_user_keep_their_flag(spark):
    orders = spark.createDataFrame(
        [(1, None, dt.date(2024, 1, 1)), (2, None, dt.date(2024, 1, 2)), (3, 5, dt.date(2024, 1, 3))],
        "order_id long, user_id long, order_date date",
    )
    lines = spark.createDataFrame([(1, 10), (2, 10), (3, 10)], "order_id long, product_id long")
    found = {r.order_id: r.reordered for r in derive_reordered(orders, lines).collect()}
    assert found == {1: 0, 2: 1, 3: 0}


def test_growth_from_zero_rows_is_an_anomaly(spark):
    counts = [("a", 1, 0), ("a", 2, 500), ("b", 1, 0), ("b", 2, 0), ("c", 1, 100), ("c", 2, 101)]
    table = spark.createDataFrame(
        [(t, dt.date(2024, 1, d), n) for t, d, n in counts], "table_name string, run_date date, row_count long"
    )
    found = {(r.table_name, r.run_date.day): r.anomaly_detected for r in scorecard.dq_row_count_change(table).collect()}
    assert [k for k, v in found.items() if v] == [("a", 2)]


def test_every_sticky_product_comes_back(spark):
    rows = [(o, p, 1) for p in range(60) for o in range(2)]
    fct = spark.createDataFrame(rows, "order_id long, product_id long, reordered int")
    assert headlines.sticky_products(fct, 0.85).count() == 60


def test_numbers_are_no_personal_data(spark):
    """Ids of ten digits look like phone numbers; declared numbers are not scanned, other columns are."""
    text = spark.createDataFrame([("5551234567", "call 555-123-4567")], "order_id string, comment string")
    found = personal_data.pii_scan("orders", text_columns("orders", text)).collect()
    assert {r.column_name for r in found} == {"comment"}
    assert sum(r.matches for r in found) == 1


def test_second_day_goes_on_from_the_first(spark, tmp_path):
    """Fact and history after two days are those of one build; the counts are compared with the day before."""
    specs = {n: replace(s, min_rows=1) for n, s in SPECS.items()}
    day = dt.date(2024, 1, 1)
    first = run_batch(spark, write_inputs(tmp_path / "one"), str(tmp_path / "out"), day, specs)
    assert [r.previous_count for r in first.changes.collect()] == [None]
    raw = write_inputs(tmp_path / "two", "1,Pizza,1,1\n3,Salad,1,1")
    with open(f"{raw}/orders.csv", "a") as orders, open(f"{raw}/order_products__train.csv", "a") as lines:
        orders.write("3,1,2,2,9,3.0\n")
        lines.write("3,1,1,1\n3,3,2,0\n")
    second = run_batch(spark, raw, str(tmp_path / "out"), day + dt.timedelta(1), specs)
    fact = {(r.order_id, r.product_id) for r in second.marts["fct_orders"].collect()}
    assert fact == {(1, 1), (2, 1), (3, 1), (3, 3)} and second.marts["fct_orders"].count() == 4
    history = {(r.product_id, r.product_name, str(r.valid_from), r.is_current) for r in second.marts["dim_products_scd"].collect()}
    assert history == {
        (1, 'Pizza 12" thin', "2024-01-01", False), (1, "Pizza", "2024-01-02", True),
        (2, 'Say "Cheese", please', "2024-01-01", False), (3, "Salad", "2024-01-02", True),
    }
    assert [(r.previous_count, r.row_count, r.anomaly_detected) for r in second.changes.collect()] == [(2, 4, True)]
    runs_ = spark.read.parquet(str(tmp_path / "out" / "ops" / "pipeline_runs"))
    assert runs_.count() == 2 and {"rows_failed", "created_at"} <= set(runs_.columns)


def test_fixed_values():
    """Written out, as the SQL side is built from the same names."""
    assert sum(len(c) for c in assertions.NOT_NULL.values()) + sum(len(c) for c in assertions.UNIQUE.values()) == 43
    assert sorted(personal_data.PATTERNS) == ["credit_card", "email", "ip_address", "phone", "ssn"]
    assert assertions.FACT_PARENTS == {
        "dim_users": "user_id", "dim_products": "product_id", "dim_departments": "department_id",
        "dim_aisles": "aisle_id", "dim_time": "order_date",
    }
    assert tables.PUBLISHED == [
        "fct_orders", "dim_users", "dim_products", "dim_departments", "product_funnel", "user_retention", "department_performance",
    ]
    assert runs.SLA_SECONDS == 1800 and history.OPEN_END == dt.date(9999, 12, 31)
