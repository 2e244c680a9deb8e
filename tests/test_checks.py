import pytest

from conftest import LINES, ORDERS, day
from tillroll.operators import assertions, scorecard
from tillroll.operators.personal_data import pii_scan, pii_summary
from tillroll.operators.validation import (
    SPECS,
    TableSpec,
    ValidationFailed,
    check_columns,
    check_min_max,
    check_min_rows,
    check_types,
    check_unique,
    check_values,
    require_valid,
    validate_table,
    validation_summary,
)
from pyspark.sql import types as T

SPEC = TableSpec(
    columns={"order_id": T.LongType(), "order_dow": T.IntegerType(), "reordered": T.IntegerType()},
    ranges={"order_id": (1, None), "order_dow": (0, 6)},
    unique=("order_id",),
    allowed={"reordered": (0, 1)},
    min_rows=6,
)


@pytest.fixture(scope="module")
def bad(spark):
    """As text: a repeated id, a zero id, day 7, a word for a day, flag 2, a NULL flag, an extra column."""
    return spark.createDataFrame(
        [("1", "0", "0", "x"), ("1", "7", "1", "x"), ("0", "six", "2", "x"), ("5", "6", None, "x")],
        "order_id string, order_dow string, reordered string, colour string",
    )


def violations(df):
    return {(r.rule, r.column_name): (r.violations, r.passed) for r in df.collect()}


def test_validate_text_table(bad):
    got = violations(validate_table("orders", bad, SPEC))
    assert got == {
        ("extra_column", "colour"): (1, True),
        ("type", "order_id"): (0, True),
        ("type", "order_dow"): (1, False),
        ("type", "reordered"): (0, True),
        ("range", "order_id"): (1, False),
        ("range", "order_dow"): (1, False),
        ("unique", "order_id"): (1, False),
        ("values", "reordered"): (2, False),
        ("min_rows", "*"): (2, False),
    }


def test_missing_column_fails_and_its_rules_are_skipped(bad):
    got = violations(validate_table("orders", bad.drop("order_dow"), SPEC))
    assert got[("missing_column", "order_dow")] == (1, False)
    assert ("range", "order_dow") not in got


def test_missing_column_fails_on_an_empty_table_too(spark):
    nothing = spark.createDataFrame([], "order_id long")
    assert violations(validate_table("orders", nothing, SPEC))[("missing_column", "reordered")] == (1, False)


def test_wrong_type_counts_every_value(spark):
    df = spark.createDataFrame([(1.5, 1, 0), (2.0, 2, 1)], "order_id double, order_dow int, reordered int")
    assert violations(validate_table("orders", df, SPEC))[("type", "order_id")] == (2, False)


def test_summary_and_raise(bad, spark):
    good = spark.createDataFrame([(i, 1, 0) for i in range(1, 8)], "order_id long, order_dow int, reordered int")
    results = validate_table("good", good, SPEC).unionByName(validate_table("bad", bad, SPEC))
    assert validation_summary(results).first().asDict() == {"tables_passed": 1, "tables_checked": 2}
    require_valid(validate_table("good", good, SPEC))
    with pytest.raises(ValidationFailed, match="bad.order_dow: range"):
        require_valid(results)


def test_single_checks(bad):
    assert {(r.rule, r.column_name, r.rows_affected) for r in check_columns(bad.drop("order_dow"), SPEC).collect()} == {
        ("missing_column", "order_dow", 4),
        ("extra_column", "colour", 4),
    }
    assert {r.column_name: r.violations for r in check_types(bad, SPEC).collect()} == {"order_id": 0, "order_dow": 1, "reordered": 0}
    numbers = bad.selectExpr("int(order_id) AS order_id")
    assert [(r.bound, r.violations) for r in check_min_max(numbers, {"order_id": (1, 4)}).collect()] == [("min", 1), ("max", 1)]
    assert {r.invalid_value: r.violations for r in check_values(bad, "reordered", ("0", "1")).collect()} == {"2": 1, None: 1}
    assert check_min_rows(bad, 4).first().passed and not check_min_rows(bad, 5).first().passed


def test_null_counts_as_a_value_when_looking_for_duplicates(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (1,), (2,)], "v int")
    assert check_unique(df, "v").first().duplicates == 3


def test_declared_layout_covers_the_five_inputs():
    assert set(SPECS) == {"orders", "products", "aisles", "departments", "order_products"}


def test_personal_data(spark, by):
    df = spark.createDataFrame(
        [
            ("write to Ann.Lee@Example.ORG today",),
            ("call 555-123-4567",),
            ("number 5551234567",),
            ("ssn 123-45-6789",),
            ("card 1234 5678 9012 3456",),
            ("host 10.0.0.1 and me@x.io",),
            ("nothing 12 here",),
            (None,),
        ],
        "note string",
    )
    found = {r.pii_type: r.matches for r in pii_scan("notes", df).collect()}
    assert found == {"email": 2, "phone": 2, "ssn": 1, "credit_card": 1, "ip_address": 1}
    clean = pii_scan("clean", df.where("note LIKE 'nothing%'"))
    summary = by(pii_summary(pii_scan("notes", df).unionByName(clean)), "table_name")
    assert (summary["notes"]["findings"], summary["notes"]["matches"], summary["notes"]["clean"]) == (5, 7, False)
    assert summary["clean"]["clean"] and summary["clean"]["findings"] == 0


def test_personal_data_without_text_columns(spark):
    assert pii_scan("numbers", spark.range(3)).count() == 0


def test_table_tests(spark, by):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b"), (3, "c")], "id int, v string")
    assert by(assertions.not_null("t", df, ["id", "v"]), "column_name")["v"]["failures"] == 2
    assert [r.id for r in assertions.repeated_values(df, "id").collect()] == [1]
    assert assertions.unique("t", df, "id").first().failures == 1
    assert assertions.row_count_gt_zero("t", df).count() == 0
    assert assertions.row_count_gt_zero("t", df.where("id > 9")).first().row_count == 0
    assert assertions.null_rate("t", df, "id").first().null_rate == pytest.approx(0.4)
    assert assertions.null_rate("t", df, "id", threshold=0.4).count() == 0
    assert assertions.null_rate("t", df.where("id > 9"), "id").count() == 0
    parents = spark.createDataFrame([(1,)], "id int")
    assert assertions.relationships("t", df, "p", parents, "id").first().failures == 1
    assert assertions.accepted_range("t", df, "id", 2, 5).first().failures == 2


def test_invariant(spark):
    daily = spark.createDataFrame([(2, 2), (3, 2), (1, 2)], "daily_orders long, daily_distinct_orders long")
    assert assertions.metric_invariants(daily).first().failures == 1


def test_summary_of_tests(spark, by):
    results = spark.createDataFrame(
        [("unique", "a", "id", True), ("unique", "b", "id", False), ("not_null", "a", "id", True)],
        "category string, table_name string, column_name string, passed boolean",
    )
    got = by(assertions.summary(results), "category", "table_name")
    assert (got[("all", "all")]["total_tests"], got[("all", "all")]["failed"]) == (3, 1)
    assert got[("unique", "all")]["pass_rate"] == 50.0 and got[("all", "a")]["passed"] == 2


FACT = "order_id long, product_id long, reordered int"


def test_scorecard(spark, by):
    fct = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 2, 0), (None, 2, 0), (2, None, 1)], FACT)
    card = scorecard.dq_scorecard(fct, expected_rows=5)
    got = by(card, "metric_name")
    assert got["null_rate"]["metric_value"] == pytest.approx(0.4) and got["null_rate"]["anomaly_detected"]
    # Keys with NULL parts are keys: (1,1) and (NULL,2) both appear twice.
    assert got["duplicate_count"]["metric_value"] == 2 and not got["duplicate_count"]["passed"]
    assert got["row_count"]["passed"] and not got["row_count"]["anomaly_detected"]
    assert got["reorder_rate"]["metric_value"] == pytest.approx(0.4)
    assert {r["quality_score"] for r in got.values()} == {0.5}
    assert scorecard.anomalies(card).count() == 2
    assert scorecard.score_alert(card).first().quality_score == 0.5


def test_scorecard_of_an_empty_fact(spark, by):
    got = by(scorecard.dq_scorecard(spark.createDataFrame([], FACT)), "metric_name")
    assert got["null_rate"]["metric_value"] is None and not got["null_rate"]["passed"]
    assert not got["row_count"]["passed"] and got["row_count"]["anomaly_detected"]
    assert got["duplicate_count"]["passed"]


@pytest.mark.parametrize("n,far", [(89, True), (90, False), (110, False), (111, True)])
def test_row_count_tolerance(spark, n, far):
    fct = spark.range(n).selectExpr("id AS order_id", "id AS product_id", "0 AS reordered")
    assert scorecard.dq_row_count(fct, expected=100).first().anomaly_detected is far


def test_row_count_change(spark, by):
    history = spark.createDataFrame(
        [("a", day(0), 100), ("a", day(1), 120), ("a", day(2), 90), ("b", day(1), 5), ("c", day(0), 0), ("c", day(1), 9)],
        "table_name string, run_date date, row_count long",
    )
    got = by(scorecard.dq_row_count_change(history), "table_name", "run_date")
    assert got[("a", day(0))]["change"] is None and not got[("a", day(0))]["anomaly_detected"]
    assert not got[("a", day(1))]["anomaly_detected"]
    assert got[("a", day(2))]["change"] == pytest.approx(-0.25) and got[("a", day(2))]["anomaly_detected"]
    assert got[("c", day(1))]["change"] is None
