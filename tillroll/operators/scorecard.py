"""Quality metrics of the fact table and their score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numbers import ratio, reordered_items, rows

# Expectations and alarm lines of the scorecard.
EXPECTED_ROWS = 3_000_000
EXPECTED_REORDER_RATE = 0.5
ROW_COUNT_TOLERANCE = 0.1
RUN_CHANGE_TOLERANCE = 0.2
MAX_NULL_RATE = 0.05
REORDER_RATE_ALARM = (0.1, 0.9)
ALERT_BELOW_SCORE = 0.95


def _null_rate():
    return ratio(F.count(F.when(F.col("order_id").isNull(), 1)), rows())


def _duplicates():
    # A struct is never NULL, so keys with NULL parts count as keys.
    return rows() - F.countDistinct(F.struct("order_id", "product_id"))


def dq_null_rate(fct: DataFrame) -> DataFrame:
    value = F.col("null_rate")
    return fct.agg(_null_rate().alias("null_rate")).select(
        "null_rate", (value == 0).alias("passed"), (value > MAX_NULL_RATE).alias("anomaly_detected")
    )


def dq_duplicate_count(fct: DataFrame) -> DataFrame:
    value = F.col("duplicate_count")
    return fct.agg(_duplicates().alias("duplicate_count")).select(
        "duplicate_count", (value == 0).alias("passed"), (value > 0).alias("anomaly_detected")
    )


def _far_off(value, expected: int):
    return F.abs(value - expected) > expected * ROW_COUNT_TOLERANCE


def dq_row_count(fct: DataFrame, expected: int = EXPECTED_ROWS) -> DataFrame:
    value = F.col("row_count")
    return fct.agg(rows().alias("row_count")).select(
        "row_count",
        F.lit(expected).cast("long").alias("expected_rows"),
        (value > 0).alias("passed"),
        _far_off(value, expected).alias("anomaly_detected"),
    )


def _rate_alarm(value):
    low, high = REORDER_RATE_ALARM
    return (value < low) | (value > high)


def dq_reorder_rate(fct: DataFrame) -> DataFrame:
    value = F.col("reorder_rate")
    return fct.agg(ratio(reordered_items(), rows()).alias("reorder_rate")).select(
        "reorder_rate",
        value.between(0.0, 1.0).alias("passed"),
        _rate_alarm(value).alias("anomaly_detected"),
    )


def dq_scorecard(fct: DataFrame, expected_rows: int = EXPECTED_ROWS, table_name: str = "fact_orders") -> DataFrame:
    """The four metrics as rows, from one aggregate over the fact, with the overall score.

    A metric of an empty fact is NULL and counts as not passed.
    """
    measured = fct.agg(
        _null_rate().alias("nulls"),
        _duplicates().alias("duplicates"),
        rows().alias("n"),
        ratio(reordered_items(), rows()).alias("rate"),
    )
    nulls, duplicates, n, rate = (F.col(c) for c in ("nulls", "duplicates", "n", "rate"))

    def metric(name, column, value, expected, passed, anomaly):
        value = value.cast("double")
        return F.struct(
            F.lit(name).alias("metric_name"),
            F.lit(table_name).alias("table_name"),
            F.lit(column).cast("string").alias("column_name"),
            value.alias("metric_value"),
            F.lit(float(expected)).alias("expected_value"),
            value.alias("actual_value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            F.coalesce(anomaly, F.lit(False)).alias("anomaly_detected"),
        )

    metrics = F.array(
        metric("null_rate", "order_id", nulls, 0, nulls == 0, nulls > MAX_NULL_RATE),
        metric("duplicate_count", "order_id, product_id", duplicates, 0, duplicates == 0, duplicates > 0),
        metric("row_count", None, n, expected_rows, n > 0, _far_off(n, expected_rows)),
        metric("reorder_rate", "reordered", rate, EXPECTED_REORDER_RATE, rate.between(0.0, 1.0), _rate_alarm(rate)),
    )
    held = measured.select(metrics.alias("metrics"))
    score = F.size(F.filter("metrics", lambda m: m["passed"])) / F.size("metrics")
    return held.select(score.alias("quality_score"), F.inline("metrics")).select(
        "metric_name",
        "table_name",
        "column_name",
        "metric_value",
        "expected_value",
        "actual_value",
        "passed",
        "anomaly_detected",
        "quality_score",
    )


def anomalies(scorecard: DataFrame) -> DataFrame:
    return scorecard.where(F.col("anomaly_detected"))


def score_alert(scorecard: DataFrame, below: float = ALERT_BELOW_SCORE) -> DataFrame:
    """The score as one row if it is below the alert line, else no row."""
    return scorecard.agg(F.max("quality_score").alias("quality_score")).where(
        F.col("quality_score") < below
    )


def dq_row_count_change(history: DataFrame, tolerance: float = RUN_CHANGE_TOLERANCE) -> DataFrame:
    """Change of each table's row count against its previous run (one input row per table and run)."""
    before = F.lag("row_count").over(Window.partitionBy("table_name").orderBy("run_date"))
    return (
        history.withColumn("previous_count", before)
        .withColumn("change", ratio(F.col("row_count") - F.col("previous_count"), F.col("previous_count")))
        .select(
            "table_name",
            "run_date",
            "row_count",
            "previous_count",
            "change",
            # A change from zero rows has no ratio and is beyond any tolerance.
            F.coalesce(
                F.abs("change") > tolerance, (F.col("previous_count") == 0) & (F.col("row_count") != 0), F.lit(False)
            ).alias("anomaly_detected"),
        )
    )
