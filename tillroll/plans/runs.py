"""The log of batch runs: recording, SLA and quality trends, table counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import count_if, percent, ratio, round_to, rows

# Fixed value: a run may take thirty minutes.
SLA_SECONDS = 30 * 60

RUN_COLUMNS = [
    "run_id",
    "run_date",
    "started_at",
    "completed_at",
    "duration_seconds",
    "rows_processed",
    "sla_met",
    "quality_score",
    "status",
    "error_message",
    "notes",
]


def _elapsed_seconds():
    return F.expr("timestampdiff(MICROSECOND, started_at, completed_at)") / 1e6


def log_runs(raw: DataFrame, sla_seconds: int = SLA_SECONDS) -> DataFrame:
    """Turn start and end times into run records; one random id per record.

    Write the result once and read it back before joining on run_id.
    """
    have = set(raw.columns)
    optional = {"error_message": F.lit(None).cast("string"), "notes": F.lit(None).cast("string")}
    # Fixed value: the wording of the note.
    default_note = F.concat(
        F.lit("Quality score: "),
        F.format_number("quality_score", 2),
        F.lit(", Fact rows: "),
        F.format_number("rows_processed", 0),
    )
    return (
        raw.withColumns({c: v for c, v in optional.items() if c not in have})
        .withColumns(
            {
                "run_id": F.expr("uuid()"),
                "run_date": F.col("started_at").cast("date"),
                "duration_seconds": F.floor(_elapsed_seconds()).cast("int"),
                "sla_met": _elapsed_seconds() <= sla_seconds,
                "notes": F.coalesce(F.col("notes"), default_note),
            }
        )
        .select(*RUN_COLUMNS)
    )


def sla_breaches(runs: DataFrame, sla_seconds: int = SLA_SECONDS) -> DataFrame:
    """One alert row per run over the limit, by its exact time: 1800.5 seconds are a breach."""
    return runs.where(_elapsed_seconds() > sla_seconds).select(
        "run_id",
        "run_date",
        "duration_seconds",
        F.lit(sla_seconds).alias("threshold_seconds"),
        F.concat(
            F.lit("SLA breached: "),
            F.col("duration_seconds").cast("string"),
            F.lit(f"s > {sla_seconds}s"),
        ).alias("alert"),
    )


def sla_compliance(runs: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    return (
        runs.where(F.col("run_date") >= F.lit(as_of - dt.timedelta(days=days)))
        .groupBy("run_date")
        .agg(
            rows().alias("total_runs"),
            count_if(F.col("sla_met")).alias("sla_met_count"),
            percent(count_if(F.col("sla_met")), rows()).alias("sla_compliance_pct"),
            F.avg("quality_score").alias("avg_quality_score"),
        )
        .orderBy(F.desc("run_date"))
    )


def ops_latest_run(runs: DataFrame) -> DataFrame:
    return (
        runs.orderBy(F.desc("run_date"), F.desc("started_at"), F.desc("run_id"))
        .limit(1)
        .select(
            "run_id",
            "run_date",
            "started_at",
            "completed_at",
            "duration_seconds",
            "sla_met",
            "quality_score",
            "status",
            "notes",
        )
    )


def ops_sla_trend(runs: DataFrame, k: int = 30) -> DataFrame:
    return (
        runs.groupBy("run_date")
        .agg(
            rows().alias("total_runs"),
            count_if(F.col("sla_met")).alias("sla_met_count"),
            percent(count_if(F.col("sla_met")), rows()).alias("sla_compliance_pct"),
            round_to(F.avg("duration_seconds"), 0).alias("avg_duration_sec"),
            F.max("duration_seconds").alias("max_duration_sec"),
        )
        .orderBy(F.desc("run_date"))
        .limit(k)
    )


def ops_quality_trend(runs: DataFrame, k: int = 30) -> DataFrame:
    return (
        runs.groupBy("run_date")
        .agg(
            rows().alias("run_count"),
            round_to(F.avg("quality_score"), 3).alias("avg_quality_score"),
            round_to(F.min("quality_score"), 3).alias("min_quality_score"),
            round_to(F.max("quality_score"), 3).alias("max_quality_score"),
        )
        .orderBy(F.desc("run_date"))
        .limit(k)
    )


def ops_volume(runs: DataFrame, k: int = 30) -> DataFrame:
    return (
        runs.where(F.col("status") == "success")
        .groupBy("run_date")
        .agg(
            F.sum("rows_processed").alias("total_rows_processed"),
            rows().alias("run_count"),
            round_to(F.avg("rows_processed"), 0).alias("avg_rows_per_run"),
        )
        .orderBy(F.desc("run_date"))
        .limit(k)
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """One row per table with its row count."""
    counted = None
    for name, df in tables.items():
        one = df.agg(rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counted = one if counted is None else counted.unionByName(one)
    return counted


def ops_table_counts(fct: DataFrame, dim_users: DataFrame, dim_products: DataFrame) -> DataFrame:
    counts = table_counts(fact_orders=fct, dim_users=dim_users, dim_products=dim_products)
    return counts.withColumn(
        "millions_of_rows", round_to(F.col("row_count") / 1_000_000.0, 2)
    ).orderBy(F.desc("row_count"), "table_name")


def run_health(runs: DataFrame, sla_seconds: int = SLA_SECONDS) -> DataFrame:
    """All-time SLA compliance and mean duration in minutes."""
    return runs.agg(
        F.lit(sla_seconds / 60.0).alias("sla_threshold_mins"),
        percent(count_if(F.col("sla_met")), rows(), 1).alias("sla_compliance_rate"),
        round_to(F.avg(_elapsed_seconds()) / 60.0, 1).alias("avg_duration_mins"),
    )


def recent_runs(runs: DataFrame, k: int = 10) -> DataFrame:
    return (
        runs.orderBy(F.desc("run_date"), F.desc("started_at"), F.desc("run_id"))
        .limit(k)
        .select(
            F.col("run_date").alias("date"),
            round_to(_elapsed_seconds() / 60.0, 1).alias("duration_mins"),
            F.coalesce("rows_processed", F.lit(0)).alias("rows"),
            "sla_met",
            "status",
            "notes",
        )
    )
