"""The whole daily batch as one Spark application."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import assertions
from tillroll.operators.personal_data import pii_scan, pii_summary
from tillroll.operators.scorecard import dq_row_count_change, dq_scorecard
from tillroll.operators.validation import SPECS, TableSpec, require_valid, validate_tables
from tillroll.plans.runs import log_runs, sla_breaches
from tillroll.plans.warehouse import Warehouse
from tillroll.session import bound_tasks, stored_bytes
from tillroll.sinks.files import listing
from tillroll.sinks.tables import append_ops_table, append_run_log, write_mart
from tillroll.sinks.tablesets import Draft, TableSet
from tillroll.sources import staging
from tillroll.sources.raw import (
    COLUMN_TYPES,
    accepted,
    other_inputs,
    problems,
    read_text,
    rejected,
    require_sources,
    sorted_out,
    source_inventory,
    with_current_names,
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("quality_score", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


@dataclass
class BatchResult:
    inventory: DataFrame
    validation: DataFrame
    rejected: DataFrame
    personal_data: DataFrame
    marts: dict[str, DataFrame]
    tests: DataFrame
    scorecard: DataFrame
    counts: DataFrame
    run: DataFrame
    breaches: DataFrame
    changes: DataFrame


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _record_run(spark, ops_dir: str, started, score, fact_rows, status, error=None, rejected_rows: int = 0) -> DataFrame:
    """Write one run record; read back, so that its random id is settled."""
    raw = spark.createDataFrame([(started, _now(), fact_rows, score, status, error)], RUN_SCHEMA)
    path = f"{ops_dir}/runs/started={started:%Y%m%dT%H%M%S%f}"
    run = write_mart(log_runs(raw), path)
    kept = run.withColumns({"rows_failed": F.lit(rejected_rows).cast("long"), "created_at": F.current_timestamp()})
    append_ops_table(kept, f"{ops_dir}/pipeline_runs")
    append_run_log(run, f"{ops_dir}/run_log")
    return run


def text_columns(name: str, df: DataFrame) -> DataFrame:
    """The columns of an input that hold text: all but those declared to be numbers."""
    declared = COLUMN_TYPES.get(name, {})
    return df.select(*[c for c in df.columns if declared.get(c, "string") == "string"])


def row_count_changes(spark: SparkSession, ops_dir: str, run: DataFrame) -> DataFrame:
    """The run's row counts against those of the run before, from the recorded metrics."""
    started = spark.read.parquet(f"{ops_dir}/pipeline_runs").select("run_id", F.col("started_at").alias("run_date"))
    counts = (
        spark.read.parquet(f"{ops_dir}/data_quality_metrics")
        .where("metric_name = 'row_count'")
        .join(started, "run_id")
        .select("table_name", "run_date", F.col("metric_value").cast("long").alias("row_count"))
    )
    return dq_row_count_change(counts).join(run.select(F.col("started_at").alias("run_date")), "run_date", "left_semi")


class TestsFailed(RuntimeError):
    """Table tests failed, so the marts were not published."""


class TooManyRejected(ValueError):
    """More rows of an input do not fit its types than are tolerated."""


def inputs_key(spark: SparkSession, raw_dir: str, as_of: dt.date, specs: dict[str, TableSpec], tolerated: float) -> str:
    """A digest of the input files' names, sizes and times of change, and of what else a batch depends on."""
    parts = [listing(spark, raw_dir), str(as_of), sorted((n, repr(s)) for n, s in specs.items()), tolerated]
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


def _rejects(draft: Draft, tables: dict[str, DataFrame], tolerated: float) -> int:
    """How many rows do not fit their types, counted while they were sorted out; raises beyond the tolerated share."""
    total = 0
    for name in tables:
        found = draft.measures(f"sorted_{name}")
        total += found["rejected"]
        if found["rejected"] > tolerated * found["rows"]:
            raise TooManyRejected(f"{name}: {found['rejected']} of {found['rows']} rows do not fit their types")
    return total


def run_batch(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    as_of: dt.date,
    specs: dict[str, TableSpec] = SPECS,
    tolerated: float = 0.0,
    publish_failing: bool = False,
) -> BatchResult:
    """Check the inputs, load them, build and test the marts, score them, publish them and log the run.

    The fact takes in newer orders, and the product history goes on from the last run; the other
    marts are built anew. Orders without a calendar date get one anchored on ``as_of``.

    Up to a share ``tolerated`` of an input's rows may not fit its types: they are kept as rejected rows, counted in
    the run's record, and the rest is checked and loaded. By default none may.

    Everything is written to a draft. Failing table tests leave the published marts as they were, unless
    ``publish_failing``; the result then shows the draft's. A batch that broke off goes on where it
    was, if it is run again over the same inputs. A failing batch raises after the failed run is logged.
    """
    started = _now()
    ops_dir = f"{out_dir}/ops"
    failed = 0
    bound_tasks(spark, stored_bytes(spark, raw_dir))
    try:
        inventory = source_inventory(spark, raw_dir)
        require_sources(inventory)
        tables = TableSet(spark, f"{out_dir}/warehouse")
        draft = tables.draft(inputs_key(spark, raw_dir, as_of, specs, tolerated))

        # Parsing is the dear part of a CSV: each file is read once here, and the rest works on the copy.
        text = {
            name: draft.write(f"text_{name}", lambda df=df: with_current_names(df))
            for name, df in read_text(spark, raw_dir).items()
        }
        # Columns that are missing are the validation's to report.
        whole = {name: df for name, df in text.items() if set(COLUMN_TYPES[name]) <= set(df.columns)}
        for name, df in whole.items():
            draft.write(
                f"sorted_{name}", lambda df=df, name=name: sorted_out(df, name), by="rejected",
                sums={"rejected": F.col("rejected").cast("int")},
            )
        failed = sum(draft.measures(f"sorted_{name}")["rejected"] for name in whole)
        checked = text
        if tolerated > 0:
            _rejects(draft, whole, tolerated)
            checked = {**text, **{name: df.where(F.size(problems(df, name)) == 0) for name, df in whole.items()}}
        validation = draft.write("validation", lambda: validate_tables(checked, specs))
        require_valid(validation)
        _rejects(draft, whole, tolerated)

        def personal() -> DataFrame:
            scans = [pii_scan(name, text_columns(name, df)) for name, df in {**text, **other_inputs(spark, raw_dir)}.items()]
            return reduce(DataFrame.unionByName, scans)

        personal_data = pii_summary(draft.write("personal_data", personal))

        loaded = {f"stg_{name}": accepted(draft.read(f"sorted_{name}"), name) for name in text}
        warehouse = Warehouse(
            orders=staging.anchored_dates(staging.stg_orders(loaded["stg_orders"]), as_of),
            order_products=staging.stg_order_products(loaded["stg_order_products"]),
            products=staging.stg_products(loaded["stg_products"]),
            aisles=loaded["stg_aisles"],
            departments=loaded["stg_departments"],
            as_of=as_of,
            real_names=True,
        )
        marts = warehouse.draft(draft)

        tests = draft.write("tests", lambda: assertions.run_tests(marts))
        fct = marts["fct_orders"]
        scorecard = draft.write("scorecard", lambda: dq_scorecard(fct))
        measured = scorecard.agg(
            F.max("quality_score").alias("score"),
            F.max(F.when(F.col("metric_name") == "row_count", F.col("metric_value"))).alias("n"),
        ).first()
        broken = [f"{r.table_name}.{r.column_name}: {r.category}" for r in tests.where("NOT passed").collect()]
        if broken and not publish_failing:
            raise TestsFailed("; ".join(sorted(broken)))
        draft.publish(as_of=str(as_of), inputs=draft.key)
        run = _record_run(spark, ops_dir, started, measured.score, int(measured.n), "success", rejected_rows=failed)
        metrics = scorecard.withColumn("metric_id", F.expr("uuid()")).withColumn(
            "run_id", run.select("run_id").scalar()
        )
        append_ops_table(metrics.withColumn("created_at", F.current_timestamp()), f"{ops_dir}/data_quality_metrics")
        changes = row_count_changes(spark, ops_dir, run)
    except Exception as error:
        _record_run(spark, ops_dir, started, 0.0, 0, "failed", str(error), failed)
        raise
    counted = [(n, draft.rows(t)) for n, t in (("fact_orders", "fct_orders"), ("dim_users", "dim_users"), ("dim_products", "dim_products"))]
    return BatchResult(
        inventory=inventory,
        validation=validation,
        rejected=reduce(DataFrame.unionByName, [rejected(draft.read(f"sorted_{name}"), name) for name in whole]),
        personal_data=personal_data,
        marts=marts,
        tests=tests,
        scorecard=scorecard,
        counts=spark.createDataFrame(counted, "table_name string, row_count long"),
        run=run,
        breaches=sla_breaches(run),
        changes=changes,
    )
