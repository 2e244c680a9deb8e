"""The registered queries: every operator over the tables of one folder.

Each entry takes (spark, folder) and returns a DataFrame. Doubles are rounded to six
digits, so results can be compared across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.numbers import rows, steady
from tillroll.operators import assertions, daily_states, history, scorecard, sequence, validation
from tillroll.operators.personal_data import pii_scan, pii_summary
from tillroll.operators.sequence import derive_reordered
from tillroll.operators.upsert import upsert_fact
from tillroll.plans import dashboards, headlines, marts, runs
from tillroll.plans.batch import run_batch
from tillroll.plans.warehouse import MARTS, Warehouse
from tillroll.session import bound_tasks, scratch_dir, stored_bytes, tune
from tillroll.sinks import tables
from tillroll.sources.inference import infer_types
from tillroll.sources.raw import COLUMN_TYPES, CSV_OPTIONS, STAGING_TABLES, accepted, load_staging, rejected, sorted_out, source_inventory
from tillroll.sources.standins import Shop
from tillroll.streaming import arrivals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered queries.
HISTORY_START = dt.date(1995, 1, 1)
HISTORY_CHANGE = dt.date(1997, 1, 1)
BATCH_DAY = dt.date(2024, 1, 1)
OPS_DAY = dt.date(2024, 1, 25)
STICKY_SHARE = 0.5
ADHOC = (
    "SELECT p.department_id, p.product_id, p.product_name, count(*) AS times_ordered "
    "FROM fct_orders f JOIN dim_products p ON f.product_id = p.product_id "
    "GROUP BY ALL ORDER BY times_ordered DESC, p.product_id"
)


class Store(Warehouse, Shop):
    """Staging stand-ins and the marts over them."""

    def __init__(self, spark: SparkSession, folder: str):
        Shop.__init__(self, spark, folder)
        self.as_of = HISTORY_START
        self.real_names = False

    # Staging frames come from the stand-ins, marts from the warehouse.
    orders = Shop.__dict__["orders"]
    order_products = Shop.__dict__["order_products"]
    products = Shop.__dict__["products"]
    aisles = Shop.__dict__["aisles"]
    departments = Shop.__dict__["departments"]

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)

    def stored(self, names) -> dict[str, DataFrame]:
        """Staging and the named marts, built and written once per session and folder: checks scan tables, not plans."""
        stored = self.shared("warehouse", dict)
        missing = [n for n in MARTS if n in names and n not in stored]
        if missing or not stored:
            stored.update(self.store(self.scratch("warehouse"), missing, stored))
        return {n: df for n, df in stored.items() if n in names or n.startswith("stg_")}


def query(function, name: str | None = None):
    """Register a query under its function's name, or under the given one."""
    name = name or function.__name__

    def run(spark: SparkSession, folder: str) -> DataFrame:
        bound_tasks(tune(spark), stored_bytes(spark, *[f"{folder}/{t}.parquet" for t in ("orders", "lineitem")]))
        return steady(function(Store(spark, folder)))

    run.__name__ = name
    run.__doc__ = function.__doc__
    QUERIES[name] = run
    return function


def query_named(name: str):
    return lambda function: query(function, name)


def union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- sources and sinks ------------------------------------------------------


@query_named("load_staging")
def load_staging_tables(s: Store) -> DataFrame:
    """The CSV inputs loaded to staging: rows, keys and values per table."""
    loaded = load_staging(s.spark, s.write_raw_files(s.scratch("raw")))
    measures = {
        "stg_orders": ("order_id", "order_dow + order_hour_of_day + coalesce(days_since_prior_order, 0)"),
        "stg_products": ("product_id", "aisle_id + department_id + length(product_name)"),
        "stg_aisles": ("aisle_id", "length(aisle_name)"),
        "stg_departments": ("department_id", "length(department_name)"),
        "stg_order_products": ("order_id", "product_id + add_to_cart_order + reordered"),
    }
    return union(
        loaded[t].agg(
            F.lit(t).alias("table_name"),
            rows().alias("row_count"),
            F.sum(F.col(key).cast("long")).alias("key_sum"),
            F.sum(F.expr(value).cast("long")).alias("value_sum"),
        )
        for t, (key, value) in measures.items()
    )


@query_named("source_inventory")
def source_files(s: Store) -> DataFrame:
    """Inventory of the inputs, one required file being absent."""
    raw = s.write_raw_files(s.scratch("raw"))
    wanted = [*STAGING_TABLES, "returns.csv"]
    return source_inventory(s.spark, raw, wanted).select(
        "name", "rows", "present", (F.col("size_mb") > 0).alias("has_bytes")
    )


@query
def stg_orders(s: Store) -> DataFrame:
    return s.orders


@query
def stg_products(s: Store) -> DataFrame:
    return s.products


@query
def stg_order_products(s: Store) -> DataFrame:
    return s.order_products


@query
def write_mart(s: Store) -> DataFrame:
    """A mart written twice and read back."""
    path = s.scratch("dim_products")
    tables.write_mart(s.dim_products, path, audit=["created_at"])
    return tables.write_mart(s.dim_products, path, audit=["created_at"]).drop("created_at")


@query_named("upsert_fact")
def upsert_fact_batches(s: Store) -> DataFrame:
    """A first load up to 3/4 of the order ids, then a batch from 1/4 on, taken in from 1/2 on."""
    highest = s.dated_orders.agg(F.max("order_id")).scalar()
    fct = s.fct_orders
    existing = fct.where(F.col("order_id") * 4 <= highest * 3)
    batch = fct.where(F.col("order_id") * 4 > highest).withColumn(
        "add_to_cart_order", F.col("add_to_cart_order") + 1000
    )
    return upsert_fact(existing, batch, after_order=F.floor(highest / 2))


@query
def merge_fact_blocks(s: Store) -> DataFrame:
    """The same batches merged into a stored fact, rewriting the touched blocks only."""
    highest = s.dated_orders.agg(F.max("order_id").alias("top"))
    top = highest.scalar()
    path = s.scratch("fact")
    tables.write_fact(s.fct_orders.where(F.col("order_id") * 4 <= top * 3), path, orders_per_block=5000)
    batch = s.fct_orders.where(F.col("order_id") * 4 > top).withColumn(
        "add_to_cart_order", F.col("add_to_cart_order") + 1000
    )
    merged = tables.merge_into_fact(s.spark, path, batch, F.floor(top / 2), orders_per_block=5000)
    return merged.drop("order_block")


@query
def append_run_log(s: Store) -> DataFrame:
    """Run records appended as JSON lines in two batches and read back."""
    path = s.scratch("run-log")
    log = s.batch_runs.select(
        "run_id", F.col("run_date").cast("string"), "duration_seconds", "rows_processed", "sla_met",
        "quality_score", "status",
    )
    tables.append_run_log(log.where("status = 'success'"), path)
    tables.append_run_log(log.where("status <> 'success'"), path)
    return s.spark.read.schema(log.schema).json(path)


@query
def append_ops_table(s: Store) -> DataFrame:
    """Run records appended to the operations store in two batches and read back."""
    path = s.scratch("ops")
    log = s.batch_runs.select("run_id", "run_date", "duration_seconds", "sla_met", "status")
    tables.append_ops_table(log.where("sla_met"), path)
    tables.append_ops_table(log.where("NOT sla_met"), path)
    return s.spark.read.parquet(path)


@query
def publish_marts(s: Store) -> DataFrame:
    published = {name: getattr(s, name) for name in tables.PUBLISHED}
    return tables.publish_marts(published, s.scratch("published"))


# --- validation -------------------------------------------------------------


def _raw_catalogue(s: Store) -> DataFrame:
    """Part rows as text, with a renamed column, an undeclared one and a part-numeric aisle."""
    small = F.col("p_size") < 10
    return s.table("part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.when(small, F.col("p_brand")).otherwise(F.col("p_size").cast("string")).alias("aisle_id"),
        F.col("p_brand").alias("department_id"),
        F.col("p_type").alias("kind"),
    )


@query
def check_columns(s: Store) -> DataFrame:
    return validation.check_columns(_raw_catalogue(s), validation.SPECS["products"])


@query
def check_types(s: Store) -> DataFrame:
    return validation.check_types(_raw_catalogue(s), validation.SPECS["products"])


@query
def check_min_max(s: Store) -> DataFrame:
    return validation.check_min_max(
        s.orders,
        {
            "order_id": (1, None),
            "order_dow": (0, 6),
            "order_hour_of_day": (6, 22),
            "days_since_prior_order": (0, 365),
        },
    )


@query
def check_unique(s: Store) -> DataFrame:
    lines = s.table("lineitem").select(F.col("l_orderkey").alias("line_order"))
    return union(
        [
            validation.check_unique(s.orders, "order_id"),
            validation.check_unique(s.products, "product_name"),
            validation.check_unique(s.orders, "days_since_prior_order"),
            validation.check_unique(lines, "line_order"),
        ]
    )


@query
def check_values(s: Store) -> DataFrame:
    return union(
        [
            validation.check_values(s.orders, "order_dow", range(1, 6)),
            validation.check_values(s.order_products, "reordered", (0, 1)),
            validation.check_values(s.orders, "order_number", range(1, 11)),
        ]
    )


@query
def check_min_rows(s: Store) -> DataFrame:
    return union(
        validation.check_min_rows(df, n).withColumn("table_name", F.lit(name))
        for name, df, n in [
            ("orders", s.dated_orders, 100_000),
            ("products", s.products, 1_000),
            ("order_products", s.order_products, 10_000),
        ]
    )


def _staging(s: Store) -> dict[str, DataFrame]:
    return {
        "orders": s.orders,
        "products": s.products,
        "aisles": s.aisles,
        "departments": s.departments,
        "order_products": s.order_products,
    }


@query
def validate_tables(s: Store) -> DataFrame:
    return validation.validate_tables(_staging(s))


@query
def validation_summary(s: Store) -> DataFrame:
    return validation.validation_summary(validation.validate_tables(_staging(s)))


def _text_tables(s: Store) -> dict[str, DataFrame]:
    return {name: s.table(name) for name in ("documents", "conversations", "pages", "customer")}


@query_named("pii_scan")
def pii_scan_documents(s: Store) -> DataFrame:
    return pii_scan("documents", s.table("documents"))


@query_named("pii_summary")
def pii_summary_tables(s: Store) -> DataFrame:
    return pii_summary(union(pii_scan(name, df) for name, df in _text_tables(s).items()))


# --- table tests and quality ------------------------------------------------


@query
def test_not_null(s: Store) -> DataFrame:
    stored = s.stored(assertions.NOT_NULL)
    declared = union(
        assertions.not_null(t, stored[t], columns) for t, columns in assertions.NOT_NULL.items()
    )
    gaps = assertions.not_null("stg_orders_gap", s.orders, ["days_since_prior_order"])
    return declared.unionByName(gaps)


@query
def test_unique(s: Store) -> DataFrame:
    stored = s.stored(assertions.UNIQUE)
    declared = [
        assertions.unique(t, stored[t], c) for t, columns in assertions.UNIQUE.items() for c in columns
    ]
    return union([*declared, assertions.unique("stg_products_name", stored["stg_products"], "product_name")])


@query
def test_row_count_gt_zero(s: Store) -> DataFrame:
    undated = s.table("lineitem").where(F.col("l_shipdate").isNull())
    return assertions.row_count_gt_zero("fct_orders", s.fct_orders).unionByName(
        assertions.row_count_gt_zero("undated_lines", undated)
    )


@query
def test_null_rate(s: Store) -> DataFrame:
    return union(
        assertions.null_rate(t, df, c)
        for t, df, c in [
            ("stg_orders", s.orders, "days_since_prior_order"),
            ("stg_orders", s.orders, "user_id"),
        ]
    )


@query
def test_relationships(s: Store) -> DataFrame:
    parents = assertions.FACT_PARENTS
    stored = s.stored(["fct_orders", *parents])
    fct = stored["fct_orders"]
    checks = [assertions.relationships("fct_orders", fct, t, stored[t], c) for t, c in parents.items()]
    # Orders without lines: the one relation that fails on this data.
    checks.append(assertions.relationships("stg_orders", stored["stg_orders"], "fct_orders", fct, "order_id"))
    return union(checks)


@query
def test_accepted_range(s: Store) -> DataFrame:
    daily = s.daily_product_metrics
    return union(
        [
            assertions.accepted_range("dim_products", s.dim_products, "reorder_rate", 0, 1),
            assertions.accepted_range("daily_product_metrics", daily, "daily_reorder_rate", 0, 100),
            assertions.accepted_range("dim_users", s.dim_users, "reorder_rate", 0, 0.5),
        ]
    )


@query
def test_metric_invariants(s: Store) -> DataFrame:
    return assertions.metric_invariants(s.daily_product_metrics)


@query
def test_summary(s: Store) -> DataFrame:
    return assertions.summary(assertions.run_tests(s.stored(MARTS)))


@query
def dq_null_rate(s: Store) -> DataFrame:
    return scorecard.dq_null_rate(s.fct_orders)


@query
def dq_duplicate_count(s: Store) -> DataFrame:
    return scorecard.dq_duplicate_count(s.fct_orders)


@query
def dq_row_count(s: Store) -> DataFrame:
    return scorecard.dq_row_count(s.fct_orders)


@query
def dq_reorder_rate(s: Store) -> DataFrame:
    return scorecard.dq_reorder_rate(s.fct_orders)


@query
def dq_scorecard(s: Store) -> DataFrame:
    return scorecard.dq_scorecard(s.fct_orders)


@query
def dq_row_count_change(s: Store) -> DataFrame:
    return scorecard.dq_row_count_change(s.row_count_history)


@query
def warehouse_counts(s: Store) -> DataFrame:
    return runs.table_counts(fact_orders=s.fct_orders, dim_users=s.dim_users, dim_products=s.dim_products)


# --- star schema and marts --------------------------------------------------


def _mart(name: str):
    def build(s: Store) -> DataFrame:
        return getattr(s, name)

    build.__name__ = name
    return query(build)


for _name in (
    "fct_orders",
    "dim_users",
    "dim_products",
    "dim_products_scd",
    "dim_departments",
    "dim_aisles",
    "dim_time",
    "product_funnel",
    "user_retention",
    "department_performance",
    "department_dow_cohorts",
    "daily_product_metrics",
):
    _mart(_name)


@query
def product_funnel_anchored(s: Store) -> DataFrame:
    """The funnel with days spread from an anchor date, for sources without order dates."""
    return marts.product_funnel(s.orders, s.order_products, s.products, anchor=BATCH_DAY)


def _merged_history(s: Store) -> DataFrame:
    """Two snapshots: aisle 1 appears, aisle 50 goes, aisles 20 to 29 move to another department."""
    aisle = F.col("aisle_id")
    before = s.products.where(aisle != 1)
    moved = F.when(aisle.between(20, 29), F.col("department_id") + 100).otherwise(F.col("department_id"))
    after = s.products.where(aisle != 50).withColumn("department_id", moved)
    opened = history.dim_products_scd(before, HISTORY_START)
    return history.scd2_merge(opened, after, HISTORY_CHANGE)


@query
def scd2_merge(s: Store) -> DataFrame:
    return _merged_history(s)


@query
def scd2_as_of(s: Store) -> DataFrame:
    """Lines by the department their product belonged to on the order date."""
    sold = s.order_products.select("order_id", "product_id").join(
        s.dated_orders.select("order_id", "order_date"), "order_id"
    )
    dated = sold.groupBy("product_id", "order_date").agg(rows().alias("lines"))
    return (
        history.scd2_as_of(_merged_history(s), dated, "order_date")
        .groupBy("department_id")
        .agg(F.sum("lines").alias("lines"), F.countDistinct("product_id").alias("products"))
    )


@query_named("derive_reordered")
def derive_reordered_flag(s: Store) -> DataFrame:
    return derive_reordered(s.dated_orders, s.order_products)


@query
def derive_order_sequence(s: Store) -> DataFrame:
    return s.orders.select("order_id", "user_id", "order_number", "days_since_prior_order")


# --- dashboards -------------------------------------------------------------


@query
def health_daily(s: Store) -> DataFrame:
    return dashboards.health_daily(s.fct_orders)


@query
def health_top_reorder(s: Store) -> DataFrame:
    return dashboards.health_top_reorder(s.fct_orders, s.dim_products)


@query
def health_department_share(s: Store) -> DataFrame:
    return dashboards.health_department_share(s.fct_orders, s.dim_products)


@query
def health_user_segments(s: Store) -> DataFrame:
    return dashboards.health_user_segments(s.dim_users)


@query
def retention_cohorts(s: Store) -> DataFrame:
    return dashboards.retention_cohorts(s.user_retention)


@query
def retention_order_frequency(s: Store) -> DataFrame:
    return dashboards.retention_order_frequency(s.user_retention)


@query
def retention_reorder_windows(s: Store) -> DataFrame:
    return dashboards.retention_reorder_windows(s.fct_orders)


@query
def retention_segment_rate(s: Store) -> DataFrame:
    return dashboards.retention_segment_rate(s.dim_users)


@query
def funnel_daily(s: Store) -> DataFrame:
    return dashboards.funnel_daily(s.product_funnel)


@query
def funnel_top_reordered(s: Store) -> DataFrame:
    return dashboards.funnel_top_reordered(s.fct_orders, s.dim_products)


@query
def funnel_department(s: Store) -> DataFrame:
    return dashboards.funnel_department(s.fct_orders, s.dim_products)


@query
def funnel_cart_composition(s: Store) -> DataFrame:
    return dashboards.funnel_cart_composition(s.fct_orders)


# --- run log ----------------------------------------------------------------


@query
def ops_latest_run(s: Store) -> DataFrame:
    return runs.ops_latest_run(s.batch_runs)


@query
def ops_sla_trend(s: Store) -> DataFrame:
    return runs.ops_sla_trend(s.batch_runs)


@query
def ops_quality_trend(s: Store) -> DataFrame:
    return runs.ops_quality_trend(s.batch_runs)


@query
def ops_volume(s: Store) -> DataFrame:
    return runs.ops_volume(s.batch_runs)


@query
def ops_table_counts(s: Store) -> DataFrame:
    return runs.ops_table_counts(s.fct_orders, s.dim_users, s.dim_products)


@query
def api_pipeline_health(s: Store) -> DataFrame:
    return runs.run_health(s.batch_runs)


@query
def api_recent_runs(s: Store) -> DataFrame:
    return runs.recent_runs(s.batch_runs)


@query
def log_runs(s: Store) -> DataFrame:
    """Run records from start and end times; the random ids are left out."""
    raw = s.batch_runs.select(
        "started_at", "completed_at", "rows_processed", "quality_score", "status", "error_message", "notes"
    )
    return runs.log_runs(raw).drop("run_id")


@query
def sla_breaches(s: Store) -> DataFrame:
    return runs.sla_breaches(s.batch_runs)


@query
def sla_compliance(s: Store) -> DataFrame:
    return runs.sla_compliance(s.batch_runs, OPS_DAY)


# --- headline figures -------------------------------------------------------


@query
def api_metrics(s: Store) -> DataFrame:
    return headlines.api_metrics(s.fct_orders)


@query
def api_daily_stats(s: Store) -> DataFrame:
    return headlines.api_daily_stats(s.fct_orders)


@query
def api_top_products(s: Store) -> DataFrame:
    return headlines.api_top_products(s.fct_orders, s.dim_products)


@query
def adhoc_select(s: Store) -> DataFrame:
    """A caller's SELECT: its first hundred rows, each with the full row count."""
    headlines.register_views(fct_orders=s.fct_orders, dim_products=s.dim_products)
    answer = headlines.adhoc_select(s.spark, ADHOC)
    return answer.rows.withColumn("row_count", answer.row_count.scalar())


@query
def reorder_rate_overall(s: Store) -> DataFrame:
    return headlines.reorder_rate_overall(s.fct_orders)


@query
def habit_products(s: Store) -> DataFrame:
    return headlines.habit_products(s.fct_orders, share=STICKY_SHARE)


@query
def peak_day(s: Store) -> DataFrame:
    return headlines.peak_day(s.fct_orders)


@query
def day_vs_week_avg(s: Store) -> DataFrame:
    return headlines.day_vs_week_avg(s.fct_orders)


@query
def sticky_products(s: Store) -> DataFrame:
    return headlines.sticky_products(s.fct_orders, STICKY_SHARE)


@query
def product_reorder_rate(s: Store) -> DataFrame:
    return headlines.product_reorder_rate(s.fct_orders)


@query
def avg_basket_size(s: Store) -> DataFrame:
    return headlines.avg_basket_size(s.fct_orders)


@query
def product_penetration(s: Store) -> DataFrame:
    return headlines.product_penetration(s.fct_orders)


@query
def product_day_drilldown(s: Store) -> DataFrame:
    """Metrics of product 1 on the last day it was sold."""
    last = s.fct_orders.where(F.col("product_id") == 1).agg(F.max("order_date")).scalar()
    return marts.product_day_drilldown(s.daily_product_metrics, 1, last)


# --- day by day -------------------------------------------------------------


def _batches(s: Store) -> list[DataFrame]:
    """Orders and lines in three batches, each with newer orders than the one before."""
    top = s.dated_orders.agg(F.max("order_id").alias("top")).scalar()
    third = F.floor(F.col("order_id") * 3 / (top + 1))
    return [s.order_lines.where(third == k) for k in range(3)]


def _three_days(s: Store) -> dict[str, DataFrame]:
    """The states after three batches, each published before the next."""

    def build() -> dict[str, DataFrame]:
        stored = tables.TableSet(s.spark, s.scratch("states"))
        for k, lines in enumerate(_batches(s)):
            draft = stored.draft(f"day{k}")
            daily_states.update_states(draft, lines)
            draft.publish()
        return {name: stored.read(name) for name in daily_states.STATES}

    return s.shared("states", build)


@query
def incremental_daily_metrics(s: Store) -> DataFrame:
    """Daily product metrics from states that three batches were added to."""
    return daily_states.daily_product_metrics(_three_days(s)["product_state"], s.dim_products)


@query
def incremental_product_funnel(s: Store) -> DataFrame:
    """The product funnel from the same states."""
    return daily_states.product_funnel(_three_days(s), s.products)


@query
def users_by_weekday(s: Store) -> DataFrame:
    """Distinct users per day of week, from the bits kept per day."""
    return daily_states.users_by(_three_days(s), "order_dow")


@query
def incremental_order_sequence(s: Store) -> DataFrame:
    """Orders numbered per user as they arrive in three batches, many of them late."""
    stored = tables.TableSet(s.spark, s.scratch("sequence"))
    batch = F.pmod(F.xxhash64("order_id"), F.lit(3))
    for k in range(3):
        draft = stored.draft(f"day{k}")
        sequence.extend_stored_sequence(draft, s.dated_orders.where(batch == k), blocks=8)
        draft.publish()
    return stored.read("sequence").select("order_id", "user_id", "order_number", "days_since_prior_order")


@query
def rejected_rows(s: Store) -> DataFrame:
    """A file with text that does not fit: cells refused by column, and rows taken in."""
    folder, id_ = s.scratch("raw"), F.col("order_id")
    text = s.orders.select(*[F.col(c).cast("string").alias(c) for c in COLUMN_TYPES["orders"]])
    odd = text.withColumns(
        {
            "order_dow": F.when(id_ % 50 == 0, "Sunday").otherwise(F.col("order_dow")),
            "order_hour_of_day": F.when(id_ % 70 == 0, "noon").otherwise(F.col("order_hour_of_day")),
        }
    )
    odd.write.options(**CSV_OPTIONS).csv(f"{folder}/orders.csv")
    draft = tables.TableSet(s.spark, s.scratch("loaded")).draft()
    found = draft.write(
        "orders", lambda: sorted_out(s.spark.read.options(**CSV_OPTIONS).csv(f"{folder}/orders.csv"), "orders"), by="rejected",
        sums={"rejected": F.col("rejected").cast("int")},
    )
    counted = draft.measures("orders")
    cells = rejected(found, "orders").groupBy("column_name", "value", "wanted").agg(rows().alias("row_count"))
    taken = accepted(found, "orders").agg(rows().alias("row_count"))
    failed = s.spark.createDataFrame([(counted["rejected"],)], "row_count long")
    none = F.lit(None).cast("string")
    return cells.unionByName(taken.select(F.lit("accepted").alias("column_name"), none.alias("value"), none.alias("wanted"), "row_count")).unionByName(
        failed.select(F.lit("rejected").alias("column_name"), none.alias("value"), none.alias("wanted"), "row_count")
    )


@query
def publish_changes(s: Store) -> DataFrame:
    """A copy of the products by department, then brought up to date after every fifth department changed."""
    target = tables.TableSet(s.spark, s.scratch("copy"))
    tables.publish_changes("dim_products", s.dim_products, target, "department_id")
    renamed = F.when(F.col("department_id") % 5 == 0, F.concat("product_name", F.lit(" (new)"))).otherwise(F.col("product_name"))
    return tables.publish_changes("dim_products", s.dim_products.withColumn("product_name", renamed), target, "department_id")


@query_named("infer_types")
def inferred_types(s: Store) -> DataFrame:
    """Types of text columns of the catalogue and the orders, against declared ones."""
    size = F.col("p_size")
    parts = s.table("part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(size < 10, F.col("p_brand")).otherwise(size.cast("string")).alias("aisle_id"),
        F.when(size > 1, F.concat(size.cast("string"), F.lit(".50"))).alias("price"),
        F.when(size > 100, "never").alias("nothing"),
        (size > 10).cast("string").alias("large"),
    )
    day = F.col("o_orderdate").cast("date").cast("string")
    orders = s.table("orders").select(day.alias("order_date"), F.concat(day, F.lit(" 10:30:00")).alias("ordered_at"))
    catalogue = infer_types(parts, {"product_id": "long", "aisle_id": "int", "price": "long", "nothing": "int", "large": "boolean"})
    return catalogue.unionByName(infer_types(orders, {"order_date": "timestamp", "ordered_at": "date"}))


@query
def stream_arrivals(s: Store) -> DataFrame:
    """Lines that arrive in three drops of files, the second of which comes twice."""
    folder, target, checkpoint = s.scratch("drops"), s.scratch("lines"), s.scratch("checkpoint")
    third = F.pmod(F.xxhash64("order_id", "product_id"), F.lit(3))
    for k in (0, 1, 1, 2):
        s.order_products.where(third == k).write.mode("append").options(**CSV_OPTIONS).csv(f"{folder}/drop{k}")
        arrivals.take_in(s.spark, folder, target, checkpoint, orders_per_block=5000)
    return tables.read_fact(s.spark, target).drop("order_block")


# --- the batch --------------------------------------------------------------


@query_named("run_batch")
def run_batch_job(s: Store) -> DataFrame:
    """The whole batch over CSV inputs: rows per mart, checks passed, score and run record."""
    raw = s.write_raw_files(s.scratch("raw"))
    # These tables count their ids from 0, and any number of rows will do.
    specs = {
        name: replace(
            spec,
            min_rows=1,
            ranges={c: (0 if c.endswith("_id") else low, high) for c, (low, high) in spec.ranges.items()},
        )
        for name, spec in validation.SPECS.items()
    }
    result = run_batch(s.spark, raw, s.scratch("batch"), BATCH_DAY, specs)
    built = {n: df for n, df in result.marts.items() if not n.startswith("stg_")}
    facts = [
        runs.table_counts(**built).select(F.col("table_name").alias("item"), F.col("row_count").alias("value")),
        result.validation.agg(F.lit("rules_checked").alias("item"), rows().alias("value")),
        result.tests.agg(
            F.lit("tests_passed").alias("item"), F.count(F.when(F.col("passed"), 1)).alias("value")
        ),
        result.run.select(
            F.lit("run_rows_processed").alias("item"), F.col("rows_processed").alias("value")
        ),
        result.breaches.agg(F.lit("sla_breaches").alias("item"), rows().alias("value")),
    ]
    return union(facts)
