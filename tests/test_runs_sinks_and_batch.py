import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillroll.operators.validation import SPECS, ValidationFailed
from tillroll.plans import headlines, runs
from tillroll.plans.batch import run_batch
from tillroll.session import scratch_dir
from tillroll.sinks import tables
from tillroll.sources.raw import MissingInput, load_staging, read_text, require_sources, source_inventory

T0 = dt.datetime(2024, 5, 1, 2, 0)


@pytest.fixture(scope="module")
def log(spark):
    def run(i, start, seconds, score=1.0, status="success", n=1000):
        return (start, start + dt.timedelta(seconds=seconds), n, score, status)

    raw = spark.createDataFrame(
        [
            run(1, T0, 1800),
            run(2, T0, 1801.5, 0.5, "failed"),
            run(3, T0 + dt.timedelta(days=2), 60.25, 0.75, n=1234567),
        ],
        "started_at timestamp_ntz, completed_at timestamp_ntz, rows_processed long, quality_score double, status string",
    )
    return tables.write_mart(runs.log_runs(raw), scratch_dir(spark, "runs"))


def test_log_runs(log, by):
    got = by(log, "duration_seconds")
    assert got[1800]["sla_met"] and not got[1801]["sla_met"]
    assert got[60]["notes"] == "Quality score: 0.75, Fact rows: 1,234,567"
    assert got[60]["run_date"] == dt.date(2024, 5, 3)
    assert len({r["run_id"] for r in got.values()}) == 3


def test_breaches_and_compliance(log):
    assert [r.alert for r in runs.sla_breaches(log).collect()] == ["SLA breached: 1801s > 1800s"]
    week = runs.sla_compliance(log, dt.date(2024, 5, 8)).collect()
    # A day without runs has no row; the first day is still within seven days.
    assert [(r.run_date.day, r.sla_compliance_pct) for r in week] == [(3, 100.0), (1, 50.0)]
    assert runs.sla_compliance(log, dt.date(2024, 5, 9)).count() == 1


def test_trends(log):
    latest = runs.ops_latest_run(log).first()
    assert latest.duration_seconds == 60
    first_day = runs.ops_sla_trend(log).collect()[1]
    assert (first_day.total_runs, first_day.sla_met_count, first_day.avg_duration_sec) == (2, 1, 1801.0)
    assert [r.run_count for r in runs.ops_volume(log).collect()] == [1, 1]
    assert runs.ops_quality_trend(log).collect()[1].min_quality_score == 0.5
    health = runs.run_health(log).first()
    assert (health.sla_threshold_mins, health.sla_compliance_rate) == (30.0, 66.7)
    assert health.avg_duration_mins == 20.3
    recent = runs.recent_runs(log, 2).collect()
    assert len(recent) == 2 and recent[0].duration_mins == 1.0 and recent[0].rows == 1234567


def test_latest_run_breaks_ties_by_id(log):
    tied = log.where(F.col("run_date") == dt.date(2024, 5, 1))
    assert runs.ops_latest_run(tied).first().run_id == tied.agg(F.max("run_id")).first()[0]


def test_run_log_lines(spark, log):
    path = scratch_dir(spark, "log")
    tables.append_run_log(log, path)
    tables.append_run_log(log, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == 6 and {"run_id", "sla_met", "error_message"} <= set(lines[0])


def test_ops_table_in_the_catalog(spark, log):
    tables.append_ops_table(log, "ops_runs")
    tables.append_ops_table(log, "ops_runs")
    assert spark.table("ops_runs").count() == 6


def test_mart_table_in_the_catalog(spark):
    first = tables.save_mart_table(spark.range(5), "numbers", audit=["created_at"])
    assert first.columns == ["id", "created_at"]
    assert tables.save_mart_table(spark.range(3), "numbers").count() == 3


def test_publish_replaces(spark):
    target = scratch_dir(spark, "published")
    tables.publish_marts({"a": spark.range(5)}, target, ["a"])
    assert tables.publish_marts({"a": spark.range(2)}, target, ["a"]).first().row_count == 2
    assert spark.read.parquet(f"{target}/a").count() == 2


# --- ad-hoc SELECTs ---------------------------------------------------------


@pytest.fixture(scope="module")
def views(spark):
    headlines.register_views(
        fct_orders=spark.range(250).selectExpr("id AS order_id", "current_timestamp() AS created_at")
    )


@pytest.mark.parametrize(
    "text",
    [
        "SELECT order_id, created_at FROM fct_orders ORDER BY order_id",
        "WITH x AS (SELECT * FROM fct_orders) SELECT * FROM x ORDER BY order_id -- drop nothing",
        "SELECT order_id, created_at FROM (SELECT * FROM fct_orders WHERE EXISTS (SELECT 1 FROM fct_orders)) ORDER BY order_id",
        "SELECT f.order_id, f.created_at FROM fct_orders f JOIN (SELECT max(order_id) AS top FROM fct_orders) t "
        "ON f.order_id <= t.top GROUP BY ALL HAVING count(*) > 0 ORDER BY 1",
    ],
)
def test_select_gives_first_rows_and_full_count(spark, views, text):
    answer = headlines.adhoc_select(spark, text)
    rows = answer.rows.collect()
    assert answer.columns == ["order_id", "created_at"]
    assert [r.order_id for r in rows] == list(range(100))
    assert answer.row_count.first().row_count == 250


@pytest.mark.parametrize(
    "text",
    [
        "DROP VIEW fct_orders",
        "CREATE OR REPLACE TEMP VIEW v AS SELECT 1",
        "INSERT INTO fct_orders VALUES (1, now())",
        "SELECT 1; SELECT 2",
        "SELECT 1) AS x; DROP VIEW fct_orders; --",
        "SET spark.sql.ansi.enabled=false",
        "CACHE TABLE fct_orders",
        "EXPLAIN SELECT 1",
        "TRUNCATE TABLE fct_orders",
        "BEGIN SELECT 1; END",
        "SHOW TABLES",
        "SELECT TRANSFORM(order_id) USING 'cat' AS (x) FROM fct_orders",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.dir')",
        "SELECT (SELECT try_reflect('java.lang.System', 'exit', 1)) AS x FROM fct_orders",
        "SELECT order_id FROM fct_orders WHERE order_id IN (SELECT java_method('a.B', 'c'))",
        "SELECT * FROM text.`/etc/hostname`",
        "SELECT * FROM parquet.`/tmp/x`",
        "WITH x AS (SELECT * FROM elsewhere) SELECT * FROM x",
        "SELECT 1 AS a) AS x, (SELECT 2 AS b",
        "",
    ],
)
def test_anything_else_is_refused(spark, views, text):
    with pytest.raises(headlines.NotASelect):
        headlines.adhoc_select(spark, text)
    assert spark.catalog.tableExists("fct_orders")


@pytest.mark.parametrize("text", ["SELECT nowhere FROM fct_orders"])
def test_other_errors_are_not_hidden(spark, views, text):
    with pytest.raises(AnalysisException) as caught:
        headlines.adhoc_select(spark, text)
    assert not isinstance(caught.value, headlines.NotASelect)


# --- inputs and the batch ---------------------------------------------------

FILES = {
    "orders.csv": "order_id,user_id,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
    "1,100,1,0,8,\n2,100,2,1,9,7.0\n3,200,1,6,23,\n",
    "products.csv": 'product_id,product_name,aisle_id,department_id\n10,"Milk, whole",1,5\n20,Pears,2,6\n',
    "aisles.csv": "aisle_id,aisle\n1,dairy\n2,fruit\n",
    "departments.csv": "department_id,department\n5,cold\n6,fresh\n",
    "order_products__train.csv": "order_id,product_id,add_to_cart_order,reordered\n1,10,1,0\n2,10,1,1\n2,20,2,0\n",
}
SMALL = {name: replace(spec, min_rows=1) for name, spec in SPECS.items()}


def write_inputs(folder, **changed):
    folder.mkdir()
    for name, text in {**FILES, **changed}.items():
        if text is not None:
            (folder / name).write_text(text)
    return str(folder)


def test_inventory(spark, tmp_path, by):
    raw = write_inputs(tmp_path / "raw", **{"aisles.csv": None, "departments.csv": "department_id,department\n"})
    inventory = source_inventory(spark, raw)
    got = by(inventory, "name")
    assert got["orders.csv"]["rows"] == 3
    assert got["orders.csv"]["size_mb"] == pytest.approx(len(FILES["orders.csv"]) / 1e6)
    assert got["departments.csv"]["rows"] == 0 and got["departments.csv"]["present"]
    assert not got["aisles.csv"]["present"] and got["aisles.csv"]["rows"] is None
    with pytest.raises(MissingInput, match="aisles.csv"):
        require_sources(inventory)


def test_load_staging(spark, tmp_path):
    loaded = load_staging(spark, write_inputs(tmp_path / "raw"))
    assert loaded["stg_aisles"].columns == ["aisle_id", "aisle_name", "loaded_at"]
    assert [r.days_since_prior_order for r in loaded["stg_orders"].orderBy("order_id").collect()] == [None, 7, None]
    assert dict(loaded["stg_orders"].dtypes)["days_since_prior_order"] == "int"
    assert loaded["stg_products"].where("product_name = 'Milk, whole'").count() == 1


def test_load_accepts_other_headers_and_orders(spark, tmp_path):
    raw = write_inputs(tmp_path / "raw", **{"aisles.csv": "aisle_name,aisle_id,shelf\ndairy,1,x\n"})
    assert load_staging(spark, raw)["stg_aisles"].drop("loaded_at").first().asDict() == {"aisle_id": 1, "aisle_name": "dairy"}


def test_load_fails_on_bad_text(spark, tmp_path):
    raw = write_inputs(tmp_path / "raw", **{"aisles.csv": "aisle_id,aisle\none,dairy\n"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_staging(spark, raw)["stg_aisles"].collect()


def test_text_has_the_file_headers(spark, tmp_path):
    assert read_text(spark, write_inputs(tmp_path / "raw"))["departments"].columns == ["department_id", "department"]


def test_batch(spark, tmp_path, by):
    out = str(tmp_path / "out")
    raw = write_inputs(tmp_path / "raw")
    result = run_batch(spark, raw, out, dt.date(2024, 5, 1), SMALL)
    assert by(result.counts, "table_name")["fact_orders"]["row_count"] == 3
    assert result.validation.where("NOT passed").count() == 0
    assert result.tests.where("NOT passed").count() == 0
    run = result.run.first()
    assert run.status == "success" and run.rows_processed == 3 and run.sla_met
    assert run.quality_score == 1.0 and result.breaches.count() == 0
    products = by(result.marts["dim_products"], "product_id")
    assert products[10]["aisle_name"] == "dairy" and products[10]["created_at"] is not None
    metrics = spark.read.parquet(f"{out}/ops/data_quality_metrics")
    assert metrics.count() == 4 and {r.run_id for r in metrics.collect()} == {run.run_id}
    assert spark.read.parquet(f"{out}/ops/pipeline_runs").count() == 1
    assert set(result.marts["fct_orders"].select("order_date").toPandas().order_date) == {
        dt.date(2024, 5, 2), dt.date(2024, 5, 3)
    }


def test_failed_batch_is_logged(spark, tmp_path):
    out = str(tmp_path / "out")
    raw = write_inputs(
        tmp_path / "raw",
        **{"orders.csv": FILES["orders.csv"].replace("3,200,1,6,23,", "3,200,1,7,24,")},
    )
    with pytest.raises(ValidationFailed):
        run_batch(spark, raw, out, dt.date(2024, 5, 1), SMALL)
    run = spark.read.parquet(f"{out}/ops/pipeline_runs").first()
    assert run.status == "failed" and "order_dow" in run.error_message
