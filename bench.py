"""Time the warehouse build and the dashboard queries; prints one JSON line.

The staging tables are written once from the given tables (timed as stage_load). Marts are
then built from staging, and dashboards read the marts, as in a daily run.
Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_REPEATS (best of that many runs).
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from tillroll.catalog import OPS_DAY, QUERIES, STICKY_SHARE, Store
from tillroll.operators import assertions
from tillroll.operators.personal_data import pii_scan
from tillroll.operators.scorecard import dq_scorecard
from tillroll.plans import dashboards as d
from tillroll.plans import headlines as h
from tillroll.plans import runs as r
from tillroll.plans.warehouse import MARTS, SHARED, Warehouse
from tillroll.session import build_session
from tillroll.sinks.buckets import write_bucketed
from tillroll.sinks.tables import merge_into_fact, write_fact, write_mart
from tillroll.sources import standins


def scale(folder: str) -> float | str:
    """The scale factor in a folder name such as sf0.1."""
    name = Path(folder).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": out,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, action):
        best = None
        for _ in range(repeats):
            start = time.perf_counter()
            result = action()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        return result

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # Start-up (class loading, first compilation) belongs to no query.
    raw = Store(spark, folder)
    run(raw.table("part").groupBy("p_size").count())

    parts = ("orders", "order_products", "products", "aisles", "departments")

    def load():
        standins.SHARED.clear()  # nothing stored by an earlier run counts
        source = Store(spark, folder)
        return [write_mart(getattr(source, p), f"{out}/stg_{p}") for p in parts]

    staged = Warehouse(*timed("stage_load", load), as_of=OPS_DAY)
    lines = timed("build_order_lines", lambda: write_bucketed(staged.order_lines, f"{out}/order_lines-{time.perf_counter_ns()}", "order_id"))
    stored = {}
    # Two aggregates of the lines, of which the department marts are made.
    for name in [*SHARED, *MARTS]:
        def build(name=name):
            # A fresh plan each time, over the marts stored so far.
            fresh = Warehouse(*[getattr(staged, p) for p in parts], as_of=OPS_DAY)
            fresh.__dict__.update(stored, order_lines=lines)
            return write_mart(getattr(fresh, name), f"{out}/{name}")

        stored[name] = timed(f"build_{name}", build)

    fct, users, products = stored["fct_orders"], stored["dim_users"], stored["dim_products"]
    log = raw.batch_runs
    for name, action in {
        "health_daily": lambda: d.health_daily(fct),
        "health_top_reorder": lambda: d.health_top_reorder(fct, products),
        "health_department_share": lambda: d.health_department_share(fct, products),
        "health_user_segments": lambda: d.health_user_segments(users),
        "retention_cohorts": lambda: d.retention_cohorts(stored["user_retention"]),
        "retention_reorder_windows": lambda: d.retention_reorder_windows(fct),
        "retention_segment_rate": lambda: d.retention_segment_rate(users),
        "funnel_daily": lambda: d.funnel_daily(stored["product_funnel"]),
        "funnel_top_reordered": lambda: d.funnel_top_reordered(fct, products),
        "funnel_department": lambda: d.funnel_department(fct, products),
        "funnel_cart_composition": lambda: d.funnel_cart_composition(fct),
        "api_metrics": lambda: h.api_metrics(fct),
        "api_daily_stats": lambda: h.api_daily_stats(fct),
        "api_top_products": lambda: h.api_top_products(fct, products),
        "product_reorder_rate": lambda: h.product_reorder_rate(fct, 1),
        "avg_basket_size": lambda: h.avg_basket_size(fct),
        "habit_products": lambda: h.habit_products(fct, share=STICKY_SHARE),
        "ops_sla_trend": lambda: r.ops_sla_trend(log),
        "sla_compliance": lambda: r.sla_compliance(log, OPS_DAY),
        "dq_scorecard": lambda: dq_scorecard(fct),
        "pii_scan": lambda: pii_scan("documents", raw.table("documents")),
    }.items():
        timed(name, lambda action=action: run(action()))

    # The whole build as a batch does it, marts written four at once; then tests, a merge and a batch.
    whole = timed("full_build", lambda: staged.store(f"{out}/full-{time.perf_counter_ns()}"))
    timed("test_summary", lambda: run(assertions.summary(assertions.run_tests(whole))))
    top = fct.agg(F.max("order_id")).first()[0]

    def merge():
        path = f"{out}/fact-{time.perf_counter_ns()}"
        write_fact(fct.where(F.col("order_id") <= top * 3 // 4), path, orders_per_block=50_000)
        start = time.perf_counter()
        merge_into_fact(spark, path, fct.where(F.col("order_id") > top // 4), top // 2, orders_per_block=50_000)
        merges.append(time.perf_counter() - start)

    merges: list[float] = []
    for _ in range(repeats):
        merge()
    times["merge_into_fact"] = round(min(merges), 3)
    timed("run_batch", lambda: run(QUERIES["run_batch"](spark, folder)))

    print(
        json.dumps(
            {
                "metric": "warehouse build and dashboard queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": scale(folder),
                "cpus": int(cpus),
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
