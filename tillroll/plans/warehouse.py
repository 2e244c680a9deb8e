"""All marts over one set of staging tables."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.history import dim_products_scd, scd2_merge
from tillroll.plans import marts, star
from tillroll.sinks.buckets import write_bucketed
from tillroll.sinks.tables import draft_fact, draft_merge, sorted_by, stamp, write_mart, write_marts
from tillroll.sinks.tablesets import Draft

MARTS = [
    "fct_orders",
    "dim_users",
    "dim_products",
    "dim_departments",
    "dim_aisles",
    "dim_time",
    "dim_products_scd",
    "product_funnel",
    "user_retention",
    "department_performance",
    "department_dow_cohorts",
    "daily_product_metrics",
]
READ_OTHER_MARTS = ["dim_products_scd", "daily_product_metrics"]
# Aggregates of the lines that several marts read.
SHARED = ["order_departments", "product_days"]
STAGING = ["orders", "order_products", "products", "aisles", "departments"]

# How marts are stored: daily metrics in ranges of days, whose statistics let a look at one day skip
# the other files; the fact in blocks of orders.
SORTED_BY = {"daily_product_metrics": ["order_date", "product_id"]}
AUDIT_COLUMNS = {
    **{name: ["created_at"] for name in MARTS},
    "dim_users": ["created_at", "updated_at"],
    "dim_products": ["created_at", "updated_at"],
}


class Warehouse:
    """Lazy marts. ``store`` writes them and returns frames that read what was written."""

    def __init__(
        self,
        orders: DataFrame,
        order_products: DataFrame,
        products: DataFrame,
        aisles: DataFrame,
        departments: DataFrame,
        as_of: dt.date,
        real_names: bool = False,
    ):
        self.orders = orders
        self.order_products = order_products
        self.products = products
        self.aisles = aisles
        self.departments = departments
        self.as_of = as_of
        self.real_names = real_names

    @cached_property
    def order_lines(self) -> DataFrame:
        return star.order_lines(self.orders, self.order_products)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return star.fct_orders(self.orders, self.order_products, self.products, self.order_lines)

    @cached_property
    def dim_users(self) -> DataFrame:
        return star.dim_users(self.orders, self.order_products, self.order_lines)

    @cached_property
    def dim_products(self) -> DataFrame:
        names = {"aisles": self.aisles, "departments": self.departments} if self.real_names else {}
        return star.dim_products(self.products, self.order_products, **names)

    @cached_property
    def dim_departments(self) -> DataFrame:
        return star.dim_departments(self.departments, self.products, self.order_products)

    @cached_property
    def dim_aisles(self) -> DataFrame:
        return star.dim_aisles(self.aisles, self.products)

    @cached_property
    def dim_time(self) -> DataFrame:
        return star.dim_time(self.orders)

    @cached_property
    def dim_products_scd(self) -> DataFrame:
        return dim_products_scd(self.dim_products, self.as_of)

    @cached_property
    def product_funnel(self) -> DataFrame:
        return marts.product_funnel(self.orders, self.order_products, self.products, lines=self.order_lines)

    @cached_property
    def user_retention(self) -> DataFrame:
        return marts.user_retention(self.orders)

    @cached_property
    def order_departments(self) -> DataFrame:
        return marts.order_departments(self.products, self.order_lines)

    @cached_property
    def product_days(self) -> DataFrame:
        return marts.product_days(self.order_lines)

    def _by_department(self, mart) -> DataFrame:
        return mart(self.orders, self.order_products, self.products, self.order_lines, self.order_departments, self.product_days)

    @cached_property
    def department_performance(self) -> DataFrame:
        return self._by_department(marts.department_performance)

    @cached_property
    def department_dow_cohorts(self) -> DataFrame:
        return self._by_department(marts.department_dow_cohorts)

    @cached_property
    def daily_product_metrics(self) -> DataFrame:
        return marts.daily_product_metrics(self.fct_orders, self.dim_products)

    def _over(self, staging: dict[str, DataFrame]) -> Warehouse:
        """The same marts over stored staging tables."""
        return Warehouse(*[staging[f"stg_{t}"] for t in STAGING], self.as_of, self.real_names)

    @staticmethod
    def _waves(names: list[str]) -> list[list[str]]:
        return [[n for n in names if n not in READ_OTHER_MARTS], [n for n in names if n in READ_OTHER_MARTS]]

    def store(self, folder: str, names: list[str] | None = None, before: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        """Write staging and marts; marts are built from the stored tables they read. What ``before`` holds is not made again."""
        names = MARTS if names is None else names
        stored = dict(before or {})
        if "order_lines" not in stored:
            stored.update(write_marts({f"stg_{t}": getattr(self, t) for t in STAGING}, folder))
            # Orders and lines meet once; the marts read the stored result, which is bucketed by order.
            stored["order_lines"] = write_bucketed(self._over(stored).order_lines, f"{folder}/order_lines", "order_id")
        built = self._over(stored)
        built.__dict__.update({n: df for n, df in stored.items() if not n.startswith("stg_")})
        shared = [n for n in SHARED if n not in stored]
        if shared and {"department_performance", "department_dow_cohorts"} & set(names):
            written = write_marts({n: getattr(built, n) for n in shared}, folder)
            built.__dict__.update(written)
            stored.update(written)
        for wave in self._waves(names):
            written = write_marts({n: getattr(built, n) for n in wave}, folder, AUDIT_COLUMNS, SORTED_BY, ["fct_orders"])
            # Later marts read the stored table instead of the plan.
            built.__dict__.update(written)
            stored.update(written)
        return stored

    def draft(self, draft: Draft, names: list[str] | None = None, at_once: int = 4) -> dict[str, DataFrame]:
        """Put staging and marts into a draft of a table set, which readers do not see yet.

        The fact takes in newer orders only, and the product history is brought up to today's
        products; both go on from the version the draft was opened on. What the draft has already
        is not made again.
        """
        names = MARTS if names is None else names
        stored = {f"stg_{t}": draft.write(f"stg_{t}", lambda t=t: getattr(self, t)) for t in STAGING}
        built = self._over(stored)
        lines = draft.write("order_lines", lambda: sorted_by(built.order_lines, ["order_id"]))
        built.__dict__["order_lines"] = lines
        if {"department_performance", "department_dow_cohorts"} & set(names):
            built.__dict__.update({n: draft.write(n, lambda n=n: getattr(built, n)) for n in SHARED})

        def put(name: str) -> DataFrame:
            columns = AUDIT_COLUMNS[name]
            if name == "fct_orders":
                fresh = not draft.base["tables"].get(name)
                today = getattr(built, name)
                made = draft_fact(draft, name, today, audit=columns) if fresh else draft_merge(draft, name, stamp(today, columns))
                return made.drop("order_block")

            def rows() -> DataFrame:
                today = getattr(built, name)
                if name == "dim_time" and "fct_orders" in draft.base["tables"]:
                    # The fact goes back further than today's orders do.
                    kept = draft.tables.open("fct_orders", draft.base["tables"]["fct_orders"])
                    edges = kept.agg(F.explode(F.array(F.min("order_date"), F.max("order_date"))).alias("order_date"))
                    today = star.dim_time(built.orders.select("order_date").unionByName(edges.where("order_date IS NOT NULL")))
                if name == "dim_products_scd" and name in draft.base["tables"]:
                    history = draft.tables.open(name, draft.base["tables"][name])
                    today = scd2_merge(history.drop(*columns), today, self.as_of)
                return sorted_by(stamp(today, columns), SORTED_BY.get(name, []))

            return draft.write(name, rows)

        for wave in self._waves(names):
            with ThreadPoolExecutor(at_once) as pool:
                made = dict(zip(wave, pool.map(put, wave)))
            built.__dict__.update(made)
            stored.update(made)
        return stored
