"""Table tests: each returns failing rows, values or counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import ratio, rows
from tillroll.operators.validation import unpivot_counts

NAMES = ["table_name", "column_name"]

# Columns declared to be never NULL, per table.
NOT_NULL = {
    "stg_orders": ["order_id", "user_id"],
    "stg_products": ["product_id", "product_name", "aisle_id", "department_id"],
    "stg_order_products": ["order_id", "product_id", "add_to_cart_order", "reordered"],
    "fct_orders": ["order_id", "user_id", "product_id", "reordered"],
    "dim_users": ["user_id", "user_segment"],
    "dim_products": ["product_id", "product_name", "reorder_rate"],
    "product_funnel": ["metric_date", "daily_users", "daily_orders", "reorder_rate"],
    "user_retention": ["user_id", "total_orders", "user_cohort"],
    "department_performance": ["department_id"],
    "dim_products_scd": ["product_id", "product_name", "valid_from", "valid_to", "is_current"],
    "daily_product_metrics": [
        "order_date",
        "product_id",
        "daily_orders",
        "daily_reorder_rate",
        "daily_unique_users",
    ],
}

# Columns declared to be unique, per table.
UNIQUE = {
    "stg_orders": ["order_id"],
    "stg_products": ["product_id"],
    "dim_users": ["user_id"],
    "dim_products": ["product_id"],
    "user_retention": ["user_id"],
    "department_performance": ["department_id"],
}

# Bounds declared for rates, per table.
RANGES = {
    "dim_products": {"reorder_rate": (0, 1)},
    "daily_product_metrics": {"daily_reorder_rate": (0, 100)},
}

# The dimensions the fact refers to and the key it holds for each.
FACT_PARENTS = {
    "dim_users": "user_id",
    "dim_products": "product_id",
    "dim_departments": "department_id",
    "dim_aisles": "aisle_id",
    "dim_time": "order_date",
}


def not_null(table_name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one aggregate."""
    measures = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(columns)]
    return unpivot_counts(df.agg(*measures), [(table_name, c) for c in columns], NAMES, "failures")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values appearing more than once, NULLs ignored."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(rows().alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def unique(table_name: str, df: DataFrame, column: str) -> DataFrame:
    return repeated_values(df, column).agg(rows().alias("failures")).select(
        F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"), "failures"
    )


def row_count_gt_zero(table_name: str, df: DataFrame) -> DataFrame:
    """One row if the table is empty, else none."""
    return (
        df.agg(rows().alias("row_count"))
        .where(F.col("row_count") == 0)
        .select(F.lit(table_name).alias("table_name"), "row_count")
    )


def null_rate(table_name: str, df: DataFrame, column: str, threshold: float = 0.05) -> DataFrame:
    """The NULL rate of the column if it is above the threshold, else no row."""
    rate = ratio(F.count(F.when(F.col(column).isNull(), 1)), rows())
    return (
        df.agg(rate.alias("null_rate"))
        .where(F.col("null_rate") > threshold)
        .select(F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"), "null_rate")
    )


def relationships(
    child_name: str, child: DataFrame, parent_name: str, parent: DataFrame, column: str, parent_column: str | None = None
) -> DataFrame:
    """Child rows whose key has no parent. Keys are counted first, so a hot key is one row of the join."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("n"))
    parents = parent.select(F.col(parent_column or column).alias(column))
    return (
        keys.join(parents, column, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
        .select(
            F.lit(child_name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(parent_name).alias("parent_table"),
            "failures",
        )
    )


def references(child: DataFrame, parents: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Whether every reference of a table finds its parent: parent_table, column_name, failures.

    All keys of a row are stacked as (parent, key) and counted on the map side, so the child is scanned once for all
    its references, and one anti join meets the keys of all parents. Parents are (column, table); NULL keys refer to nothing.
    """
    pairs = F.array(*[F.struct(F.lit(p).alias("parent"), F.col(c).cast("string").alias("key")) for p, (c, _) in parents.items()])
    keys = child.select(F.explode(pairs).alias("of")).where("of.key IS NOT NULL").groupBy("of.parent", "of.key").agg(rows().alias("n"))
    known = reduce(DataFrame.unionByName, [df.select(F.lit(p).alias("parent"), F.col(c).cast("string").alias("key")) for p, (c, df) in parents.items()])
    orphans = keys.join(known, ["parent", "key"], "left_anti")
    measured = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("parent") == p, F.col("n"))), F.lit(0)).alias(f"_{i}") for i, p in enumerate(parents)])
    return unpivot_counts(measured, [(p, c) for p, (c, _) in parents.items()], ["parent_table", "column_name"], "failures")


def accepted_range(table_name: str, df: DataFrame, column: str, low, high) -> DataFrame:
    return df.agg(F.count(F.when(_outside(column, low, high), 1)).alias("failures")).select(
        F.lit(table_name).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(float(low)).alias("low"),
        F.lit(float(high)).alias("high"),
        "failures",
    )


def _broken_day() -> Column:
    return F.col("daily_orders") < F.col("daily_distinct_orders")


def metric_invariants(daily: DataFrame) -> DataFrame:
    """Daily product rows with more distinct orders than lines."""
    return daily.agg(F.count(F.when(_broken_day(), 1)).alias("failures")).select(
        F.lit("daily_product_metrics").alias("table_name"),
        F.lit("daily_orders").alias("column_name"),
        "failures",
    )


def _outside(column: str, low, high) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def _own_checks(table_name: str) -> list[tuple[str, str, Column]]:
    """(category, column, passed) of every declared test that needs only the table itself."""

    def none(condition: Column) -> Column:
        return F.count(F.when(condition, 1)) == 0

    checks = [("not_null", c, none(F.col(c).isNull())) for c in NOT_NULL.get(table_name, [])]
    checks += [("unique", c, F.count(c) == F.countDistinct(c)) for c in UNIQUE.get(table_name, [])]
    checks += [("range", c, none(_outside(c, *RANGES[table_name][c]))) for c in RANGES.get(table_name, {})]
    if table_name == "fct_orders":
        checks.append(("row_count", "*", rows() > 0))
    if table_name == "daily_product_metrics":
        checks.append(("invariant", "daily_orders", none(_broken_day())))
    return checks


def run_tests(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared tests over the given tables: category, table, column, passed.

    Each table is scanned once for all tests of its own, the fact once more for all its references.
    """
    parts = []
    for t, df in tables.items():
        checks = _own_checks(t)
        if checks:
            measured = df.agg(*[passed.alias(f"_{i}") for i, (_, _, passed) in enumerate(checks)])
            labels = [(category, t, c) for category, c, _ in checks]
            parts.append(unpivot_counts(measured, labels, ["category", *NAMES], "passed"))
    parents = {p: (c, tables[p]) for p, c in FACT_PARENTS.items() if p in tables}
    if "fct_orders" in tables and parents:
        found = references(tables["fct_orders"], parents)
        parts.append(
            found.select(
                F.lit("relationships").alias("category"), F.lit("fct_orders").alias("table_name"), "column_name",
                (F.col("failures") == 0).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def summary(results: DataFrame) -> DataFrame:
    """Totals by category and by table, and over everything (category and table 'all')."""
    whole = F.lit("all")
    counted = (
        results.groupingSets([["category"], ["table_name"], []], "category", "table_name")
        .agg(rows().alias("total_tests"), F.count(F.when(F.col("passed"), 1)).alias("passed_tests"))
    )
    return counted.select(
        F.coalesce("category", whole).alias("category"),
        F.coalesce("table_name", whole).alias("table_name"),
        "total_tests",
        F.col("passed_tests").alias("passed"),
        (F.col("total_tests") - F.col("passed_tests")).alias("failed"),
        (ratio(F.col("passed_tests"), F.col("total_tests")) * 100.0).alias("pass_rate"),
    )

