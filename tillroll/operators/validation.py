"""Checks of raw tables against a declared layout.

Every check scans the whole table. validate_tables needs one aggregate per table,
whatever the number of rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numbers import rows

RESULT_COLUMNS = ["table_name", "rule", "column_name", "severity", "violations", "passed"]


@dataclass(frozen=True)
class TableSpec:
    columns: dict[str, T.DataType]
    ranges: dict[str, tuple[Any, Any]] = field(default_factory=dict)  # (min, max), None = open
    unique: tuple[str, ...] = ()
    allowed: dict[str, tuple] = field(default_factory=dict)
    min_rows: int = 0


LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

# Layout, ranges and minimum sizes of the five input files.
SPECS = {
    "orders": TableSpec(
        columns={
            "order_id": LONG,
            "user_id": LONG,
            "order_number": INT,
            "order_dow": INT,
            "order_hour_of_day": INT,
            "days_since_prior_order": DOUBLE,
        },
        ranges={
            "order_id": (1, None),
            "user_id": (1, None),
            "order_dow": (0, 6),
            "order_hour_of_day": (0, 23),
        },
        unique=("order_id",),
        min_rows=100_000,
    ),
    "products": TableSpec(
        columns={"product_id": LONG, "product_name": STRING, "aisle_id": INT, "department_id": INT},
        ranges={"product_id": (1, None), "aisle_id": (1, None), "department_id": (1, None)},
        unique=("product_id",),
        min_rows=1_000,
    ),
    "aisles": TableSpec(
        columns={"aisle_id": INT, "aisle_name": STRING}, unique=("aisle_id",), min_rows=50
    ),
    "departments": TableSpec(
        columns={"department_id": INT, "department_name": STRING}, unique=("department_id",), min_rows=5
    ),
    "order_products": TableSpec(
        columns={"order_id": LONG, "product_id": LONG, "add_to_cart_order": INT, "reordered": INT},
        ranges={"add_to_cart_order": (1, None)},
        allowed={"reordered": (0, 1)},
        min_rows=100_000,
    ),
}


class ValidationFailed(ValueError):
    """At least one table breaks its layout."""


def unpivot_counts(one_row: DataFrame, labels: list[tuple], names: list[str], value: str) -> DataFrame:
    """Turn a one-row aggregate with columns _0, _1, .. into one labelled row per column."""
    entries = [
        F.struct(
            *[F.lit(part).alias(n) for part, n in zip(label, names)],
            F.col(f"_{i}").alias(value),
        )
        for i, label in enumerate(labels)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def _same_type(actual: T.DataType, declared: T.DataType) -> bool:
    if isinstance(actual, T.IntegralType):  # width is a storage choice, and whole numbers fit doubles
        return isinstance(declared, (T.IntegralType, T.DoubleType))
    return actual == declared


def _outside(value: Column, low, high) -> Column:
    below = F.lit(False) if low is None else value < low
    above = F.lit(False) if high is None else value > high
    return below | above


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _not_allowed(value: Column, allowed) -> Column:
    return value.isNull() | ~value.isin(list(allowed))


def _repeats(column: str) -> Column:
    """Rows beyond the first of each value; NULL is a value."""
    different = F.countDistinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return rows() - different


def check_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Missing columns (errors) and undeclared ones (warnings), with the rows they affect."""
    found = [("missing_column", c, "error") for c in spec.columns if c not in df.columns]
    found += [("extra_column", c, "warning") for c in df.columns if c not in spec.columns]
    if not found:
        found = [("columns", "*", "ok")]
    counted = df.agg(*[rows().alias(f"_{i}") for i in range(len(found))])
    return unpivot_counts(counted, found, ["rule", "column_name", "severity"], "rows_affected")


def check_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per column: rows whose text does not read as the declared type.

    A column that already has the declared type has none by definition; any other
    non-text column counts all its values.
    """
    labels, measures = [], []
    for c, declared in spec.columns.items():
        if c not in df.columns:
            continue
        actual = df.schema[c].dataType
        if _same_type(actual, declared):
            bad = F.lit(False)
        elif isinstance(actual, T.StringType):
            bad = F.col(c).isNotNull() & F.col(c).try_cast(declared).isNull()
        else:
            bad = F.col(c).isNotNull()
        labels.append((c, declared.simpleString()))
        measures.append(_count(bad).alias(f"_{len(measures)}"))
    return unpivot_counts(df.agg(*measures), labels, ["column_name", "declared_type"], "violations")


def check_min_max(df: DataFrame, ranges: dict[str, tuple[Any, Any]]) -> DataFrame:
    labels, measures = [], []
    for c, (low, high) in ranges.items():
        for side, limit, bad in (
            ("min", low, _outside(F.col(c), low, None)),
            ("max", high, _outside(F.col(c), None, high)),
        ):
            if limit is not None:
                labels.append((c, side))
                measures.append(_count(bad).alias(f"_{len(measures)}"))
    return unpivot_counts(df.agg(*measures), labels, ["column_name", "bound"], "violations")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return df.agg(_repeats(column).alias("duplicates")).select(
        F.lit(column).alias("column_name"), "duplicates"
    )


def check_values(df: DataFrame, column: str, values) -> DataFrame:
    """The values outside the allowed set, each with its row count."""
    return (
        df.where(_not_allowed(F.col(column), values))
        .groupBy(F.col(column).cast("string").alias("invalid_value"))
        .agg(rows().alias("violations"))
        .select(F.lit(column).alias("column_name"), "invalid_value", "violations")
    )


def check_min_rows(df: DataFrame, minimum: int) -> DataFrame:
    return df.agg(rows().alias("row_count")).select(
        "row_count", F.lit(minimum).alias("min_rows"), (F.col("row_count") >= minimum).alias("passed")
    )


def validate_table(name: str, df: DataFrame, spec: TableSpec) -> DataFrame:
    """All rules of one table in one aggregate, one result row per rule."""
    labels, measures = [], []

    def rule(kind: str, column: str, measure: Column, severity: str = "error") -> None:
        labels.append((name, kind, column, severity))
        measures.append(measure.cast("long").alias(f"_{len(measures)}"))

    present = [c for c in spec.columns if c in df.columns]
    for c in spec.columns:
        if c not in present:
            rule("missing_column", c, rows() * 0 + 1)
    for c in df.columns:
        if c not in spec.columns:
            rule("extra_column", c, rows() * 0 + 1, "warning")
    for c in present:
        actual = df.schema[c].dataType
        if _same_type(actual, spec.columns[c]):
            rule("type", c, rows() * 0)
        elif isinstance(actual, T.StringType):
            rule("type", c, _count(F.col(c).isNotNull() & F.col(c).try_cast(spec.columns[c]).isNull()))
        else:
            rule("type", c, F.count(c))
    def value(c: str) -> Column:
        text = isinstance(df.schema[c].dataType, T.StringType)
        return F.col(c).try_cast(spec.columns[c]) if text else F.col(c)

    for c, (low, high) in spec.ranges.items():
        if c in present and isinstance(df.schema[c].dataType, (T.StringType, T.NumericType)):
            rule("range", c, _count(_outside(value(c), low, high)))
    for c in spec.unique:
        if c in present:
            rule("unique", c, _repeats(c))
    for c, values in spec.allowed.items():
        if c in present:
            rule("values", c, _count(_not_allowed(value(c), values)))
    if spec.min_rows:
        rule("min_rows", "*", F.greatest(F.lit(spec.min_rows) - rows(), F.lit(0)))

    results = unpivot_counts(
        df.agg(*measures), labels, ["table_name", "rule", "column_name", "severity"], "violations"
    )
    passed = (F.col("severity") == "warning") | (F.col("violations") == 0)
    return results.withColumn("passed", passed).select(*RESULT_COLUMNS)


def validate_tables(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    result = None
    for name, spec in specs.items():
        one = validate_table(name, tables[name], spec)
        result = one if result is None else result.unionByName(one)
    return result


def validation_summary(results: DataFrame) -> DataFrame:
    """Tables passed of tables checked."""
    per_table = results.groupBy("table_name").agg(F.min("passed").alias("passed"))
    return per_table.agg(
        F.count(F.when(F.col("passed"), 1)).alias("tables_passed"), rows().alias("tables_checked")
    )


def require_valid(results: DataFrame) -> None:
    """Raise if a table failed. Collects the failing rules: a handful per declared table."""
    failed = [r for r in results.where(~F.col("passed")).collect()]
    if failed:
        raise ValidationFailed(
            "; ".join(f"{r.table_name}.{r.column_name}: {r.rule} ({r.violations})" for r in failed)
        )
