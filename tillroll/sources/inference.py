"""Types of text columns, found from all their values.

A column has the first of the types that every value of it fits: long, double, date, timestamp, boolean,
else string. A whole table is one aggregate, whatever its number of columns; one odd value in the last row counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import rows

# How a value of each type is written. The type's own range is checked by a cast besides.
WRITTEN = {
    "long": r"^[+-]?[0-9]{1,19}$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$",
    "boolean": r"^(?i)(true|false)$",
}
CASTS = {"long": "bigint", "double": "double", "date": "date", "timestamp": "timestamp_ntz", "boolean": "boolean"}
# What a declared type takes in without loss.
TAKES = {
    "int": {"long"}, "bigint": {"long"}, "long": {"long"}, "double": {"long", "double"}, "date": {"date"},
    "timestamp": {"date", "timestamp"}, "timestamp_ntz": {"date", "timestamp"}, "boolean": {"boolean"},
    "string": {*WRITTEN, "string"},
}


def _fits(column: Column, kind: str) -> Column:
    return column.rlike(WRITTEN[kind]) & column.try_cast(CASTS[kind]).isNotNull()


def infer_types(text: DataFrame, declared: dict[str, str] | None = None) -> DataFrame:
    """column_name, value_count, null_count, longest, inferred_type, declared_type and drift, a row per column.

    A column without values has no inferred type and no drift. drift tells that values do not fit what is declared.
    """
    measures = []
    for i, c in enumerate(text.columns):
        value = F.col(f"`{c}`")
        measures += [F.count(value).alias(f"_{i}_n"), rows().alias(f"_{i}_all"), F.max(F.length(value)).alias(f"_{i}_longest")]
        measures += [F.count(F.when(value.isNotNull() & ~_fits(value, k), 1)).alias(f"_{i}_{k}") for k in WRITTEN]
    found = []
    for i, c in enumerate(text.columns):
        kind = F.lit("string")
        for k in reversed(WRITTEN):
            kind = F.when(F.col(f"_{i}_{k}") == 0, k).otherwise(kind)
        kind = F.when(F.col(f"_{i}_n") > 0, kind)
        wanted = (declared or {}).get(c)
        drift = F.lit(False) if wanted is None else F.coalesce(~kind.isin(sorted(TAKES[wanted])), F.lit(False))
        found.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_{i}_n").alias("value_count"),
                (F.col(f"_{i}_all") - F.col(f"_{i}_n")).alias("null_count"),
                F.col(f"_{i}_longest").alias("longest"),
                kind.alias("inferred_type"),
                F.lit(wanted).cast("string").alias("declared_type"),
                drift.alias("drift"),
            )
        )
    return text.agg(*measures).select(F.inline(F.array(*found)))
