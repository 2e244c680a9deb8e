"""Scan of text columns for personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numbers import rows
from tillroll.operators.validation import unpivot_counts

# The patterns looked for in lowercased text.
PATTERNS = {
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "phone": r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b",
    "ip_address": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
}


def _matches(text: Column, kind: str) -> Column:
    pattern = PATTERNS[kind]
    # Cheap necessary conditions first: an address holds @, and a match with word
    # boundaries is also one without them, which is found several times faster.
    if kind == "email":
        return text.contains("@") & text.rlike(pattern)
    return text.rlike(pattern.replace(r"\b", "")) & text.rlike(pattern)


def pii_scan(table_name: str, df: DataFrame) -> DataFrame:
    """Matching rows per text column and pattern, all of them in one pass over whole texts."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    labels = [(table_name, c, kind) for c in columns for kind in PATTERNS]
    measures = [
        F.count(F.when(_matches(F.lower(F.col(c)), kind), 1)).alias(f"_{i}")
        for i, (_, c, kind) in enumerate(labels)
    ]
    if not labels:
        empty = "table_name string, column_name string, pii_type string, matches long"
        return df.sparkSession.createDataFrame([], empty)
    return unpivot_counts(df.agg(*measures), labels, ["table_name", "column_name", "pii_type"], "matches")


def pii_summary(scan: DataFrame) -> DataFrame:
    """Per table: (column, pattern) pairs with matches, matching rows, and whether it is clean."""
    return scan.groupBy("table_name").agg(
        F.count(F.when(F.col("matches") > 0, 1)).alias("findings"),
        F.sum("matches").alias("matches"),
        (F.sum("matches") == 0).alias("clean"),
    )
