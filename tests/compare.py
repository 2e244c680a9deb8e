"""Compare a Spark result with the second engine's, ignoring row and column order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=lambda r: tuple(str(c) for c in r))


# Spark types as the second engine names them.
TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    found = []
    spark_types = {n: TYPE_NAMES.get(t, t) for n, t in df.dtypes}
    other_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    if spark_types != other_types:
        odd = {c for c in set(spark_types) | set(other_types) if spark_types.get(c) != other_types.get(c)}
        found.append(f"types differ: {[(c, spark_types.get(c), other_types.get(c)) for c in sorted(odd)]}")
    columns, ours = _sorted_rows(df.columns, df.collect())
    names, theirs = _sorted_rows(relation.columns, relation.fetchall())
    if columns != names:
        return found + [f"columns differ: {columns} / {names}"]
    if len(ours) != len(theirs):
        found.append(f"row counts differ: {len(ours)} / {len(theirs)}")
    odd = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if odd:
        found.append(f"{len(odd)} rows differ, first: {odd[0]} in {columns}")
    return found
