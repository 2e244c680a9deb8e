"""Tables in buckets of a key: what groups or joins by the key, or by it and more, reads them without a shuffle.

A bucket is one task's, so a key with very many rows makes a large bucket; map-side combines keep what leaves it small.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillroll.session import shuffle_partitions


def _register(spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None, **options: str) -> DataFrame:
    """Write rows to a folder in buckets of a key, each sorted by it, and return the table over them.

    One shuffle, on the key, and no bounds to sample, so rows are made once. By default there are as many buckets as
    shuffles begin with. Options are the writer's.
    """
    spark = df.sparkSession
    n = buckets or shuffle_partitions(spark)
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(n, key)
    dealt.write.format("parquet").bucketBy(n, key).sortBy(key).options(path=path, **options).saveAsTable(name)
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """A table over a folder that another session wrote in buckets."""
    return _register(spark, f"bucketed_{uuid.uuid4().hex}", path, schema, key, buckets)
