"""Session settings, and intermediate tables in the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import scratch_dir, tune

SETTINGS = {
    # Whole texts go to Python in batches of about this size, however long they are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    # A step's shuffle files, which hold the texts, go when the step ends, and not when the driver happens to collect garbage.
    # A frame that is run again shuffles again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, small batches and shuffle files that last as long as their step."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return tune(spark)


def written(df: DataFrame, label: str, slim: bool = False) -> DataFrame:
    """The same rows, read back from Parquet in the shared folder.

    slim: rows are few and small against the corpus (ids, pairs, labels), so the last step of the
    plan takes eight shuffle partitions a task.
    """
    path = scratch_dir(df.sparkSession, label)
    if slim:
        df = df.coalesce(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
