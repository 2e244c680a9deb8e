"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on; all of them can be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more exchange:
    # several metrics group by the very key they were joined on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go when their step ends, and not when the driver happens to collect garbage. A frame that is run
    # again shuffles again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# A task's share of a table or of a shuffle, in compressed bytes. Joins, aggregates and sorts hold some
# 30 to 50 times that in memory, so the share must not grow with the input.
TASK_BYTES = 8 << 20
TASK_LIMITS = {
    "spark.sql.files.maxPartitionBytes": TASK_BYTES,
    # Eight small files to a task, not two.
    "spark.sql.files.openCostInBytes": TASK_BYTES // 8,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 4 * TASK_BYTES,
}
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# The largest shuffles of a query against its stored input.
SHUFFLED_PER_INPUT = 2


# The scratch folder of each application.
_FOLDERS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def bound_tasks(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Keep a task's share of the data the same however large the input is: more of it makes more tasks.

    Lower limits of the session stay. Shuffles begin with enough partitions for the input; AQE joins small ones.
    """
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in TASK_LIMITS.items():
        if as_bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    needed = -(-SHUFFLED_PER_INPUT * input_bytes // TASK_BYTES)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FIRST_PARTITIONS, str(needed))
    else:
        spark.conf.unset(FIRST_PARTITIONS)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle begins with."""
    own = spark.conf.get("spark.sql.shuffle.partitions")
    joined = spark.conf.get("spark.sql.adaptive.enabled") == spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    return int(spark.conf.get(FIRST_PARTITIONS, own) if joined else own)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of files and folders; none where there is nothing."""
    total = 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        total += files.getContentSummary(at).getLength() if files.exists(at) else 0
    return total


def build_session(app: str = "tillroll", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session. On a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {
        **RUNTIME_SETTINGS,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        **settings,
    }.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where driver and executors are one
    process. All paths of an application lie in one folder, which is removed when it ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            base = tempfile.mkdtemp(prefix="tillroll-")
        _FOLDERS[app] = f"{base.rstrip('/')}/tillroll-{app}-{uuid.uuid4().hex[:8]}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS[app])
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{_FOLDERS[app]}/{label}-{uuid.uuid4().hex}"
