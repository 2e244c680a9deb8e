"""The five headered CSV inputs: inventory and typed load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns read from each input. Gaps may be written as 7.0.
COLUMN_TYPES = {
    "orders": {
        "order_id": "long",
        "user_id": "long",
        "order_number": "int",
        "order_dow": "int",
        "order_hour_of_day": "int",
        "days_since_prior_order": "double",
    },
    "products": {"product_id": "long", "product_name": "string", "aisle_id": "int", "department_id": "int"},
    "aisles": {"aisle_id": "int", "aisle_name": "string"},
    "departments": {"department_id": "int", "department_name": "string"},
    "order_products": {"order_id": "long", "product_id": "long", "add_to_cart_order": "int", "reordered": "int"},
}

# Inputs quote a quote by doubling it.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}

# Header names that are renamed on load.
RENAMED = {"aisle": "aisle_name", "department": "department_name"}

# The staging table made from each file.
STAGING_TABLES = {
    "orders.csv": "stg_orders",
    "products.csv": "stg_products",
    "aisles.csv": "stg_aisles",
    "departments.csv": "stg_departments",
    "order_products__train.csv": "stg_order_products",
}


class MissingInput(FileNotFoundError):
    """A required file is absent."""


def _root(spark: SparkSession, raw_dir: str) -> str:
    """The folder's absolute path without scheme and host."""
    path = spark._jvm.org.apache.hadoop.fs.Path(raw_dir)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(path).toUri().getPath().rstrip("/")


def _file_of(path: Column, root: str) -> Column:
    """The input a path belongs to: a file in the folder itself, or the folder of part files bearing its name.

    Files further down, such as those of an archive, belong to none.
    """
    bare = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")
    inside = F.when(F.startswith(bare, F.lit(f"{root}/")), F.substring(bare, len(root) + 2, 2**31 - 1))
    return F.regexp_extract(inside, r"^([^/]+\.csv)(?:/[^/]+)?$", 1)


def source_inventory(spark: SparkSession, raw_dir: str, required: list[str] | None = None) -> DataFrame:
    """Presence, size in MB (1e6 bytes) and data rows of each required file.

    Sizes come from the listing; rows from one scan over all files, grouped by file.
    """
    required = list(required or STAGING_TABLES)
    root = _root(spark, raw_dir)
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in required])).alias("name"))
    sizes = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(raw_dir)
        .groupBy(_file_of(F.col("path"), root).alias("name"))
        .agg((F.sum("length") / 1e6).alias("size_mb"))
    )
    counts = (
        spark.read.schema("line string")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .options(**CSV_OPTIONS)
        .csv(raw_dir)
        # This path is escaped as in a URL, in which a plus sign stands for itself.
        .select(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"))
        .groupBy(_file_of(F.col("path"), root).alias("name"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return wanted.join(sizes, "name", "left").join(counts, "name", "left").select(
        "name",
        "size_mb",
        F.when(F.col("size_mb").isNotNull(), F.coalesce("rows", F.lit(0))).alias("rows"),
        F.col("size_mb").isNotNull().alias("present"),
    )


def require_sources(inventory: DataFrame) -> None:
    """Raise if a required file is absent. The inventory has one row per required file."""
    missing = sorted(r.name for r in inventory.where(~F.col("present")).select("name").collect())
    if missing:
        raise MissingInput(f"missing files: {missing}")


def read_text(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Every input under its short name, all columns as text with the file's own header."""
    return {
        table.removeprefix("stg_"): spark.read.options(**CSV_OPTIONS).csv(f"{raw_dir.rstrip('/')}/{name}")
        for name, table in STAGING_TABLES.items()
    }


def other_inputs(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """Further CSV files in the folder, under their file names, all columns as text."""
    path = spark._jvm.org.apache.hadoop.fs.Path(raw_dir)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(f.getPath().getName() for f in listed)
    return {
        name: spark.read.options(**CSV_OPTIONS).csv(f"{raw_dir.rstrip('/')}/{name}")
        for name in names
        if name.endswith(".csv") and name not in STAGING_TABLES
    }


def with_current_names(df: DataFrame) -> DataFrame:
    """Give name columns their staging name, whichever header the file uses."""
    for old, new in RENAMED.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def problems(text: DataFrame, table: str) -> Column:
    """(column, value, wanted) of every cell whose text does not fit its declared type."""
    found = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.lit(t).alias("wanted")),
        )
        for c, t in COLUMN_TYPES[table].items()
        if t != "string"
    ]
    return F.array_compact(F.array(*found))


def sorted_out(text: DataFrame, table: str, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Typed columns of every row and, of those with text that does not fit, problems and the raw text as JSON.

    rejected tells the two apart; written by it, good and bad rows part in one pass over the input.
    Columns to keep are no part of the text.
    """
    raw = F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns if c not in keep]), {"ignoreNullFields": "false"})
    marked = text.withColumn("problems", problems(text, table))
    bad = F.size("problems") > 0
    return marked.select(
        *[F.col(c).try_cast(t).alias(c) for c, t in COLUMN_TYPES[table].items()],
        *keep,
        F.when(bad, F.col("problems")).alias("problems"),
        # Made for the rows that do not fit alone.
        F.when(bad, raw).alias("raw_text"),
        bad.alias("rejected"),
    )


def accepted(sorted_rows: DataFrame, table: str) -> DataFrame:
    """The staging table of the rows that fit."""
    rows = sorted_rows.where("NOT rejected").select(*COLUMN_TYPES[table]).withColumn("loaded_at", F.current_timestamp())
    if table == "orders":
        rows = rows.withColumn("days_since_prior_order", F.col("days_since_prior_order").cast("int"))
    return rows


def rejected(sorted_rows: DataFrame, table: str) -> DataFrame:
    """file, column, value, wanted type and raw text, a row per cell that does not fit."""
    files = {t.removeprefix("stg_"): f for f, t in STAGING_TABLES.items()}
    cells = sorted_rows.where("rejected").select(F.lit(files[table]).alias("file"), F.explode("problems").alias("p"), "raw_text")
    return cells.select("file", F.col("p.column").alias("column_name"), "p.value", "p.wanted", "raw_text")


def load_staging(
    spark: SparkSession, raw_dir: str, inputs: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The five staging tables with declared types and a load time.

    ``inputs`` are the files' columns as text, if they have been read before.

    Columns are taken by name; text that does not fit its type fails the load, and
    undeclared columns are left out.
    """
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("set spark.sql.ansi.enabled: without it, text that does not fit its type is lost")
    loaded = {}
    for table, text in (inputs or read_text(spark, raw_dir)).items():
        text = with_current_names(text)
        typed = [F.col(c).cast(t).alias(c) for c, t in COLUMN_TYPES[table].items()]
        loaded[f"stg_{table}"] = text.select(*typed).withColumn("loaded_at", F.current_timestamp())
    orders = loaded["stg_orders"]
    loaded["stg_orders"] = orders.withColumn(
        "days_since_prior_order", F.col("days_since_prior_order").cast("int")
    )
    return loaded
