"""Headline figures, product questions and guarded ad-hoc SELECTs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from tillroll.functions.labels import day_name
from tillroll.functions.numbers import per_order, percent, ratio, reordered_items, round_to, rows
from tillroll.session import scratch_dir


def api_metrics(fct: DataFrame) -> DataFrame:
    products = fct.select("product_id").distinct().agg(F.count("product_id")).scalar()
    # Without any line the sums are NULL, where counts are zero.
    return (
        per_order(fct)
        .agg(
            F.coalesce(F.sum("lines"), F.lit(0)).alias("fact_orders"),
            F.countDistinct("user_id").alias("users"),
            percent(F.sum("again"), F.sum("lines")).alias("reorder_rate"),
        )
        .select("fact_orders", "users", products.alias("products"), "reorder_rate")
    )


def api_daily_stats(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy("order_dow")
        .agg(
            F.countDistinct("user_id").alias("users"),
            percent(reordered_items(), rows(), 1).alias("reorder_rate"),
        )
        .orderBy("order_dow")
        .select("order_dow", day_name(F.col("order_dow")).alias("day"), "users", "reorder_rate")
    )


def api_top_products(fct: DataFrame, dim_products: DataFrame, k: int = 10) -> DataFrame:
    """Best sellers by name. Lines are counted per product id first, then per name."""
    per_id = fct.groupBy("product_id").agg(rows().alias("lines"), reordered_items().alias("again"))
    return (
        per_id.join(dim_products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg(F.sum("lines").alias("times_ordered"), F.sum("again").alias("again"))
        .select(
            "product_name",
            "times_ordered",
            percent(F.col("again"), F.col("times_ordered"), 0).cast("int").alias("reorder_rate"),
        )
        .orderBy(F.desc("times_ordered"), "product_name")
        .limit(k)
    )


def reorder_rate_overall(fct: DataFrame) -> DataFrame:
    return fct.agg(
        rows().alias("total_items"),
        F.coalesce(reordered_items(), F.lit(0)).alias("reordered_items"),
        percent(reordered_items(), rows()).alias("reorder_rate"),
    )


def product_reorder_rate(fct: DataFrame, product_id=None) -> DataFrame:
    """Mean of the reorder flag, for one product or for all of them."""
    chosen = fct if product_id is None else fct.where(F.col("product_id") == product_id)
    return chosen.groupBy("product_id").agg(F.avg(F.col("reordered").cast("double")).alias("reorder_rate"))


def habit_products(fct: DataFrame, min_orders: int = 10, share: float = 1.0) -> DataFrame:
    """How many well-sold products are reordered at least this often, and their mean order count."""
    return (
        fct.groupBy("product_id")
        .agg(F.countDistinct("order_id").alias("orders"), ratio(reordered_items(), rows()).alias("rate"))
        .where((F.col("orders") >= min_orders) & (F.col("rate") >= share))
        .agg(rows().alias("products"), F.avg("orders").alias("avg_orders"))
    )


def sticky_products(fct: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Every product reordered more often than the threshold, the most often first."""
    return (
        fct.groupBy("product_id")
        .agg(rows().alias("times_ordered"), ratio(reordered_items(), rows()).alias("reorder_rate"))
        .where(F.col("reorder_rate") > threshold)
        .orderBy(F.desc("reorder_rate"), F.desc("times_ordered"), "product_id")
    )


def users_by_day(fct: DataFrame) -> DataFrame:
    return fct.groupBy("order_dow").agg(F.countDistinct("user_id").alias("users"))


def peak_day(fct: DataFrame) -> DataFrame:
    """The day of week with most users (earliest on a tie)."""
    return (
        users_by_day(fct)
        .agg(
            F.max_by("order_dow", F.struct("users", -F.col("order_dow"))).alias("order_dow"),
            F.max("users").alias("users"),
        )
        .select("order_dow", day_name(F.col("order_dow")).alias("day"), "users")
    )


def day_vs_week_avg(fct: DataFrame) -> DataFrame:
    """Users of each day against the mean over the (at most seven) days."""
    mean = F.avg("users").over(Window.partitionBy())
    return users_by_day(fct).select(
        "order_dow",
        "users",
        round_to(mean, 2).alias("week_avg"),
        round_to(ratio((F.col("users") - mean) * 100.0, mean), 2).alias("pct_vs_avg"),
    )


def avg_basket_size(fct: DataFrame) -> DataFrame:
    return (
        fct.groupBy("order_id")
        .agg(F.countDistinct("product_id").alias("items"))
        .agg(rows().alias("orders"), F.avg("items").alias("avg_basket_size"))
    )


def product_penetration(fct: DataFrame) -> DataFrame:
    """Share of orders that hold each product. The order total is a scalar subquery."""
    total = fct.agg(F.countDistinct("order_id")).scalar()
    return (
        fct.groupBy("product_id")
        .agg(F.countDistinct("order_id").alias("orders"))
        .withColumn("pct_of_orders", percent(F.col("orders"), total, 4))
    )


class NotASelect(ValueError):
    """The statement is not a single SELECT, or does not parse."""


@dataclass
class AdhocResult:
    query: str
    columns: list[str]
    rows: DataFrame
    row_count: DataFrame
    asked_at: dt.datetime


def register_views(**tables: DataFrame) -> None:
    """Make marts visible to ad-hoc SELECTs under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# Parts of a parsed SELECT that only read and compute. Anything else, such as commands and scripts
# run on the executors, is refused.
QUERY_NODES = frozenset(
    """Aggregate CTERelationDef Deduplicate Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit
    Offset OneRowRelation Pivot Project Sample Sort SubqueryAlias Tail Union UnresolvedHaving UnresolvedInlineTable
    UnresolvedPivot UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedUnpivot UnresolvedWith Unpivot
    UnresolvedTableValuedFunction Window WithWindowDefinition""".split()
)
# Functions that call into the JVM or look at its files and settings.
REFUSED_FUNCTIONS = frozenset(
    """reflect java_method try_reflect input_file_name input_file_block_start input_file_block_length current_user
    user session_user current_catalog current_database version""".split()
)
TABLE_FUNCTIONS = frozenset("explode explode_outer posexplode posexplode_outer inline inline_outer stack range json_tuple".split())


def _elements(items) -> list:
    """A collection of the JVM as a list."""
    found, each = [], items.iterator()
    while each.hasNext():
        found.append(each.next())
    return found


def _refuse_all_but_reading(plan, views: frozenset[str]) -> None:
    """Walk a parsed plan, its expressions and its subqueries."""
    kind = plan.getClass().getSimpleName()
    if kind not in QUERY_NODES:
        raise NotASelect(f"not allowed in a query: {kind}")
    if kind == "UnresolvedWith":
        for pair in _elements(plan.cteRelations()):
            name, query = pair._1(), pair._2()
            _refuse_all_but_reading(query, views)
            views = views | {name.lower()}
    elif kind == "UnresolvedRelation":
        name = ".".join(_elements(plan.multipartIdentifier())).lower()
        if name not in views:
            raise NotASelect(f"not a registered view: {name}")
    elif kind == "UnresolvedTableValuedFunction":
        name = ".".join(_elements(plan.name())).lower()
        if name not in TABLE_FUNCTIONS:
            raise NotASelect(f"not allowed in a query: {name}()")
    for expression in _elements(plan.expressions()):
        _refuse_calls(expression, views)
    for child in _elements(plan.children()):
        _refuse_all_but_reading(child, views)


def _refuse_calls(expression, views: frozenset[str]) -> None:
    kind = expression.getClass().getSimpleName()
    if kind in ("UnresolvedFunction", "UnresolvedGenerator"):
        parts = expression.nameParts() if kind == "UnresolvedFunction" else None
        name = (".".join(_elements(parts)) if parts is not None else expression.name().unquotedString()).lower()
        if name.split(".")[-1] in REFUSED_FUNCTIONS:
            raise NotASelect(f"not allowed in a query: {name}()")
    elif kind.startswith("CallMethodViaReflection") or kind.startswith("ScriptInput"):
        raise NotASelect(f"not allowed in a query: {kind}")
    if kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"):
        _refuse_all_but_reading(expression.plan(), views)
    for child in _elements(expression.children()):
        _refuse_calls(child, views)


def adhoc_select(spark: SparkSession, query: str, limit: int = 100) -> AdhocResult:
    """Run a caller's SELECT over the registered views.

    The text is parsed by itself, and the parsed plan may hold nothing but reading operators, no
    function that reaches the JVM, and no relation but a view registered in the session or named in
    its own WITH; files named as tables are refused too. The query runs once: its result is stored in the
    shared scratch folder with every row's place and counted while it is written.
    """
    views = frozenset(t.name.lower() for t in spark.catalog.listTables() if t.isTemporary)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    except Exception as error:  # the parser of the JVM, called directly
        raise NotASelect(str(error)) from error
    _refuse_all_but_reading(plan, views)
    result = spark.sql(query)
    names = [f"_{i}" for i in range(len(result.columns))]  # a caller's columns may have equal names
    counted = Observation()
    typed = [n for n, f in zip(names, result.schema.fields) if not isinstance(f.dataType, NullType)]
    placed = result.toDF(*names).select(*typed, F.monotonically_increasing_id().alias("_place")).observe(counted, rows().alias("n"))
    path = scratch_dir(spark, "answer")
    placed.write.parquet(path)
    # A column of bare NULLs has no type to be stored in.
    answer = spark.read.schema(placed.schema).parquet(path).withColumns({n: F.lit(None) for n in names if n not in typed})
    return AdhocResult(
        query=query,
        columns=result.columns,
        rows=answer.orderBy("_place").limit(limit).select(*names).toDF(*result.columns),
        row_count=spark.createDataFrame([(counted.get["n"],)], "row_count long"),
        asked_at=dt.datetime.now(dt.timezone.utc),
    )
