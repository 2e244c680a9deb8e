"""Column helpers for counts, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def is_reordered() -> Column:
    return F.col("reordered") == 1


def reordered_items() -> Column:
    return count_if(is_reordered())


def reorder_share() -> Column:
    """Reordered rows over all rows of the group."""
    return ratio(reordered_items(), rows())


def ratio(part: Column, whole: Column) -> Column:
    """Division in doubles; NULL where the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_to(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double.

    Scaling first keeps ties where binary floating point puts them
    (0.285 -> 28.499.. -> 0.28); F.round alone would use the decimal text.
    """
    scale = float(10**digits)
    return (F.round(value.cast("double") * scale) / scale).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return round_to(ratio(part * F.lit(100.0), whole), digits)


def steady(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that summation order cannot show in the result."""
    doubles = {c for c, t in df.dtypes if t in ("double", "float")}
    if not doubles:
        return df
    scale = f"{10**digits}D"
    return df.selectExpr(
        *[f"round({c} * {scale}) / {scale} AS {c}" if c in doubles else c for c in df.columns]
    )


def per_order(lines: DataFrame, *group: str) -> DataFrame:
    """One row per group and order with its user, lines and reordered lines.

    Several distinct counts over the lines themselves would multiply every line; over this
    smaller table, orders are rows and only the users are left to count.
    """
    return lines.groupBy(*group, "order_id").agg(
        F.max("user_id").alias("user_id"), rows().alias("lines"), reordered_items().alias("again")
    )


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join two aggregates on their group keys; a NULL key is a group like any other."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])
