"""Calendar helpers and the labels given to users, gaps, baskets and ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day numbering starts with Sunday = 0.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
WEEKEND_DAYS = [0, 6]

# Labels in reporting order.
GAP_LABELS = ["First Order", "1-7 days", "8-14 days", "15-30 days", "30+ days"]
BASKET_LABELS = ["1 item", "2-5 items", "6-10 items", "11-20 items", "20+ items"]


def day_of_week(date: Column) -> Column:
    return (F.dayofweek(date) - 1).cast("int")


def day_name(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), dow.cast("int") + 1)


def date_key(date: Column) -> Column:
    """YYYYMMDD as an integer."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def user_segment(total_orders: Column) -> Column:
    # Segment names and their lower bounds.
    return (
        F.when(total_orders >= 10, "high_frequency")
        .when(total_orders >= 5, "medium")
        .otherwise("low_frequency")
    )


def user_cohort(total_orders: Column) -> Column:
    # Cohort names and their upper bounds.
    return (
        F.when(total_orders == 1, "single_order")
        .when(total_orders <= 5, "light_user")
        .when(total_orders <= 20, "medium_user")
        .otherwise("heavy_user")
    )


def performance_tier(rank: Column) -> Column:
    # Tier names and the last rank of each.
    return F.when(rank <= 5, "top_tier").when(rank <= 10, "mid_tier").otherwise("emerging")


def gap_bucket(days: Column) -> Column:
    first, week, fortnight, month, longer = GAP_LABELS
    return (
        F.when(days.isNull(), first)
        .when(days <= 7, week)
        .when(days <= 14, fortnight)
        .when(days <= 30, month)
        .otherwise(longer)
    )


def basket_bucket(items: Column) -> Column:
    one, few, some, many, most = BASKET_LABELS
    return (
        F.when(items == 1, one)
        .when(items.between(2, 5), few)
        .when(items.between(6, 10), some)
        .when(items.between(11, 20), many)
        .otherwise(most)
    )


def label_position(label: Column, labels: list[str]) -> Column:
    """Sort key that puts labels in reporting order."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label)
