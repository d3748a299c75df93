"""Previews of the views: top-k, ranked listing and ordered row previews.

Each limit here is the feature itself (a bounded report), always with a total
order so the rows returned are deterministic. ``orderBy(...).limit(k)`` plans
as a TakeOrderedAndProject: every task keeps its own top k, so only k rows per
task reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_converted(percent_converted: DataFrame, k: int = 5) -> DataFrame:
    """Companies with the highest conversion percentage (ties by name)."""
    return percent_converted.orderBy(F.desc("Percent_Converted"), F.asc("Company_Name")).limit(k)


def avg_meal_price_ranked(avg_meal_price: DataFrame) -> DataFrame:
    """Average meal price per meal type, highest first (no limit)."""
    return avg_meal_price.orderBy(F.desc("Average_Meal_Price"), F.asc("Type_of_Meal"))


def preview_difference_days(difference_days: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` rows of the day-difference view by order date, then meal time."""
    return difference_days.orderBy("Date", "Date_of_Meal", "Days_Between").limit(n)


def preview(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    """Generic ordered head of any view or table."""
    return df.orderBy(*order_by).limit(n)
