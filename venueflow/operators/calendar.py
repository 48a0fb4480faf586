"""Calendar operators: holiday clean-up and recency weights.

A calendar holds one row per date, so its size is bounded by the date range, not by the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venueflow.functions.columns import recency_weight

# English weekend day names.
WEEKEND = ("Saturday", "Sunday")


def clear_weekend_holidays(
    calendar: DataFrame, day_name: str = "day_of_week", flag: str = "holiday_flg"
) -> DataFrame:
    """A holiday that falls on a weekend is an ordinary weekend day."""
    special = F.col(day_name).isin(*WEEKEND) & (F.col(flag) == 1)
    return calendar.withColumn(flag, F.when(special, F.lit(0)).otherwise(F.col(flag)))


def with_recency_weights(
    calendar: DataFrame,
    date: str = "calendar_date",
    exponents: Sequence[float] = (5.0,),
    names: Sequence[str] = ("weight",),
) -> DataFrame:
    """Add (rank/n)**p per exponent, rank being the date order in the calendar.

    The window has no partition key; it sees the calendar only, which is one row per date.
    """
    rank = F.row_number().over(Window.orderBy(date))
    size = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = calendar.withColumn("_rank", rank).withColumn("_size", size)
    weights = {n: recency_weight("_rank", "_size", p) for n, p in zip(names, exponents)}
    return ranked.withColumns(weights).drop("_rank", "_size")
