"""Date nodes (the ``date`` label): one node per day of the referenced date range.

Edges such as in_date, price_in_date and feedback point at ``yyyyMMdd`` day ids;
the node table covers every day from the earliest to the latest referenced
date, so no such edge dangles. Its size is bounded by the date range, not by
the data: ``sequence`` expands one row of bounds into the days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketgraph.functions.ids import date_key


def date_nodes(dates: DataFrame, col: str = "d") -> DataFrame:
    """id (yyyyMMdd) and ten properties for every day between min and max of ``dates[col]``."""
    bounds = dates.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    return days.select(date_key("day").alias("id"), *day_properties(F.col("day")))


def day_properties(day: Column) -> list[Column]:
    iso_dow = F.weekday(day) + 1  # 1 = Monday ... 7 = Sunday
    return [
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("iso_week"),
        iso_dow.alias("iso_weekday"),
        (iso_dow >= 6).alias("is_weekend"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
    ]
