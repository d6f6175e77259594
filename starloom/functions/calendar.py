"""Calendar tables and date attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("full_date")
    )


def calendar_for(df: DataFrame, column: str) -> DataFrame:
    """Every day of the years from the earliest to the latest value of ``column``.

    The bounds are one aggregate row; the days are generated from it lazily.
    """
    bounds = df.agg(F.year(F.min(column)).alias("lo"), F.year(F.max(column)).alias("hi"))
    first, last = F.make_date("lo", F.lit(1), F.lit(1)), F.make_date("hi", F.lit(12), F.lit(31))
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date"))


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def with_hierarchy(days: DataFrame, day: str = "full_date") -> DataFrame:
    """Year, quarter, month and day levels with labels and their sort numbers."""
    d = F.col(day)
    return days.select(
        day,
        F.year(d).alias("year"),
        F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month"),
        F.quarter(d).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("quarter"),
        F.dayofmonth(d).alias("day"),
    )


def date_dimension(days: DataFrame, day: str = "full_date") -> DataFrame:
    """The date dimension; weeks start on Monday, which is day 0."""
    d = F.col(day)
    return days.select(
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day"),
        F.date_format(d, "MMMM").alias("month"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        F.year(d).alias("year"),
        F.weekday(d).alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )
