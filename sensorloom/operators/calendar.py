"""Dense calendars (F6, D5) and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import dates


def day_range(df: DataFrame, day: str = "date") -> DataFrame:
    """The first and last day of a table, as one row."""
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def spine(bounds: DataFrame, day: str = "date") -> DataFrame:
    """every day of a `day_range`; an empty range gives no day."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias(day))


def spine_between(spark, start: str, end: str, day: str = "date") -> DataFrame:
    """every day between two given days."""
    return spine(
        spark.range(1).select(
            F.to_date(F.lit(start)).alias("first_day"), F.to_date(F.lit(end)).alias("last_day")
        ),
        day,
    )


def on_spine(df: DataFrame, days: DataFrame, day: str = "date") -> DataFrame:
    """One row per day of the spine; days without a row show as NULL."""
    return days.join(df, day, "left")


def month_spine(bounds: DataFrame, month: str = "month_start") -> DataFrame:
    """F6 by month: the first day of every month of a `day_range`."""
    first, last = F.trunc("first_day", "month"), F.trunc("last_day", "month")
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias(month))


def date_parts(day: Column) -> list[Column]:
    """The parts the calendar dimension stores."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        dates.weekday_from_1(day).alias("day_of_week"),
        dates.is_weekend(day).alias("is_weekend"),
    ]
