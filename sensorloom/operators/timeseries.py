"""Lags, rolling means and gaps of daily series.

Every input has one row per series and day, so a window partition is bounded by the number of
calendar days however many raw readings stand behind a day; `series` spreads the work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.numeric import exact_mean, portable_round
from sensorloom.operators import calendar


def by_day(series: Sequence[str], day: str = "date"):
    """The window of a series in day order."""
    return Window.partitionBy(*series).orderBy(day)


def previous_row(df: DataFrame, series: Sequence[str], value: str, output: str, day: str = "date") -> DataFrame:
    """the value of the previous row, which after a gap is not the previous day."""
    return df.withColumn(output, F.lag(value).over(by_day(series, day)))


def at_day_offset(
    df: DataFrame, series: Sequence[str], columns: Mapping[str, tuple[str, int]], day: str = "date"
) -> DataFrame:
    """F2, F3 without a spine: `{output: (column, days)}`, negative days look ahead.

    An equi-join on (series, shifted day) per distinct offset: hot series spread over days.
    """
    for offset in sorted({days for _, days in columns.values()}):
        taken = {out: col for out, (col, days) in columns.items() if days == offset}
        other = df.select(
            *series,
            F.date_add(day, offset).alias(day),
            *[F.col(column).alias(output) for output, column in taken.items()],
        )
        df = df.join(other, [*series, day], "left")
    return df


def dense(df: DataFrame, series: Sequence[str], day: str = "date") -> DataFrame:
    """Every series on every day of the whole table's range."""
    bounds = calendar.day_range(df, day)
    days = F.sequence(bounds.select("first_day").scalar(), bounds.select("last_day").scalar())
    every = df.select(*series).distinct().withColumn(day, F.explode(days))
    return every.join(df, [*series, day], "left")


def lag_days(value: Column, days: int, series: Sequence[str], day: str = "date") -> Column:
    """the value `days` days ago on a dense series."""
    return F.lag(value, days).over(by_day(series, day))


def lead_days(value: Column, days: int, series: Sequence[str], day: str = "date") -> Column:
    """the value `days` days ahead on a dense series."""
    return F.lead(value, days).over(by_day(series, day))


def change_to_next(value: Column, series: Sequence[str], day: str = "date") -> Column:
    """tomorrow's value minus today's."""
    return lead_days(value, 1, series, day) - value


def rolling_mean(
    value: Column,
    days: int,
    min_count: int,
    series: Sequence[str],
    day: str = "date",
    decimals: int = 2,
    is_dense: bool = False,
) -> Column:
    """the mean of the last `days` days with at least `min_count` values.

    The range frame counts calendar days, so gaps do not stretch it. On a dense series a frame of
    rows is the same and shares its sort with the lags.
    """
    if is_dense:
        window = by_day(series, day).rowsBetween(-(days - 1), 0)
    else:
        ordered = Window.partitionBy(*series).orderBy(F.unix_date(F.col(day)))
        window = ordered.rangeBetween(-(days - 1), 0)
    count = F.count(value).over(window)
    return F.when(count >= min_count, exact_mean(value, decimals, window))


def monthly_mean(
    df: DataFrame, value: str, digits: int | None = None, day: str = "date", decimals: int = 2
) -> DataFrame:
    """the mean per month; months of the range without a value are NULL."""
    mean = exact_mean(F.col(value), decimals)
    if digits is not None:
        mean = portable_round(mean, digits)
    means = df.groupBy(F.trunc(day, "month").alias("month_start")).agg(mean.alias("mean"))
    return calendar.month_spine(calendar.day_range(df, day)).join(means, "month_start", "left")


def gap_report(df: DataFrame, series: Sequence[str], day: str = "date") -> DataFrame:
    """F8: days missing between the first and the last day of each series."""
    days = df.select(*series, day).distinct()
    report = days.groupBy(*series).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days")
    )
    expected = F.date_diff("last_day", "first_day") + 1
    return report.withColumn("missing_days", (expected - F.col("days")).cast("bigint"))


def empty_years(df: DataFrame, value: str, day: str = "date", series: Sequence[str] = ()) -> DataFrame:
    """years of a dense table, per series, in which a column has no value at all."""
    counts = df.groupBy(*series, F.year(day).alias("year")).agg(F.count(value).alias("n"))
    return counts.filter(F.col("n") == 0).select(*series, "year")
