"""The daily dataset of one spliced series and its exploration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.functions import dates
from sensorloom.functions.numeric import classes_right_closed, exact_mean, exceeds, portable_round
from sensorloom.operators import calendar, statistics, timeseries
from sensorloom.operators.dedup import splice
from sensorloom.operators.joins import flag_matching, with_context
from sensorloom.operators.reshape import long_to_wide


def build_dataset(
    daily: DataFrame,
    pollutants: Sequence[str],
    weather: DataFrame | None = None,
    public_holidays: DataFrame | None = None,
    school_days: DataFrame | None = None,
    episodes: DataFrame | None = None,
    stations: Sequence[str] = tuple(settings.TARGET_STATIONS),
    target: str = "PM25",
    peak: str = "O3",
    episode_pollutants: Sequence[str] = tuple(settings.EPISODE_POLLUTANTS),
    threshold: float = settings.GUIDELINE,
) -> DataFrame:
    """One row per day, gaps kept as NULL."""
    series = splice(daily, ["date", "pollutant_code"], "station_code", stations, "source_station")
    code = "pollutant_code"
    measures = {name.lower(): (name, F.col("mean")) for name in pollutants}
    measures[f"{peak.lower()}_max"] = (peak, F.col("max"))
    measures["source_station"] = (target, F.col("source_station"))
    wide = long_to_wide(series, ["date"], code, measures)
    days = calendar.on_spine(wide, calendar.spine(calendar.day_range(daily)))
    if weather is not None:
        days = with_context(days, (weather, "date"))
    day = F.col("date")
    days = days.withColumns(
        {
            "day_of_week": dates.weekday_from_0(day),
            "month": F.month(day),
            "is_weekend": dates.is_weekend(day),
        }
    )
    if public_holidays is not None:
        days = flag_matching(days, public_holidays, "date", "is_public_holiday")
    else:
        days = days.withColumn("is_public_holiday", F.lit(None).cast("int"))
    if school_days is not None:
        days = with_context(days, (school_days.select("date", "is_school_holiday"), "date"))
    else:
        days = days.withColumn("is_school_holiday", F.lit(None).cast("int"))
    if episodes is not None:
        for name in episode_pollutants:
            found = episodes.filter(F.col("pollutant") == name)
            days = flag_matching(days, found, "date", f"episode_{name.lower()}")
    return days.withColumn("above_who", exceeds(F.col(target.lower()), threshold))


def report(dataset: DataFrame, value: str = "pm25") -> DataFrame:
    """Rows, period, missing days and share of days above, as one row."""
    measured, flags = F.count(value), F.count("above_who")
    return dataset.agg(
        F.count("*").alias("n_days"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        (F.count("*") - measured).alias("n_missing"),
        F.try_divide(F.count("*") - measured, F.count("*")).alias("share_missing"),
        F.sum("above_who").alias("days_above"),
        F.try_divide(F.sum("above_who"), flags).alias("share_above"),
    )


def yearly_summary(dataset: DataFrame, value: str = "pm25") -> DataFrame:
    """Measured days, mean and share of days above per year."""
    years = statistics.exceedance_summary(dataset, [F.year("date").alias("year")], value, "above_who")
    return years.select(
        "year",
        "days_measured",
        portable_round(F.col("mean"), 1).alias("mean_pm25"),
        F.col("days_above").alias("days_above_who"),
        portable_round(F.try_divide(F.lit(100.0) * F.col("days_above"), F.col("days_measured")), 1).alias(
            "pct_days_above_who"
        ),
    )


def monthly_profile(dataset: DataFrame, value: str = "pm25") -> DataFrame:
    """Mean and share of days above per month of the year."""
    months = statistics.exceedance_summary(dataset, [F.month("date").alias("month")], value, "above_who")
    return months.select(
        "month",
        portable_round(F.col("mean"), 2).alias("mean_pm25"),
        portable_round(F.lit(100.0) * F.col("share_above"), 2).alias("pct_above_who"),
    )


def weekday_profile(dataset: DataFrame, value: str = "pm25") -> DataFrame:
    """Mean per day of the week, 0 = Monday."""
    return dataset.groupBy(dates.weekday_from_0(F.col("date")).alias("day_of_week")).agg(
        portable_round(exact_mean(F.col(value), 2), 2).alias("mean_pm25")
    )


def wind_profile(
    dataset: DataFrame,
    value: str = "pm25",
    wind: str = "wind_mean_ms",
    bins: Sequence[float] = tuple(settings.WIND_BINS),
    labels: Sequence[str] = tuple(settings.WIND_BIN_LABELS),
) -> DataFrame:
    """Days and share above per right-closed class; days outside all classes are left out."""
    classed = dataset.withColumn("wind_class", classes_right_closed(F.col(wind), bins, labels))
    classes = statistics.exceedance_summary(
        classed.filter(F.col("wind_class").isNotNull()), [F.col("wind_class")], value, "above_who"
    )
    return classes.select(
        "wind_class",
        F.col("days_measured").alias("days"),
        portable_round(F.lit(100.0) * F.col("share_above"), 2).alias("pct_above_who"),
    )


def persistence(dataset: DataFrame, value: str = "pm25", threshold: float = settings.GUIDELINE) -> DataFrame:
    """E25 on the dense dataset: how far an exceedance carries over to the next day."""
    pairs = dataset.select(
        F.col(value).alias("today"),
        timeseries.lead_days(F.col(value), 1, []).alias("tomorrow"),
    )
    return statistics.exceedance_memory(pairs, "today", "tomorrow", threshold)


def yearly_by_type(
    daily: DataFrame, stations: DataFrame, pollutant: str, types: Sequence[str]
) -> DataFrame:
    """Yearly mean per station type, side by side."""
    joined = daily.filter(F.col("pollutant_code") == pollutant).join(
        stations.select("station_code", "station_type"), "station_code"
    )
    return joined.groupBy(F.year("date").alias("year")).agg(
        *[
            portable_round(
                exact_mean(F.when(F.col("station_type") == name, F.col("mean")), 2), 1
            ).alias(name)
            for name in types
        ]
    )
