"""The star schema and the denormalised table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom import schemas, settings
from sensorloom.functions import text
from sensorloom.functions.numeric import exceeds_for
from sensorloom.operators import calendar, quality
from sensorloom.operators.joins import dimension, keep_matching, lookup_id, with_context
from sensorloom.operators.keys import dense_ids, small_ids
from sensorloom.operators.reshape import concatenate, conform


def calendar_dimension(
    daily: DataFrame, public_holidays: DataFrame | None = None, school_days: DataFrame | None = None
) -> DataFrame:
    """Every day of the facts. A source that is absent leaves NULL, which is not 'no'."""
    days = calendar.spine(calendar.day_range(daily))
    table = days.select("date", *calendar.date_parts(F.col("date")))
    if public_holidays is not None:
        table = with_context(table, (public_holidays.select("date", "holiday_name"), "date"))
        table = table.withColumn("is_public_holiday", F.col("holiday_name").isNotNull().cast("int"))
    if school_days is not None:
        named = school_days.select(
            "date", "is_school_holiday", F.col("holiday_name").alias("school_holiday_name")
        )
        table = with_context(table, (named, "date"))
    return conform(table, schemas.CALENDAR)


def pollutant_ids(pollutants: DataFrame) -> DataFrame:
    """Pollutants numbered in the order they were first seen, by code where that is unknown."""
    seen = [name for name in ("first_column",) if name in pollutants.columns]
    numbered = small_ids(pollutants, [*seen, "pollutant_code"], "pollutant_id")
    return conform(numbered, schemas.POLLUTANT)


def station_ids(stations: DataFrame) -> DataFrame:
    """Stations numbered in code order."""
    return conform(small_ids(stations, ["station_code"], "station_id"), schemas.STATION)


def episode_rows(episodes: DataFrame, pollutant: DataFrame, days: DataFrame) -> DataFrame:
    """Episodes of known pollutants on days of the calendar."""
    coded = episodes.withColumn("pollutant_code", F.replace("pollutant", F.lit("."), F.lit("")))
    known = lookup_id(coded, pollutant, "pollutant_code", "pollutant_id", strict=False).filter(
        F.col("pollutant_id").isNotNull()
    )
    flags = ["forecast", "observed", "criterion_population", "criterion_area"]
    return keep_matching(known, days, "date").withColumns(
        {name: text.flag_from_text(F.col(name)) for name in flags}
    )


def fact_rows(
    daily: DataFrame, station: DataFrame, pollutant: DataFrame, numbered: bool = True
) -> DataFrame:
    """Daily values with their keys.

    Identifiers follow the order of insertion: day, station code, pollutant code. The codes are looked up where the
    sorted facts are.
    """
    facts = daily
    if numbered:
        facts = dense_ids(daily, ["date", "station_code", "pollutant_code"], "measurement_id")
    facts = lookup_id(facts, dimension(station), "station_code", "station_id")
    facts = lookup_id(facts, dimension(pollutant), "pollutant_code", "pollutant_id")
    return conform(facts, schemas.DAILY_MEASUREMENT)


def build_star(
    stations: DataFrame,
    pollutants: DataFrame,
    daily: DataFrame,
    public_holidays: DataFrame | None = None,
    school_days: DataFrame | None = None,
    weather: DataFrame | None = None,
    episodes: DataFrame | None = None,
    number_facts: bool = True,
) -> dict[str, DataFrame]:
    """M9: the six tables.

    Numbering the facts needs a sort of the whole fact table; `number_facts=False` leaves the
    identifier NULL where no reader asks for it.
    """
    spark = daily.sparkSession
    station = station_ids(stations)
    pollutant = pollutant_ids(pollutants)
    days = calendar_dimension(daily, public_holidays, school_days)
    events = spark.createDataFrame([], schemas.EPISODE)
    if episodes is not None:
        events = episode_rows(episodes, pollutant, days)
    if number_facts and episodes is not None:
        events = dense_ids(events, ["date", "pollutant"], "episode_id")
    context = spark.createDataFrame([], schemas.WEATHER_DAY)
    if weather is not None:
        context = keep_matching(conform(weather, schemas.WEATHER_DAY), days, "date")
    tables = {
        "station": station,
        "pollutant": pollutant,
        "calendar": days,
        "weather_day": context,
        "daily_measurement": fact_rows(daily, station, pollutant, number_facts),
        "episode": events,
    }
    return {name: conform(tables[name], schemas.STAR[name]) for name in schemas.TABLE_ORDER}


def check_star(tables: Mapping[str, DataFrame]) -> DataFrame:
    """K1-K4: every declared key, reference, NOT NULL and length, with the rows that break it."""
    parts = []
    for name, keys in schemas.KEYS.items():
        parts += [quality.key_check(tables[name], name, key).drop("n_keys") for key in keys]
    for child, column, parent in schemas.REFERENCES:
        parts.append(
            quality.reference_check(
                tables[child], tables[parent], f"{child}.{column} -> {parent}", column, column
            ).drop("n_keys")
        )
    for name in schemas.TABLE_ORDER:
        predicates = quality.not_null(schemas.NOT_NULL[name])
        predicates |= quality.max_length(schemas.MAX_LENGTH.get(name, {}))
        parts.append(
            quality.predicate_checks(tables[name], predicates).withColumn(
                "check", F.concat(F.lit(f"{name}: "), "check")
            )
        )
    return concatenate(*parts)


def denormalise(
    tables: Mapping[str, DataFrame],
    flagged: str = "PM25",
    threshold: float = settings.GUIDELINE,
) -> DataFrame:
    """One row per measurement with all its context. Sorting is left to the sink."""
    levels = tables["episode"].select("date", "pollutant_id", F.col("level").alias("episode_level"))
    wide = with_context(
        tables["daily_measurement"],
        (tables["station"], "station_id"),
        (tables["pollutant"], "pollutant_id"),
        (tables["calendar"], "date"),
        (tables["weather_day"], "date"),
        (levels, ["date", "pollutant_id"]),
    )
    flag = exceeds_for(F.col("pollutant_code"), flagged, F.col("mean"), threshold)
    return conform(
        wide.withColumn("above_who_pm25", flag),
        schemas.DENORMALISED,
        {"daily_mean": "mean", "hourly_max": "max"},
    )
