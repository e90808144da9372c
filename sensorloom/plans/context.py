"""Context pipelines: indices, alerts, school calendar, weather and episodes (M3-M8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import schemas, settings
from sensorloom.functions import dates, numeric, text
from sensorloom.operators import calendar, quality
from sensorloom.operators.dedup import keep_first, keep_preferred
from sensorloom.operators.filters import all_of, differs_or_missing, split_known, within_days
from sensorloom.operators.joins import expand_intervals
from sensorloom.operators.reshape import concatenate, conform
from sensorloom.operators.timeseries import gap_report
from sensorloom.sources.tabular import INPUT_ORDER, resolve_column, text_schema

def _input_order(df: DataFrame) -> list[Column]:
    return [F.col(name) for name in INPUT_ORDER if name in df.columns]


def indices(df: DataFrame) -> DataFrame:
    """M3: air-quality sub-indices per area and day, with the area's level."""
    code = F.col("ninsee").cast("int")
    typed = df.select(
        "date",
        code.alias("insee_code"),
        *[numeric.to_double(F.col(name)).alias(f"index_{name}") for name in ("no2", "o3", "pm10")],
        text.geo_level(code).alias("geo_level"),
        *_input_order(df),
    )
    return keep_first(typed, ["date", "insee_code"], _input_order(df)).drop(*INPUT_ORDER)


def alerts(df: DataFrame, zone: str = settings.ZONE) -> tuple[DataFrame, DataFrame]:
    """M4: forecast procedures as episodes, and the rows of an unknown pollutant or level.

    `observed` stays unknown: this source only lists what was forecast.
    """
    harmonised = df.select(
        dates.slashed_utc_to_local_day(F.col("date_ech"), zone).alias("date"),
        text.replace_known(
            F.replace(F.col("lib_pol"), F.lit(settings.ALERT_PREFIX), F.lit("")), settings.ALERT_POLLUTANT
        ).alias("pollutant"),
        text.harmonise(F.upper("etat"), settings.ALERT_LEVEL).alias("level"),
        F.lit("opendata_csv").alias("source"),
        F.lit("True").alias("forecast"),
        *_input_order(df),
    )
    known, unknown = split_known(
        harmonised, F.col("pollutant").isin(settings.EPISODE_POLLUTANTS) & F.col("level").isNotNull()
    )
    unique = keep_first(known, ["date", "pollutant"], _input_order(df))
    return conform(unique, schemas.EPISODE_EVENT), unknown.drop(*INPUT_ORDER)


def holiday_days(
    periods: DataFrame, place: str = settings.PLACE, zone: str = settings.ZONE
) -> DataFrame:
    """One row per holiday day of a place, named by the first period that covers it.

    Teachers' rows repeat the pupils' and are left out; the end day is a school day.
    """
    c_place = resolve_column(periods, settings.PLACE_HEADERS)
    c_start = resolve_column(periods, settings.START_HEADERS)
    c_end = resolve_column(periods, settings.END_HEADERS)
    c_population = resolve_column(periods, settings.POPULATION_HEADERS, required=False)
    c_name = resolve_column(periods, settings.DESCRIPTION_HEADERS, required=False)
    wanted = periods.filter(
        all_of(
            [
                F.trim(c_place) == place,
                differs_or_missing(F.col(c_population), settings.EXCLUDED_POPULATION)
                if c_population
                else None,
            ]
        )
    ).withColumn("holiday_name", F.col(c_name) if c_name else F.lit(None).cast("string"))
    start, end = (dates.iso_to_local_day(F.col(name), zone) for name in (c_start, c_end))
    order = _input_order(periods)
    kept = ["holiday_name", *[name for name in INPUT_ORDER if name in periods.columns]]
    days = expand_intervals(wanted, start, end, "date", kept)
    return keep_first(days, ["date"], order).select("date", "holiday_name")


def school_calendar(holidays: DataFrame, days: DataFrame) -> DataFrame:
    """Every day with its holiday; a holiday without a name is not flagged."""
    return calendar.on_spine(holidays, days).withColumn(
        "is_school_holiday", F.col("holiday_name").isNotNull().cast("int")
    )


def weather(df: DataFrame) -> DataFrame:
    """M6: weather files in the project's names and types, one row per day."""

    def measure(code):
        if code not in df.columns:
            return F.lit(None).cast("double")
        return numeric.to_double(F.replace(F.col(code), F.lit(","), F.lit(".")))

    typed = df.select(
        dates.compact_day(F.col("DATE")).alias("date"),
        *[measure(code).alias(name) for code, name in settings.WEATHER_CODES.items()],
        *_input_order(df),
    )
    return keep_first(typed, ["date"], _input_order(df)).drop(*INPUT_ORDER)


def weather_report(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M6, F8, K6: the missing days of the period and the missing values per variable."""
    return gap_report(df, []), quality.missing_share(df, schemas.WEATHER_MEASURES)


def scraped_episodes(*pieces: DataFrame) -> DataFrame:
    """M7: page and report rows in one form; a report row wins over a page row.

    Pages only list exceedances that were observed. Within a source the tie-break is the row's
    content, so the answer does not depend on the order of pages.
    """
    union = concatenate(*[piece.select(*[F.col(c).cast("string") for c in piece.columns]) for piece in pieces])
    raw = conform(union, text_schema(schemas.EPISODE_EVENT.names))
    level = F.regexp_replace(F.lower("level"), "s+$", "")
    cleaned = raw.select(
        dates.french_day(F.col("date")).alias("date"),
        "pollutant",
        text.harmonise(level, settings.REPORT_LEVEL).alias("level"),
        "source",
        "forecast",
        F.when(F.col("source") == "html_page", "true").otherwise(F.col("observed")).alias("observed"),
        "forecast_result",
        "criterion_population",
        "criterion_area",
    )
    return keep_preferred(cleaned, ["date", "pollutant"], "source", {"pdf_report": 0}, 1)


def merge_episodes(*origins: DataFrame) -> DataFrame:
    """One row per day and pollutant, from the most complete source that has it."""
    union = conform(concatenate(*origins), schemas.EPISODE_EVENT)
    return keep_preferred(
        union, ["date", "pollutant"], "source", settings.SOURCE_RANK, settings.UNKNOWN_SOURCE_RANK
    )


def in_study_period(
    df: DataFrame, start: str = settings.STUDY_START, end: str = settings.STUDY_END, day: str = "date"
) -> DataFrame:
    """C14: rows of the study period."""
    return df.filter(within_days(F.col(day), start, end))
