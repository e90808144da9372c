"""Measurement pipelines (M1, M2)."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas, settings
from sensorloom.functions import dates, numeric, text
from sensorloom.operators.completeness import aggregate_daily
from sensorloom.operators.dedup import first_seen
from sensorloom.operators.joins import keep_matching, keep_missing
from sensorloom.session import stored
from sensorloom.sources import wide_csv
from sensorloom.sources.sinks import write_partitioned, write_table

HOURLY_KEY = ["timestamp", "station_code", "pollutant_code"]


class Measurements(NamedTuple):
    """What the wide files yield."""

    stations: DataFrame
    pollutants: DataFrame
    hourly: DataFrame
    daily: DataFrame
    empty_stations: DataFrame
    audit: DataFrame
    counts: Mapping[str, float | int | None]


# A column number and a second since 1900 in one bigint: 30 and 33 bits. Times that are compared, those of one
# key, are an hour apart at most, so the order also holds for seconds that need more bits.
SECONDS_1900 = 2_208_988_800
SECONDS_SPAN = 1 << 33


def input_order(column: Column, utc: Column) -> Column:
    """File, position and time as one ordering number; an overflow is an error."""
    return column * F.lit(SECONDS_SPAN) + dates.clock_seconds(utc) + F.lit(SECONDS_1900)


def clean_hourly(cells: DataFrame, dedup_on: str = "local") -> DataFrame:
    """No negatives, one value per local hour, station and pollutant.

    In autumn two UTC hours share a local hour. `dedup_on="local"` keeps the earlier of them,
    `"utc"` keeps both. The value that comes first is found by a hash aggregate of fixed-width
    buffers: partial on the map side, nothing sorted.
    """
    if dedup_on not in ("local", "utc"):
        raise ValueError(f"unknown dedup_on {dedup_on!r}")
    placed = cells.select(
        "timestamp",
        *(["end_utc"] if dedup_on == "utc" else []),
        "station_code",
        "pollutant_code",
        numeric.clamp_floor(F.col("raw_value")).alias("value"),
        input_order(F.col("column"), F.col("end_utc")).alias("input_order"),
    )
    keys = [name for name in placed.columns if name not in ("value", "input_order")]
    first = placed.groupBy(*keys).agg(F.min_by("value", "input_order").alias("value"))
    return first.select(*HOURLY_KEY, "value")


def count_values(cells: DataFrame) -> dict[str, float | int | None]:
    """The counts of a raw pass for cells that came another way: `raw_value` before cleaning. Runs a job."""
    return cells.agg(
        F.count("raw_value").alias("n_values"),
        F.count_if(F.col("raw_value") < 0).alias("n_negative"),
        F.min("raw_value").alias("lowest_value"),
    ).first().asDict()


def cleaning_audit(counts: Mapping[str, float | int | None], hourly: DataFrame, min_hours: int = settings.MIN_HOURS) -> DataFrame:
    """K7: negatives set to 0, the lowest value, duplicates removed and days rejected.

    `counts` of the values before cleaning come from the raw pass; hours are read where they are.
    """
    days = hourly.groupBy(dates.day_of(F.col("timestamp")), "station_code", "pollutant_code").agg(
        F.count("value").alias("n_hours")
    )
    n_values = F.lit(counts["n_values"]).cast("bigint")
    return days.agg(
        n_values.alias("n_values"),
        F.lit(counts["n_negative"]).cast("bigint").alias("n_negative"),
        F.lit(counts["lowest_value"]).cast("double").alias("lowest_value"),
        (n_values - F.coalesce(F.sum("n_hours"), F.lit(0))).alias("n_duplicates"),
        F.count("*").alias("n_days"),
        F.count_if(F.col("n_hours") < min_hours).alias("n_days_rejected"),
    )


def station_dimension(columns: DataFrame) -> DataFrame:
    """Stations with at least one measurement, named as in the first file."""
    stations = first_seen(columns, "station_code", ["station_name"], [F.col("column")])
    typed = stations.withColumn("station_type", text.station_type(F.col("station_name")))
    return keep_matching(typed, columns.filter(F.col("n_numbers") > 0), "station_code")


def pollutant_dimension(metadata: DataFrame) -> DataFrame:
    """All pollutants; `first_column` keeps the order they were seen in."""
    placed = metadata.select(
        "pollutant_code", F.col("column").alias("first_column"), "pollutant_name", "unit"
    )
    attributes = ["first_column", "pollutant_name", "unit"]
    return first_seen(placed, "pollutant_code", attributes, [F.col("first_column")])


def daily_from_hourly(hourly: DataFrame, min_hours: int = settings.MIN_HOURS) -> DataFrame:
    """E1 on cleaned hours."""
    return aggregate_daily(
        hourly, dates.day_of(F.col("timestamp")), ["station_code", "pollutant_code"], "value", min_hours
    )


def from_lines(
    lines: DataFrame,
    zone: str = settings.ZONE,
    min_hours: int = settings.MIN_HOURS,
    dedup_on: str = "local",
) -> Measurements:
    """M1 from the lines of wide files; a file of another layout stops the run.

    The lines are scanned once, into a stored pass (see `wide_csv`). The columns and what each of them
    holds are a small stored table, so joins with the cells know its size: it is broadcast when it fits
    and the cells are not shuffled for it. Writes both to the shared folder before it returns.
    """
    rows, counts = wide_csv.store_pass(lines, zone)
    layout = stored(wide_csv.layout_of(rows), "layout")
    wide_csv.require_headers(layout)
    columns = stored(wide_csv.filled_columns(rows, wide_csv.column_metadata(layout)), "columns")
    hourly = clean_hourly(wide_csv.read_wide(rows, columns), dedup_on)
    return Measurements(
        stations=station_dimension(columns),
        pollutants=pollutant_dimension(columns),
        hourly=hourly,
        daily=daily_from_hourly(hourly, min_hours),
        empty_stations=keep_missing(
            columns.select("file", "station_code").distinct(), columns.filter(F.col("n_filled") > 0), ["file", "station_code"]
        ),
        audit=cleaning_audit(counts, hourly, min_hours),
        counts=counts,
    )


def load_measurements(spark: SparkSession, folder: str, **options) -> Measurements:
    """M1: all station files below a folder."""
    return from_lines(wide_csv.read_lines(spark, folder, wide_csv.STATION_FILE), **options)


def store_measurements(found: Measurements, folder: str, min_hours: int = settings.MIN_HOURS) -> None:
    """The cleaned hours are written once; the daily means and the audit are read from there."""
    spark = found.hourly.sparkSession
    write_partitioned(
        found.hourly, f"{folder}/hourly_measurements", "pollutant_code", ("station_code", "timestamp")
    )
    hourly = spark.read.schema(schemas.HOURLY).parquet(f"{folder}/hourly_measurements")
    write_table(found.stations, f"{folder}/stations")
    write_table(found.pollutants, f"{folder}/pollutants")
    write_table(found.empty_stations, f"{folder}/empty_stations")
    write_table(daily_from_hourly(hourly, min_hours), f"{folder}/daily_measurements")
    write_table(cleaning_audit(found.counts, hourly, min_hours), f"{folder}/audit")


def segment_daily(segments: DataFrame, min_hours: int = settings.MIN_HOURS, **options) -> DataFrame:
    """Daily means per road segment; no zone shift, clamp or de-duplication."""
    return aggregate_daily(
        segments,
        dates.day_of(F.col("time")),
        ["segment", "pollutant_code"],
        "value",
        min_hours,
        with_max=False,
        **options,
    )


def load_segments(spark: SparkSession, folder: str) -> DataFrame:
    """M2: all road-segment files below a folder."""
    return segment_daily(wide_csv.read_segments(spark, folder))
