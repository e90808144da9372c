"""Nested documents and schema export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, FractionalType, IntegralType, StructType

from sensorloom.functions.numeric import exact_mean


def station_summary(facts: DataFrame, flagged: str, threshold: float, decimals: int = 2) -> DataFrame:
    """Days, range, mean and exceedances per station and pollutant.

    `facts` has station_id, pollutant_code, unit, date and mean. The exceedance count is present
    for the flagged pollutant only.
    """
    above = F.count_if(F.col("mean") > threshold)
    return facts.groupBy("station_id", "pollutant_code", "unit").agg(
        F.count("*").alias("days_measured"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        exact_mean(F.col("mean"), decimals).alias("overall_mean"),
        F.when(F.col("pollutant_code") == flagged, above).alias("days_above_who_pm25"),
    )


def station_document(stations: DataFrame, summary: DataFrame) -> DataFrame:
    """H1: a station with the array of its summaries, at most one entry per pollutant."""
    entry = F.struct(*[name for name in summary.columns if name != "station_id"])
    lists = summary.groupBy("station_id").agg(F.sort_array(F.collect_list(entry)).alias("pollutants"))
    empty = F.array().cast(lists.schema["pollutants"].dataType)
    return (
        stations.join(lists, "station_id", "left")
        .withColumn("pollutants", F.coalesce("pollutants", empty))
        .select("station_code", "station_name", "station_type", "pollutants")
    )


def measurement_document(
    facts: DataFrame,
    stations: DataFrame,
    pollutants: DataFrame,
    weather: DataFrame,
    episodes: DataFrame,
    flagged: str,
    threshold: float,
) -> DataFrame:
    """H2: a measurement with its station, pollutant, weather and the episodes of its day.

    Episodes are unique per day and pollutant, so a day's array is bounded by the pollutants.
    """
    entry = F.struct("pollutant_code", "level", "source", "forecast_result")
    by_day = (
        episodes.join(pollutants.select("pollutant_id", "pollutant_code"), "pollutant_id")
        .groupBy("date")
        .agg(F.sort_array(F.collect_list(entry)).alias("episodes_of_the_day"))
    )
    context = weather.select(
        "date",
        F.struct("temp_mean_c", "rain_mm", "wind_mean_ms", "pressure_mean_hpa").alias(
            "weather_of_the_day"
        ),
    )
    joined = (
        facts.join(stations, "station_id")
        .join(pollutants, "pollutant_id")
        .join(context, "date", "left")
        .join(by_day, "date", "left")
    )
    empty = F.array().cast(by_day.schema["episodes_of_the_day"].dataType)
    identity = [name for name in ("measurement_id",) if name in facts.columns]
    return joined.select(
        *identity,
        "date",
        F.col("mean").alias("daily_mean"),
        F.col("max").alias("hourly_max"),
        F.col("n_hours").alias("hours_measured"),
        F.struct(
            F.col("station_code").alias("code"),
            F.col("station_name").alias("name"),
            F.col("station_type").alias("type"),
        ).alias("station"),
        F.struct(
            F.col("pollutant_code").alias("code"),
            F.col("pollutant_name").alias("name"),
            F.col("unit").alias("unit"),
        ).alias("pollutant"),
        "weather_of_the_day",
        F.coalesce("episodes_of_the_day", empty).alias("episodes_of_the_day"),
        F.when(F.col("pollutant_code") == flagged, F.col("mean") > threshold).alias(
            "above_who_guideline"
        ),
    )


def as_json(df: DataFrame, output: str = "document") -> DataFrame:
    """H1, H2: one JSON text per row; absent values are left out."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"}).alias(output))


def schema_fields(schema: StructType) -> list[dict[str, str]]:
    """H4: name, type and mode of each column, in the words of a warehouse."""

    def kind(data_type):
        if isinstance(data_type, DateType):
            return "DATE"
        if isinstance(data_type, IntegralType):
            return "INTEGER"
        return "FLOAT" if isinstance(data_type, FractionalType) else "STRING"

    return [
        {"name": field.name, "type": kind(field.dataType), "mode": "NULLABLE"}
        for field in schema.fields
    ]
