"""The query library (M12) on the star schema and on the denormalised table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.functions.numeric import (
    classes_left_closed,
    exact_mean,
    exceeds,
    portable_round,
    safe_ratio,
)
from sensorloom.operators import joins, paging, statistics, timeseries

Tables = Mapping[str, DataFrame]
BACKGROUND, TRAFFIC = "urban_background", "traffic"


def _mean(digits: int, column: str = "mean"):
    return portable_round(exact_mean(F.col(column), 2), digits)


def _facts_of(tables: Tables, pollutant: str) -> DataFrame:
    """Facts of one pollutant; the filter sits on the small dimension."""
    wanted = tables["pollutant"].filter(F.col("pollutant_code") == pollutant).select("pollutant_id")
    return joins.star(tables["daily_measurement"], (wanted, "pollutant_id"))


def _of_stations(facts: DataFrame, tables: Tables, codes: Sequence[str]) -> DataFrame:
    wanted = tables["station"].filter(F.col("station_code").isin(list(codes)))
    return joins.star(facts, (wanted.select("station_id", "station_code"), "station_id"))


def _of_types(facts: DataFrame, tables: Tables, types: Sequence[str]) -> DataFrame:
    wanted = tables["station"].filter(F.col("station_type").isin(list(types)))
    return joins.star(facts, (wanted.select("station_id", "station_type"), "station_id"))


def yearly_mean_by_type(
    tables: Tables, pollutant: str = "PM25", types: Sequence[str] = (BACKGROUND, TRAFFIC)
) -> DataFrame:
    """Q1 (D1, E3): per year and type of station, the mean and how many stations it comes from."""
    facts = _of_types(_facts_of(tables, pollutant), tables, types)
    dated = joins.star(facts, (tables["calendar"].select("date", "year"), "date"))
    return dated.groupBy("year", "station_type").agg(
        _mean(1).alias("pm25_mean_ug_m3"), F.count_distinct("station_id").alias("n_stations")
    )


def monthly_risk(
    tables: Tables,
    pollutant: str = "PM25",
    stations: Sequence[str] = tuple(settings.TARGET_STATIONS),
    threshold: float = settings.GUIDELINE,
) -> DataFrame:
    """Q2 (E4): count, days above, share above and mean per month of the year, in one pass."""
    facts = _of_stations(_facts_of(tables, pollutant), tables, stations)
    dated = joins.star(facts, (tables["calendar"].select("date", "month"), "date"))
    above = F.count_if(F.col("mean") > threshold)
    return dated.groupBy("month").agg(
        F.count("*").alias("days_measured"),
        above.alias("days_above_who"),
        portable_round(F.lit(100.0) * above / F.count("*"), 1).alias("pct_days_above_who"),
        _mean(1).alias("pm25_mean_ug_m3"),
    )


def traffic_excess(
    tables: Tables, pollutant: str = "NO2", background: str = BACKGROUND, traffic: str = TRAFFIC
) -> DataFrame:
    """Q3 (E11, B21): both station types side by side per year, their gap and ratio."""
    facts = _of_types(_facts_of(tables, pollutant), tables, [background, traffic])
    dated = joins.star(facts, (tables["calendar"].select("date", "year"), "date"))

    def mean_of(kind):
        return exact_mean(F.when(F.col("station_type") == kind, F.col("mean")), 2)

    by_year = dated.groupBy("year").agg(mean_of(background).alias("b"), mean_of(traffic).alias("t"))
    b, t = F.col("b"), F.col("t")
    return by_year.select(
        "year",
        portable_round(b, 1).alias("no2_background_ug_m3"),
        portable_round(t, 1).alias("no2_traffic_ug_m3"),
        portable_round(t - b, 1).alias("traffic_excess_ug_m3"),
        portable_round(safe_ratio(t, b), 2).alias("traffic_background_ratio"),
    )


def worst_days(
    tables: Tables,
    pollutant: str = "PM25",
    stations: Sequence[str] = tuple(settings.TARGET_STATIONS),
    k: int = 10,
) -> DataFrame:
    """Q4 (G1, D2): the k worst days with their weather.

    The top-k comes before the join: the left join keeps every day once, so only k days need
    their weather.
    """
    facts = _of_stations(_facts_of(tables, pollutant), tables, stations)
    worst = paging.top_k(facts, [F.desc("mean"), F.col("date"), F.col("station_code")], k)
    weather = tables["weather_day"].select(
        "date", "temp_mean_c", "wind_mean_ms", "rain_mm", "pressure_mean_hpa"
    )
    return joins.with_context(worst, (weather, "date")).select(
        "date",
        "station_code",
        portable_round(F.col("mean"), 1).alias("pm25_ug_m3"),
        "temp_mean_c",
        "wind_mean_ms",
        "rain_mm",
        "pressure_mean_hpa",
    )


def episodes_and_measurements(
    tables: Tables,
    pollutant: str = "PM25",
    stations: Sequence[str] = tuple(settings.TARGET_STATIONS),
    threshold: float = settings.GUIDELINE,
) -> DataFrame:
    """Q5 (F1, D10): each episode with the value of its day and of the previous measured row.

    The stations form one series with at most one value per day, so the window is as long as the
    calendar.
    """
    facts = _of_stations(_facts_of(tables, pollutant), tables, stations)
    centre = timeseries.previous_row(
        facts.select("pollutant_id", "date", F.col("mean").alias("pm25_day")),
        ["pollutant_id"],
        "pm25_day",
        "pm25_day_before",
    ).drop("pollutant_id")
    named = tables["episode"].join(
        tables["pollutant"].select("pollutant_id", "pollutant_code"), "pollutant_id"
    )
    return joins.with_context(named, (centre, "date")).select(
        "date",
        F.col("pollutant_code").alias("episode_pollutant"),
        "level",
        "forecast_result",
        portable_round(F.col("pm25_day_before"), 1).alias("pm25_day_before_ug_m3"),
        portable_round(F.col("pm25_day"), 1).alias("pm25_day_ug_m3"),
        exceeds(F.col("pm25_day"), threshold).alias("above_who"),
    )


def month_of_year(denormalised: DataFrame, pollutant: str, station: str) -> DataFrame:
    """Warehouse query 1 (E17): monthly mean and exceedances; the caller restricts the year."""
    wanted = denormalised.filter(
        (F.col("pollutant_code") == pollutant) & (F.col("station_code") == station)
    )
    return wanted.groupBy("month").agg(
        _mean(1, "daily_mean").alias("pm25_mean_ug_m3"), F.sum("above_who_pm25").alias("days_above_who")
    )


def type_means(
    denormalised: DataFrame, pollutant: str = "NO2", background: str = BACKGROUND, traffic: str = TRAFFIC
) -> DataFrame:
    """Warehouse query 2 (E5): both station types per year; years without either still show."""

    def mean_of(kind):
        value = F.when(F.col("station_type") == kind, F.col("daily_mean"))
        return portable_round(exact_mean(value, 2), 1)

    return (
        denormalised.filter(F.col("pollutant_code") == pollutant)
        .groupBy("year")
        .agg(mean_of(background).alias("no2_background"), mean_of(traffic).alias("no2_traffic"))
    )


def wind_classes(
    denormalised: DataFrame,
    pollutant: str = "PM25",
    stations: Sequence[str] = tuple(settings.TARGET_STATIONS),
    wind: str = "wind_mean_ms",
    edges: Sequence[float] = tuple(settings.WIND_EDGES),
    labels: Sequence[str] = tuple(settings.WIND_LABELS),
) -> DataFrame:
    """Warehouse query 3 (E15): days, mean and share above per left-closed wind class."""
    wanted = denormalised.filter(
        (F.col("pollutant_code") == pollutant)
        & F.col("station_code").isin(list(stations))
        & F.col(wind).isNotNull()
    )
    share = F.lit(100.0) * F.sum("above_who_pm25") / F.nullif(F.count("above_who_pm25"), F.lit(0))
    return wanted.groupBy(classes_left_closed(F.col(wind), edges, labels).alias("wind_class")).agg(
        F.count("*").alias("days"),
        _mean(1, "daily_mean").alias("pm25_mean_ug_m3"),
        portable_round(share, 1).alias("pct_days_above_who"),
    )


def rows_per_year(denormalised: DataFrame) -> DataFrame:
    """Warehouse check (E18): are all years there?"""
    return statistics.value_counts(denormalised, "year")
