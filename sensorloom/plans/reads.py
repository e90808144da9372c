"""Read operators (M13): filtered pages and single documents."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.functions.numeric import portable_round
from sensorloom.functions.text import contains_text
from sensorloom.operators import filters, joins, nested, paging

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class StationFilter:
    """Optional filters of the station list."""

    type: str | None = None
    name: str | None = None
    types: tuple[str, ...] = tuple(settings.STATION_TYPES)

    def condition(self) -> Column:
        return filters.all_of(
            [
                filters.one_of(F.col("station_type"), self.type, self.types, "type"),
                contains_text(F.col("station_name"), self.name) if self.name else None,
            ]
        )


@dataclass(frozen=True)
class MeasurementFilter:
    """Optional filters of the measurement list."""

    station: str | None = None
    pollutant: str | None = None
    start: str | datetime.date | None = None
    end: str | datetime.date | None = None
    min_value: float | None = None

    def condition(self) -> Column:
        return filters.all_of(
            [
                filters.equals_code(F.col("station_code"), self.station),
                filters.equals_code(F.col("pollutant_code"), self.pollutant),
                filters.within_days(F.col("date"), self.start or None, self.end or None),
                F.col("mean") >= self.min_value if self.min_value is not None else None,
            ]
        )


def stations_matching(tables: Tables, wanted: StationFilter = StationFilter()) -> DataFrame:
    """H3: all station rows that satisfy the filters."""
    return tables["station"].filter(wanted.condition()).select(
        "station_code", "station_name", "station_type"
    )


def list_stations(
    tables: Tables,
    wanted: StationFilter = StationFilter(),
    page: int = 1,
    per_page: int = settings.PER_PAGE,
) -> tuple[DataFrame, DataFrame]:
    """A page of stations and its page information."""
    rows = stations_matching(tables, wanted)
    return (
        paging.page_of(rows, [F.col("station_code")], page, per_page),
        paging.page_info(rows, page, per_page),
    )


def station_documents(
    tables: Tables, flagged: str = "PM25", threshold: float = settings.GUIDELINE
) -> DataFrame:
    """H1 for every station."""
    facts = joins.star(
        tables["daily_measurement"].select("station_id", "pollutant_id", "date", "mean"),
        (tables["pollutant"].select("pollutant_id", "pollutant_code", "unit"), "pollutant_id"),
    )
    return nested.station_document(
        tables["station"], nested.station_summary(facts, flagged, threshold)
    )


def get_station(tables: Tables, code: str, **options) -> DataFrame:
    """One station's document; an unknown code gives no row."""
    one = filters.lookup(tables["station"], "station_code", code, upper=True)
    facts = joins.keep_matching(tables["daily_measurement"], one, "station_id")
    return station_documents({**tables, "station": one, "daily_measurement": facts}, **options)


def measurements_matching(tables: Tables, wanted: MeasurementFilter = MeasurementFilter()) -> DataFrame:
    """H3: all measurement rows that satisfy the filters."""
    joined = joins.star(
        tables["daily_measurement"],
        (tables["station"].select("station_id", "station_code"), "station_id"),
        (tables["pollutant"].select("pollutant_id", "pollutant_code", "unit"), "pollutant_id"),
    )
    return joined.filter(wanted.condition()).select(
        "measurement_id",
        "date",
        "station_code",
        "pollutant_code",
        portable_round(F.col("mean"), 2).alias("mean"),
        portable_round(F.col("max"), 2).alias("max"),
        "n_hours",
        "unit",
    )


def list_measurements(
    tables: Tables,
    wanted: MeasurementFilter = MeasurementFilter(),
    page: int = 1,
    per_page: int = settings.PER_PAGE,
) -> tuple[DataFrame, DataFrame]:
    """A page of measurements, latest first, and its page information."""
    rows = measurements_matching(tables, wanted)
    order = [F.desc("date"), F.col("station_code"), F.col("pollutant_code")]
    return paging.page_of(rows, order, page, per_page), paging.page_info(rows, page, per_page)


def measurement_documents(
    tables: Tables, flagged: str = "PM25", threshold: float = settings.GUIDELINE
) -> DataFrame:
    """H2 for every measurement."""
    return nested.measurement_document(
        tables["daily_measurement"],
        tables["station"],
        tables["pollutant"],
        tables["weather_day"],
        tables["episode"],
        flagged,
        threshold,
    )


def get_measurement(tables: Tables, measurement_id: int, **options) -> DataFrame:
    """One measurement's document; an unknown identifier gives no row."""
    one = filters.lookup(tables["daily_measurement"], "measurement_id", measurement_id)
    return measurement_documents({**tables, "daily_measurement": one}, **options)
