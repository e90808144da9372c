"""Declared schemas, keys and references of the tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from sensorloom import settings


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_S, _I, _L, _D, _DAY = StringType(), IntegerType(), LongType(), DoubleType(), DateType()

STATION = _schema(station_id=_I, station_code=_S, station_name=_S, station_type=_S)
POLLUTANT = _schema(pollutant_id=_I, pollutant_code=_S, pollutant_name=_S, unit=_S)
CALENDAR = _schema(
    date=_DAY,
    year=_I,
    month=_I,
    day_of_week=_I,
    is_weekend=_I,
    is_public_holiday=_I,
    holiday_name=_S,
    is_school_holiday=_I,
    school_holiday_name=_S,
)
WEATHER_MEASURES = list(settings.WEATHER_CODES.values())
WEATHER_DAY = _schema(date=_DAY, **{name: _D for name in WEATHER_MEASURES})
HOURLY = _schema(timestamp=TimestampNTZType(), station_code=_S, pollutant_code=_S, value=_D)
DAILY = _schema(date=_DAY, station_code=_S, pollutant_code=_S, mean=_D, max=_D, n_hours=_L)
DAILY_MEASUREMENT = _schema(
    measurement_id=_L, date=_DAY, station_id=_I, pollutant_id=_I, mean=_D, max=_D, n_hours=_I
)
EPISODE_EVENT = _schema(
    date=_DAY,
    pollutant=_S,
    level=_S,
    source=_S,
    forecast=_S,
    observed=_S,
    forecast_result=_S,
    criterion_population=_S,
    criterion_area=_S,
)
EPISODE = _schema(
    episode_id=_L,
    date=_DAY,
    pollutant_id=_I,
    level=_S,
    source=_S,
    forecast=_I,
    observed=_I,
    forecast_result=_S,
    criterion_population=_I,
    criterion_area=_I,
)
DENORMALISED = _schema(
    date=_DAY,
    year=_I,
    month=_I,
    day_of_week=_I,
    is_weekend=_I,
    is_public_holiday=_I,
    is_school_holiday=_I,
    station_code=_S,
    station_name=_S,
    station_type=_S,
    pollutant_code=_S,
    pollutant_name=_S,
    unit=_S,
    daily_mean=_D,
    hourly_max=_D,
    n_hours=_I,
    above_who_pm25=_I,
    **{name: _D for name in WEATHER_MEASURES},
    episode_level=_S,
)
PUBLIC_HOLIDAYS = _schema(date=_DAY, holiday_name=_S)
SCHOOL_DAYS = _schema(date=_DAY, holiday_name=_S, is_school_holiday=_I)

# A table is written after the tables it points to.
TABLE_ORDER = ["station", "pollutant", "calendar", "weather_day", "daily_measurement", "episode"]
STAR = {
    "station": STATION,
    "pollutant": POLLUTANT,
    "calendar": CALENDAR,
    "weather_day": WEATHER_DAY,
    "daily_measurement": DAILY_MEASUREMENT,
    "episode": EPISODE,
}
KEYS = {
    "station": [["station_id"], ["station_code"]],
    "pollutant": [["pollutant_id"], ["pollutant_code"]],
    "calendar": [["date"]],
    "weather_day": [["date"]],
    "daily_measurement": [["measurement_id"], ["date", "station_id", "pollutant_id"]],
    "episode": [["episode_id"], ["date", "pollutant_id"]],
}
REFERENCES = [
    ("daily_measurement", "station_id", "station"),
    ("daily_measurement", "pollutant_id", "pollutant"),
    ("daily_measurement", "date", "calendar"),
    ("weather_day", "date", "calendar"),
    ("episode", "date", "calendar"),
    ("episode", "pollutant_id", "pollutant"),
]
NOT_NULL = {
    "station": STATION.names,
    "pollutant": POLLUTANT.names,
    "calendar": ["date", "year", "month", "day_of_week", "is_weekend"],
    "weather_day": ["date"],
    "daily_measurement": ["measurement_id", "date", "station_id", "pollutant_id", "mean", "n_hours"],
    "episode": ["episode_id", "date", "pollutant_id", "level", "source"],
}
MAX_LENGTH = {
    "station": {"station_code": 10, "station_name": 100, "station_type": 20},
    "pollutant": {"pollutant_code": 10, "pollutant_name": 50, "unit": 15},
    "calendar": {"holiday_name": 50, "school_holiday_name": 60},
    "episode": {"level": 15, "source": 15, "forecast_result": 30},
}
