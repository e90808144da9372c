"""Date and zone expressions.

Clock times are TIMESTAMP_NTZ throughout and zones are named, so no result depends on the zone
of the session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom import settings


def utc_clock(instant: Column) -> Column:
    """An instant (TIMESTAMP) as its UTC clock time."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def to_zone(utc: Column, zone: str = settings.ZONE) -> Column:
    """A UTC clock time as the clock time of a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def iso_utc(text: Column) -> Column:
    """ISO text -> UTC clock time; text without an offset is read as UTC.

    Text that is no time becomes NULL.
    """
    has_zone = F.trim(text).rlike("(Z|[+-]\\d{2}(:?\\d{2})?)$") & F.trim(text).rlike("\\d{2}:\\d{2}")
    plain = F.try_to_timestamp(F.concat(F.trim(text), F.lit("Z")))
    day = F.try_to_timestamp(F.concat(F.trim(text), F.lit(" 00:00:00Z")))
    zoned = F.try_to_timestamp(F.trim(text))
    is_day = F.trim(text).rlike("^\\d{4}-\\d{2}-\\d{2}$")
    return utc_clock(F.when(is_day, day).when(has_zone, zoned).otherwise(plain))


def hour_start_local(end_utc: Column, zone: str = settings.ZONE) -> Column:
    """B2: the UTC end of a measured hour -> its local start."""
    return to_zone(F.timestamp_add("HOUR", F.lit(-1), end_utc), zone)


def floor_hour(clock: Column) -> Column:
    """The start of the hour of a clock time."""
    return F.timestamp_add("HOUR", F.hour(clock), clock.cast("date").cast("timestamp_ntz"))


def clock_seconds(clock: Column) -> Column:
    """Seconds of a clock time since 1970, as if it were UTC."""
    days = F.unix_date(clock.cast("date")).cast("bigint")
    return days * 86400 + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)


def day_of(clock: Column) -> Column:
    """The day of a clock time."""
    return clock.cast("date")


def local_day(utc: Column, zone: str = settings.ZONE) -> Column:
    """The local day of a UTC clock time."""
    return day_of(to_zone(utc, zone))


def slashed_utc_to_local_day(text: Column, zone: str = settings.ZONE) -> Column:
    """B9: 'yyyy/MM/dd HH:mm:ss+00' -> local day; other text becomes NULL."""
    clock = F.regexp_extract(text, "^(\\d{4}/\\d{2}/\\d{2} \\d{2}:\\d{2}:\\d{2})\\+00$", 1)
    return local_day(iso_utc(F.replace(F.nullif(clock, F.lit("")), F.lit("/"), F.lit("-"))), zone)


def compact_day(text: Column) -> Column:
    """B10: 'yyyyMMdd' -> day."""
    return F.try_to_date(text.cast("string"), "yyyyMMdd")


def french_day(text: Column) -> Column:
    """B10: 'dd/MM/yyyy' -> day."""
    return F.try_to_date(text, "dd/MM/yyyy")


def iso_to_local_day(text: Column, zone: str = settings.ZONE) -> Column:
    """ISO text with an offset -> local day."""
    return local_day(iso_utc(text), zone)


def iso_day_text(day: Column) -> Column:
    """A day as 'yyyy-MM-dd' text."""
    return F.date_format(day, "yyyy-MM-dd")


def weekday_from_1(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(day) + 1


def weekday_from_0(day: Column) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(day)


def is_weekend(day: Column) -> Column:
    """1 on Saturday and Sunday."""
    return (F.weekday(day) >= 5).cast("int")
