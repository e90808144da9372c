"""Predicates and filter composition."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.functions.text import collated


def all_of(conditions: Iterable[Column | None]) -> Column:
    """The conjunction of the conditions that were given; none means everything."""
    given = [condition for condition in conditions if condition is not None]
    return reduce(lambda a, b: a & b, given, F.lit(True))


def equals_code(column: Column, code: str | None) -> Column | None:
    """Equality with an upper-cased code; an empty code filters nothing."""
    return column == code.upper() if code else None


def equals_text(column: Column, value: str | None, collation: str = settings.COLLATION) -> Column | None:
    """Equality under a collation, for text as people type it; an empty text filters nothing."""
    return collated(column, collation) == collated(F.lit(value), collation) if value else None


def one_of(column: Column, value: str | None, allowed: Sequence[str], name: str) -> Column | None:
    """Equality with a member of an enumeration, anything else is an error."""
    if value is not None and value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}")
    return column == value if value else None


def parse_day(value: str | datetime.date | None, name: str) -> datetime.date | None:
    """An ISO day, or an error that names the parameter."""
    if value is None or isinstance(value, datetime.date):
        return value
    try:
        return datetime.date.fromisoformat(value)
    except ValueError as error:
        raise ValueError(f"{name}: {value!r} is no ISO day such as 2024-01-31") from error


def within_days(
    column: Column, start: str | datetime.date | None, end: str | datetime.date | None
) -> Column:
    """An inclusive range of days, open where a bound is missing."""
    low, high = parse_day(start, "start"), parse_day(end, "end")
    return all_of(
        [column >= F.lit(low) if low else None, column <= F.lit(high) if high else None]
    )


def with_date_range(
    df: DataFrame, start: str | datetime.date, end: str | datetime.date, year: str = "year", date: str = "date"
) -> DataFrame:
    """C3 on a table partitioned by year: the day range plus the year range that prunes."""
    low, high = parse_day(start, "start"), parse_day(end, "end")
    return df.filter(F.col(year).between(low.year, high.year) & within_days(F.col(date), low, high))


def differs_or_missing(column: Column, value: str) -> Column:
    """Not the value; a missing value is kept."""
    return ~column.eqNullSafe(F.lit(value))


def split_known(df: DataFrame, known: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that satisfy a predicate and the rows that do not (NULL counts as not)."""
    sure = F.coalesce(known, F.lit(False))
    return df.filter(sure), df.filter(~sure)


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a NULL in the columns."""
    return df.dropna("any", subset=list(columns) if columns else None)


def matches_and_type(
    name: Column, pattern: str, kind: Column, wanted: str
) -> Column:
    """A name pattern together with a type."""
    return name.rlike(pattern) & (kind == wanted)


def lookup(df: DataFrame, key: str, value, upper: bool = False) -> DataFrame:
    """The rows of one key; none found gives an empty result."""
    return df.filter(F.col(key) == (value.upper() if upper else value))
