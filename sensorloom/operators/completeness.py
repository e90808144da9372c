"""Daily aggregates with a completeness rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.numeric import DECIMALS, exact_mean, portable_round


def at_least(df: DataFrame, count: str, minimum: int) -> DataFrame:
    """Groups with enough observations."""
    return df.filter(F.col(count) >= minimum)


def summarise_days(
    df: DataFrame,
    day: Column,
    keys: Sequence[str],
    value: str,
    with_max: bool = True,
    digits: int | None = 2,
    rounding: str = "half_even",
    decimals: int = DECIMALS,
) -> DataFrame:
    """Mean, maximum and count per day and key, before any completeness rule."""

    def shown(column):
        return column if digits is None else portable_round(column, digits, rounding)

    measures = [shown(exact_mean(F.col(value), decimals)).alias("mean")]
    if with_max:
        measures.append(shown(F.max(value)).alias("max"))
    measures.append(F.count(value).alias("n_hours"))
    return df.groupBy(day.alias("date"), *keys).agg(*measures)


def aggregate_daily(
    df: DataFrame,
    day: Column,
    keys: Sequence[str],
    value: str,
    min_hours: int,
    **options,
) -> DataFrame:
    """E1 (and E2 with `with_max=False`): daily values of the days with enough hours."""
    return at_least(summarise_days(df, day, keys, value, **options), "n_hours", min_hours)
