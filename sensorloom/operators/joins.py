"""Joins (D1-D4, D6-D11).

Catalyst broadcasts a side whose statistics are below `spark.sql.autoBroadcastJoinThreshold`, AQE does so when a
shuffled side turns out to be small, and beyond that both fall back to a sort-merge join whose skewed partitions AQE
splits. A hint is only given to a dimension that was counted first (`dimension`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.text import collated


# Rows of a dimension that go to every task, some 50 MB of keys and codes.
DIMENSION_ROWS = 500_000


def dimension(df: DataFrame, rows: int = DIMENSION_ROWS) -> DataFrame:
    """A table to look codes up in. One of up to so many rows goes to the facts, which then are not shuffled; it is
    counted for that, as estimates of a derived table are far too high. A larger one is joined by size as any table."""
    return F.broadcast(df) if df.count() <= rows else df


def star(fact: DataFrame, *dimensions: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Inner equi-joins of a fact with its dimensions."""
    for dimension, key in dimensions:
        fact = fact.join(dimension, key, "inner")
    return fact


def with_context(fact: DataFrame, *contexts: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Left equi-joins; the context must be unique on its key (K1) or rows multiply."""
    for context, key in contexts:
        fact = fact.join(context, key, "left")
    return fact


def lookup_id(
    df: DataFrame, dimension: DataFrame, code: str, identifier: str, strict: bool = True, collation: str | None = None
) -> DataFrame:
    """Replace a code by its identifier; a code that the dimension lacks is an error that names it.

    A NULL code has no identifier, and unless `strict` neither has an unknown one. Under a collation (T16) codes
    meet whatever their spelling; the dimension must have each once (K1 `duplicate_spellings`).
    """
    missing = F.raise_error(F.concat(F.lit(f"{code} without {identifier}: "), F.col(code).cast("string")))
    kind = dimension.schema[identifier].dataType
    found = F.when(F.col(identifier).isNull() & F.col(code).isNotNull(), missing.cast(kind)).otherwise(F.col(identifier))
    keys = dimension.select(code, identifier)
    if collation is not None:
        df, keys = (t.withColumn(code, collated(F.col(code), collation)) for t in (df, keys))
    met = df.join(keys, code, "left")
    return (met.withColumn(identifier, found) if strict else met).drop(code)


def keep_matching(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key exists on the other side."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def keep_missing(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not exist on the other side."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def flag_matching(df: DataFrame, other: DataFrame, key: str | Sequence[str], flag: str) -> DataFrame:
    """1 where the key exists on the other side, else 0.

    The other side is reduced to its distinct keys first, so rows cannot multiply.
    """
    keys = [key] if isinstance(key, str) else list(key)
    found = other.select(*keys).distinct().withColumn(flag, F.lit(1))
    return df.join(found, keys, "left").withColumn(flag, F.coalesce(flag, F.lit(0)))


def expand_intervals(
    df: DataFrame, start: Column, end: Column, day: str, keep: Sequence[str]
) -> DataFrame:
    """One row per day of [start, end); an empty or reversed interval gives none."""
    bounded = df.filter(start < end)
    return bounded.select(F.explode(F.sequence(start, F.date_sub(end, 1))).alias(day), *keep)
