"""Data-quality checks as queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorloom import settings
from sensorloom.functions.text import collated
from sensorloom.operators.reshape import concatenate


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """K1: keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def duplicate_spellings(df: DataFrame, key: str, collation: str = settings.COLLATION) -> DataFrame:
    """Keys that are one under a collation but spelt in several ways, or that occur more than once.

    Equal spellings are counted first, in a hash aggregate, so only different ones are compared under the
    collation. The key is shown as its first spelling in binary order; NULL is no key.
    """
    spelt = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    same = spelt.groupBy(collated(F.col(key), collation).alias("_same")).agg(
        F.min(key).alias(key), F.count("*").alias("n_spellings"), F.sum("_n").alias("n_rows")
    )
    return same.filter(F.col("n_rows") > 1).drop("_same")


def key_check(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """K1: rows, distinct keys and surplus rows of a declared key, as one row."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n"))
    return groups.agg(
        F.lit(f"{name}({', '.join(key)})").alias("check"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_bad"),
    )


def reference_check(
    child: DataFrame, parent: DataFrame, name: str, child_key: str, parent_key: str
) -> DataFrame:
    """K2: rows whose key has no parent. Keys are counted first, so a hot key joins as one row."""
    counts = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_key")).agg(
        F.count("*").alias("n")
    )
    parents = parent.select(F.col(parent_key).alias("_key")).distinct().withColumn("_found", F.lit(1))
    missing = F.col("_found").isNull()
    return counts.join(parents, "_key", "left").agg(
        F.lit(name).alias("check"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("n_bad"),
    )


def predicate_checks(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """K3, K4: rows that break each predicate, in one pass; NULL breaks it."""
    row = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.count_if(~F.coalesce(predicate, F.lit(False))).alias(f"_bad{i}")
            for i, predicate in enumerate(predicates.values())
        ],
    )
    entries = [
        F.struct(F.lit(name).alias("check"), F.col("_rows").alias("n_rows"), F.col(f"_bad{i}").alias("n_bad"))
        for i, name in enumerate(predicates)
    ]
    return row.select(F.inline(F.array(*entries)))


def not_null(columns: Sequence[str]) -> dict[str, Column]:
    """K3: predicates for `predicate_checks`."""
    return {f"{name} is not null": F.col(name).isNotNull() for name in columns}


def max_length(columns: Mapping[str, int]) -> dict[str, Column]:
    """K4: declared text lengths, for `predicate_checks`."""
    return {
        f"length({name}) <= {limit}": F.col(name).isNull() | (F.length(name) <= limit)
        for name, limit in columns.items()
    }


def coverage(df: DataFrame, station: str, time: str) -> DataFrame:
    """K5: percentage of a year's known hours that each station measured; 0 where it has none."""
    hourly = df.withColumn("year", F.year(time))
    possible = hourly.groupBy("year").agg(F.count_distinct(time).alias("_possible"))
    measured = hourly.groupBy(station, "year").agg(F.count("*").alias("_measured"))
    years = possible.agg(F.array_sort(F.collect_list("year")).alias("years"))
    every = measured.select(station).distinct().withColumn("year", F.explode(years.scalar()))
    share = F.rint(F.lit(100.0) * F.coalesce("_measured", F.lit(0)) / F.col("_possible"))
    return (
        every.join(measured, [station, "year"], "left")
        .join(possible, "year")
        .select(station, "year", share.alias("coverage_pct"))
    )


def missing_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K6: rows without a value per column, for the columns that have any, in one pass."""
    row = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(name).isNull()).alias(name) for name in columns]
    )
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(name).alias("n_missing"),
            F.try_divide(F.col(name), F.col("_rows")).alias("share"),
        )
        for name in columns
    ]
    return row.select(F.inline(F.array(*entries))).filter(F.col("n_missing") > 0)


def column_audit(
    spark: SparkSession, tables: Mapping[str, StructType], dictionary: Mapping[str, StructType]
) -> DataFrame:
    """K8: the columns of all tables, marked where the dictionary does not list them."""

    def listed(schemas):
        return [
            (table, field.name, field.dataType.simpleString())
            for table, schema in schemas.items()
            for field in schema.fields
        ]

    layout = "table string, column string, type string"
    found = spark.createDataFrame(listed(tables), layout)
    known = spark.createDataFrame(listed(dictionary), layout).select("table", "column").withColumn("_known", F.lit(1))
    return found.join(known, ["table", "column"], "left").select(
        "table", "column", "type", F.col("_known").isNull().alias("refused")
    )


def filled_values(tables: Mapping[str, DataFrame]) -> DataFrame:
    """K6, K8: values per table and column, one pass per table."""
    parts = []
    for name, df in tables.items():
        row = df.agg(*[F.count(column).alias(column) for column in df.columns])
        entries = [
            F.struct(
                F.lit(name).alias("table"), F.lit(column).alias("column"), F.col(column).alias("n_filled")
            )
            for column in df.columns
        ]
        parts.append(row.select(F.inline(F.array(*entries))))
    return concatenate(*parts)


def row_counts(tables: Mapping[str, DataFrame], output: str = "n_rows") -> DataFrame:
    """Rows per table, as one table."""
    parts = [
        df.agg(F.lit(name).alias("table"), F.count("*").alias(output)) for name, df in tables.items()
    ]
    return concatenate(*parts)


def table_periods(tables: Mapping[str, DataFrame], day: str = "date") -> DataFrame:
    """Rows and period per dated table."""
    parts = [
        df.agg(
            F.lit(name).alias("table"),
            F.count("*").alias("n_rows"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )
        for name, df in tables.items()
    ]
    return concatenate(*parts)
