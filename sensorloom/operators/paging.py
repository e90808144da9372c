"""Sorting, top-k and pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.session import scratch_path, stored


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """G1: the first k rows of an order that ends in a tie-break."""
    return df.orderBy(*order).limit(k)


def page_window(page: int = 1, per_page: int = settings.PER_PAGE, maximum: int = settings.PER_PAGE_MAX) -> tuple[int, int]:
    """A checked page number and a capped page size."""
    if page < 1 or per_page < 1:
        raise ValueError(f"pages and their sizes count from 1: page {page}, per_page {per_page}")
    return page, min(per_page, maximum)


def page_of(df: DataFrame, order: Sequence[Column], page: int = 1, per_page: int = settings.PER_PAGE) -> DataFrame:
    """One page of a total order, the tail of a top-k: its cost grows with the page's depth.

    For pages far down, number the rows once with `numbered` and take `page_of_numbered`, or go on
    from a known row with `page_after`.
    """
    page, per_page = page_window(page, per_page)
    return df.orderBy(*order).offset((page - 1) * per_page).limit(per_page)


class Numbered(NamedTuple):
    """Rows stored in a total order, a folder per sort partition, and how many rows come before each of them."""

    rows: DataFrame
    index: DataFrame


def numbered(df: DataFrame, order: Sequence[Column | str]) -> Numbered:
    """The rows with their place in a total order, written to the shared folder once.

    `_slot` is a row's place in its partition. The index has one row per partition, from a count that reads
    no column of the rows; pages and totals are looked up there. Runs a sort and two writes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    slot = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.sort(*order).withColumns({"_part": F.spark_partition_id(), "_slot": slot})
    placed.sortWithinPartitions("_part", "_slot").write.partitionBy("_part").parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    counts = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per sort partition: bounded by the shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    index = counts.select("_part", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    return Numbered(rows, stored(index, "numbered-index"))


def page_of_numbered(found: Numbered, page: int = 1, per_page: int = settings.PER_PAGE) -> DataFrame:
    """One page of numbered rows, at the same cost for any depth.

    The index names the partitions that the page lies in, nearly always one or two, and the places there: the other
    folders are not opened, and within a file the places prune row groups.
    """
    page, per_page = page_window(page, per_page)
    first, end = (page - 1) * per_page, page * per_page
    parts = found.index.filter((F.col("_first") < end) & (F.col("_first") + F.col("_rows") > first)).collect()
    if not parts:
        return found.rows.filter(F.lit(False)).drop("_part", "_slot")
    places = [
        (F.col("_part") == p._part) & F.col("_slot").between(max(first - p._first, 0), min(end - p._first, p._rows) - 1)
        for p in parts
    ]
    return found.rows.filter(reduce(Column.__or__, places)).orderBy("_part", "_slot").drop("_part", "_slot")


def page_after(df: DataFrame, after: Column, order: Sequence[Column], per_page: int = settings.PER_PAGE) -> DataFrame:
    """G3 by key: the page that follows a known last row, at the same cost for any depth."""
    return df.filter(after).orderBy(*order).limit(page_window(1, per_page)[1])


def page_info(df: DataFrame | Numbered, page: int = 1, per_page: int = settings.PER_PAGE) -> DataFrame:
    """Totals and neighbours of a page, as one row; of numbered rows from their index."""
    page, per_page = page_window(page, per_page)
    if isinstance(df, Numbered):
        total = df.index.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_items"))
    else:
        total = df.agg(F.count("*").alias("total_items"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("total_items") / per_page)).cast("int")
    return total.select(
        F.lit(page).alias("page"),
        F.lit(per_page).alias("per_page"),
        "total_items",
        pages.alias("total_pages"),
        F.when(F.lit(page) < pages, F.lit(page + 1)).alias("next_page"),
        F.when(F.lit(page) > 1, F.lit(page - 1)).alias("previous_page"),
    )
