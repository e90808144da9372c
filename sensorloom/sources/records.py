"""Records of quoted delimited text, cut by as many tasks as a file has splits.

A line break between quotes belongs to its cell, so whether a line begins a record depends on all quotes before
it. The raw lines are scanned once: each task numbers the lines of its splits and counts the quotes before each
line of a split, and stores them. A split's quotes make it odd or even; a prefix sum over the splits of a file, one
row each, then tells every split whether it begins within quotes. Lines that are records by themselves, nearly
all, are taken as they are. Only the lines of longer records are grouped: the records begun before a line, within its
split and in the splits before, number them. Any line break within a cell is read as one `\\n`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.session import stored
from sensorloom.sources.paths import decoded

LINES = "file string, block bigint, row bigint, line string, quotes bigint, quotes_before bigint, first boolean"


def raw_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The lines below a path with their file and the split that holds them; a pattern on names prunes files."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    if pattern is not None:
        text = text.filter(decoded(F.col("_metadata.file_name")).rlike(pattern))
    return text.select(
        decoded(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "^\\ufeff", "").alias("line"),
    )


def number_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their place in the file, their quotes and those before them in the split.

    A split has a line per byte at most, so its start plus a line's number orders all lines of a file. The first line of
    a file that is not blank is marked.
    """
    here, row, quotes_before, begun = None, 0, 0, False
    for batch in batches:
        if not len(batch):
            continue
        files, blocks, lines = batch.column("file").to_pylist(), batch.column("block").to_numpy(), batch.column("line")
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        filled = pc.not_equal(pc.utf8_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
        change = [n for n in range(1, len(files)) if blocks[n] != blocks[n - 1] or files[n] != files[n - 1]]
        rows, before, first = np.zeros(len(files), np.int64), np.zeros(len(files), np.int64), np.zeros(len(files), bool)
        for start, end in zip([0, *change], [*change, len(files)], strict=True):
            if here != (files[start], blocks[start]):
                here, row, quotes_before, begun = (files[start], blocks[start]), 0, 0, blocks[start] != 0
            stretch = slice(start, end)
            rows[stretch] = blocks[start] + row + np.arange(end - start)
            sums = np.cumsum(quotes[stretch])
            before[stretch] = quotes_before + sums - quotes[stretch]
            if not begun and filled[stretch].any():
                first[start + int(filled[stretch].argmax())] = begun = True
            row, quotes_before = row + end - start, quotes_before + int(sums[-1])
        columns = [batch.column("file"), batch.column("block"), pa.array(rows), lines, pa.array(quotes), pa.array(before), pa.array(first)]
        yield pa.record_batch(columns, [c.split()[0] for c in LINES.split(", ")])


class Lines(NamedTuple):
    """The stored lines of files, and how many of them open or close a quoted line break."""

    rows: DataFrame
    odd: int


def store_lines(lines: DataFrame) -> Lines:
    """Scan the raw lines once, number them and store them. Runs a job, whose write counts odd lines."""
    seen = Observation()
    numbered = lines.mapInArrow(number_lines, LINES).observe(seen, F.count_if(F.col("quotes") % 2 == 1).alias("odd"))
    return Lines(stored(numbered, "lines"), seen.get["odd"])


def records(found: Lines) -> DataFrame:
    """file, row of its first line, record and whether it is the file's first; blank ones are left out."""
    if found.odd:
        rows = with_long_records(found.rows)
    else:
        rows = found.rows.select("file", "row", "line", "first")
    return rows.filter(F.trim("line") != "").withColumnRenamed("line", "record")


def with_long_records(lines: DataFrame) -> DataFrame:
    """Lines that are records, and lines between quotes joined to one, with the row of its first."""
    in_order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per split of a file.
    splits = lines.groupBy(F.col("file").alias("of"), F.col("block").alias("at")).agg(F.sum("quotes").alias("quotes"))
    odd = splits.withColumnsRenamed({"of": "file", "at": "block"}).select(
        F.col("file").alias("of"), F.col("block").alias("at"), F.coalesce(F.sum("quotes").over(in_order) % 2, F.lit(0)).alias("inside")
    )
    same_split = (F.col("file") == F.col("of")) & (F.col("block") == F.col("at"))
    placed = lines.join(odd.filter("inside = 1"), same_split, "left").drop("of", "at")
    before = (F.coalesce("inside", F.lit(0)) + F.col("quotes_before")) % 2
    placed = placed.select("file", "block", "row", "line", "first", before.alias("within"), (F.col("quotes") % 2).alias("odd"))
    alone = placed.filter((F.col("within") == 0) & (F.col("odd") == 0)).select("file", "row", "line", "first")
    parts = placed.filter((F.col("within") == 1) | (F.col("odd") == 1)).withColumn("begins", (F.col("within") == 0).cast("bigint"))
    # Records begun in earlier splits, one row per split, and in this split, whose lines a task has held already.
    begun = parts.groupBy("file", "block").agg(F.sum("begins").alias("n")).select(
        F.col("file").alias("of"), F.col("block").alias("at"), F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("earlier")
    )
    in_split = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    numbered = parts.withColumn("upto", F.sum("begins").over(in_split)).join(begun, same_split)
    long = numbered.groupBy("file", (F.col("earlier") + F.col("upto")).alias("number")).agg(
        F.array_sort(F.collect_list(F.struct("row", "line"))).alias("lines"), F.max("first").alias("first")
    )
    joined = long.select("file", F.col("lines")[0]["row"].alias("row"), F.array_join("lines.line", "\n").alias("line"), "first")
    return alone.unionByName(joined)
