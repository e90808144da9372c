"""Tabular scans."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sensorloom.functions.dates import french_day
from sensorloom.functions.text import normalise_header
from sensorloom.operators.reshape import concatenate
from sensorloom.session import stored
from sensorloom.sources import records
from sensorloom.sources.paths import decoded, path_order

# Which files of a folder hold municipality indices.
INDEX_FILE = r"(?i)^indices.*\.csv$"
DELIMITERS = [",", ";", "\t", "|"]

INPUT_ORDER = ["_file", "_row"]


def text_schema(names: Sequence[str]) -> StructType:
    """All columns as text: types are cast where a bad cell can become NULL."""
    return StructType([StructField(name, StringType(), True) for name in names])


def cells_of(line: str, delimiter: str) -> list[str]:
    """The names in a header line, stripped and unquoted."""
    return [name.strip() for name in next(csv.reader([line], delimiter=delimiter))]


def sniff_delimiter(line: str) -> str:
    """The delimiter that occurs most often in a header line."""
    return max(DELIMITERS, key=line.count)


def scan_csv(
    spark: SparkSession, path: str, delimiter: str | None = ",", pattern: str | None = None
) -> DataFrame:
    """CSV files by header name, all text; files with other columns are united by name.

    Without a delimiter the header line decides. `_file`, the file's rank by path, and `_row` keep the
    input order for the keep-first rules. The files are scanned once and their lines stored (see
    `records`); what comes to the driver are different header lines, not files.
    """
    return parsed(records.raw_lines(spark, path, pattern), path, delimiter)


def parsed(lines: DataFrame, path: str, delimiter: str | None = ",") -> DataFrame:
    """`scan_csv` of the raw lines of some files."""
    found = records.records(records.store_lines(lines))
    heads = found.filter("first").select(F.col("file").alias("of"), F.col("record").alias("header"))
    # One row per file: the driver has listed as many.
    by_path = Window.orderBy(path_order(F.col("of")))
    files = stored(heads.select("of", "header", F.row_number().over(by_path).alias("_file")), "files")
    layouts = sorted(row.header for row in files.select("header").distinct().collect())
    if not layouts:
        raise FileNotFoundError(f"no matching file below {path}")
    rows = found.filter(~F.col("first")).join(files, F.col("file") == F.col("of"))
    parts = []
    for header in layouts:
        separator = delimiter or sniff_delimiter(header)
        names = cells_of(header, separator)
        options = {"sep": separator, "escape": '"'}
        cells = F.from_csv("record", text_schema([f"c{n}" for n in range(len(names))]).simpleString()[7:-1].replace(":", " "), options)
        own = rows.filter(F.col("header") == header).select(cells.alias("cells"), "_file", F.col("row").alias("_row"))
        # A name that a header repeats stands for its first column.
        chosen = [(n, name) for n, name in enumerate(names) if name not in names[:n]]
        parts.append(own.select(*[F.col(f"cells.c{n}").alias(name) for n, name in chosen], *INPUT_ORDER))
    return concatenate(*parts)


def resolve_column(df: DataFrame, spellings: Sequence[str], required: bool = True) -> str | None:
    """The column under the spelling listed first of those that the table has."""
    present = sorted(set(spellings) & set(df.columns), key=spellings.index)
    if required and not present:
        raise KeyError(f"no column is spelled like any of {', '.join(spellings)}")
    return present[0] if present else None


def read_school_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Holiday periods, with normalised headers."""
    df = scan_csv(spark, path, delimiter=None)
    return df.toDF(*[name if name in INPUT_ORDER else normalise_header(name) for name in df.columns])


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather files of any number of years: ';', decimal comma, all text."""
    return scan_csv(spark, path, ";")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alert history, the CSV file of the folder whose name comes first; the others are not read."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    first = names.agg(F.min(decoded(F.col("path"))).alias("path")).first()["path"]
    if first is None:
        raise FileNotFoundError(f"no CSV file in {path}")
    # A condition on the path prunes files before any is opened.
    return parsed(records.raw_lines(spark, path).filter(F.col("file") == first), path)


def read_indices(spark: SparkSession, path: str, pattern: str | None = INDEX_FILE) -> DataFrame:
    """Municipality indices of all files, with their day parsed."""
    df = scan_csv(spark, path, pattern=pattern)
    return df.withColumn("date", french_day(F.col("date")))


def map_rows(
    df: DataFrame,
    column: str,
    key: str = "date",
    value: str = "holiday_name",
    keep: Sequence[str] = (),
) -> DataFrame:
    """JSON objects `{key: value}` -> a row per entry."""
    return df.select(*keep, F.explode(F.from_json(column, "map<string,string>")).alias(key, value))


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Public holidays from one JSON object per file."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return map_rows(files, "value").select(
        F.to_date("date").alias("date"), "holiday_name"
    )


def read_optional(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, bool]:
    """A typed table, or an empty one and False where the path does not exist."""
    try:
        return spark.read.schema(schema).parquet(path), True
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema), False
