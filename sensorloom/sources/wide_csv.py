"""Wide sensor exports (A1-A5): header rows above one column per station.

Files differ in their columns, so they are read as lines and every cell becomes a row. A cell
carries its file and position; the header becomes a small table with the same key.

The raw files are scanned once. That pass is narrow, it writes header lines, data lines and filled cells to
one typed table in the shared folder, and what is to be counted of every cell is counted by the write
itself. Headers, checks, cells and audits are all read from there.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.functions import dates
from sensorloom.functions.numeric import to_double
from sensorloom.session import stored
from sensorloom.sources.paths import decoded, path_order

# Accepted file names and the look of a data line.
STATION_FILE = r"(?i)(\d{4})[ _-]([A-Z0-9]+)\.csv$"
SEGMENT_FILE = r"(?i)(\d{4})[ _-]([A-Z0-9]+)[ _-]boulevard.*\.csv$"
DATA_LINE = r"^\d{4}-\d{2}-\d{2}"

# Stands for a comma that ends a cell; a control character that no text holds.
BREAK = "\x1f"

# The places of rows that are no cell: a header line, and a data line, whose first cell is its time.
HEADER_LINE, TIMED_LINE = -1, 0

HEADER_FIELDS = {
    2: "station_name",
    3: "station_code",
    4: "pollutant_name",
    5: "pollutant_code",
    6: "unit",
}


def read_lines(spark: SparkSession, folder: str, name_pattern: str) -> DataFrame:
    """A4: the non-blank lines of all matching files below a folder.

    `line_id` grows along each file. Large files are split between tasks as any text file is.
    """
    name = decoded(F.col("_metadata.file_name"))
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(folder)
        .filter(name.rlike(name_pattern))
        .select(
            decoded(F.col("_metadata.file_path")).alias("file"),
            F.monotonically_increasing_id().alias("line_id"),
            F.regexp_replace("value", "[\\r\\ufeff]", "").alias("line"),
        )
        .filter(F.trim("line") != "")
    )


def split_row(line: Column) -> Column:
    """The cells of a row; a quoted cell may hold commas and doubled quotes.

    Between quotes every second piece is outside of them; only commas there end a cell. One pass, so a
    row may be of any length.
    """
    pieces = F.split(line, '"', -1)
    marked = F.transform(pieces, lambda piece, at: F.when(at % 2 == 0, F.translate(piece, ",", BREAK)).otherwise(piece))
    quoted = F.transform(
        F.split(F.array_join(marked, '"'), BREAK, -1),
        lambda cell: F.trim(
            F.replace(F.regexp_replace(F.trim(cell), '(?s)^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))
        ),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.transform(F.split(line, ",", -1), lambda cell: F.trim(cell)))


class RawPass(NamedTuple):
    """What the one scan of the raw lines leaves: the stored rows, and counts of their values."""

    rows: DataFrame
    counts: dict[str, float | int | None]


def line_time() -> Column:
    """The time that a data line begins with; NULL if there is no such time."""
    return dates.iso_utc(F.replace(F.substring_index("line", ",", 1), F.lit('"'), F.lit("")))


def raw_rows(lines: DataFrame, zone: str = settings.ZONE) -> DataFrame:
    """A row per header line, per data line and per filled cell of a data line.

    `pos` is the place of a cell, or says which line it is. Lines carry their file, `line_id` and, of the
    header, their text; cells carry a key of the file, the time of their line, also as local start of the
    hour, and their number, NULL if they hold none. Times are parsed and moved to the zone once per line.
    """
    is_data = F.col("line").rlike(DATA_LINE)
    parsed = lines.select(
        "file",
        "line_id",
        F.xxhash64("file").alias("file_key"),
        F.when(~is_data, F.col("line")).alias("text"),
        F.when(is_data, line_time()).alias("time"),
        F.when(is_data, split_row(F.col("line"))).alias("cells"),
    ).withColumn("timestamp", dates.hour_start_local(F.col("time"), zone))
    cells = parsed.select("*", F.posexplode_outer("cells").alias("place", "cell"))
    pos = F.coalesce("place", F.lit(HEADER_LINE))
    is_cell = pos > TIMED_LINE
    return cells.filter(~is_cell | (F.col("time").isNotNull() & (F.trim("cell") != ""))).select(
        F.when(~is_cell, F.col("file")).alias("file"),
        F.when(~is_cell, F.col("line_id")).alias("line_id"),
        "text",
        "file_key",
        pos.alias("pos"),
        "time",
        "timestamp",
        F.when(is_cell, to_double(F.col("cell"))).alias("value"),
    )


def store_pass(lines: DataFrame, zone: str = settings.ZONE) -> RawPass:
    """Scan the raw lines once and store what they hold; the write counts values as they go by (K7).

    No row is shuffled, so every task counts its rows once. Runs a job.
    """
    seen = Observation()
    rows = raw_rows(lines, zone).observe(
        seen,
        F.count("value").alias("n_values"),
        F.count_if(F.col("value") < 0).alias("n_negative"),
        F.min("value").alias("lowest_value"),
    )
    return RawPass(stored(rows, "raw-pass"), seen.get)


def layout_of(rows: DataFrame) -> DataFrame:
    """The header lines of every file and where its data starts, from the rows of a pass.

    A row per header line, and one row per file whose `line` is NULL for its first data line and the
    number of data lines with an impossible time.
    """
    heads = rows.filter(F.col("pos") == HEADER_LINE).select("file", "file_key", F.col("text").alias("line"), "line_id", F.lit(0).cast("bigint").alias("bad_times"))
    data = rows.filter(F.col("pos") == TIMED_LINE).groupBy("file", "file_key")
    firsts = data.agg(F.min("line_id").alias("line_id"), F.count_if(F.col("time").isNull()).alias("bad_times"))
    return heads.unionByName(firsts.withColumn("line", F.lit(None).cast("string")))


def read_layout(lines: DataFrame) -> DataFrame:
    """`layout_of` raw lines, for a check of the layout alone."""
    return layout_of(raw_rows(lines))


def header_report(layout: DataFrame, header_lines: int = settings.HEADER_LINES) -> DataFrame:
    """A2: per file, whether exactly the expected header stands before the first data line, and whether
    every data line has a time."""
    is_header = F.col("line").isNotNull()
    report = layout.groupBy("file").agg(
        F.count_if(is_header).alias("header_lines"),
        F.max(F.when(is_header, F.col("line_id"))).alias("last_header"),
        F.min(F.when(~is_header, F.col("line_id"))).alias("first_data"),
        F.sum("bad_times").alias("bad_times"),
    )
    good = (
        (F.col("header_lines") == header_lines)
        & (F.col("last_header") < F.col("first_data"))
        & (F.col("bad_times") == 0)
    )
    return report.select("file", F.coalesce(good, F.lit(False)).alias("well_formed"))


def require_headers(
    layout: DataFrame, header_lines: int = settings.HEADER_LINES, shown: int = 5
) -> None:
    """A2: stop when any file has another layout or impossible times, with their number and the first names."""
    bad = header_report(layout, header_lines).filter(~F.col("well_formed"))
    count = bad.count()
    if count:
        names = [row.file for row in bad.orderBy("file").limit(shown).collect()]
        rest = f" and {count - len(names)} more" if count > len(names) else ""
        raise ValueError(f"{count} files without {header_lines} header lines above timed data lines: {', '.join(names)}{rest}")


def column_metadata(layout: DataFrame, header_lines: int = settings.HEADER_LINES) -> DataFrame:
    """A3: one row per column of the well-formed files, numbered through all files.

    `file_key` and `pos` lead to its cells.

    `column` grows with the path of the file and the position in it (T2): one number stands for
    both wherever cells are joined or compared.
    """
    good = header_report(layout, header_lines).filter("well_formed").select("file")
    rows = layout.filter(F.col("line").isNotNull()).join(good, "file", "left_semi")
    # Exactly `header_lines` rows per file are left to number.
    in_file = Window.partitionBy("file").orderBy("line_id")
    cells = rows.select("file", F.row_number().over(in_file).alias("line_no"), split_row(F.col("line")).alias("cells"))
    # One row per file: the driver has listed as many.
    before = Window.orderBy(path_order(F.col("file"))).rowsBetween(Window.unboundedPreceding, -1)
    files = cells.groupBy("file").agg(F.max(F.size("cells")).cast("bigint").alias("width"))
    offsets = files.select("file", F.coalesce(F.sum("width").over(before), F.lit(0)).alias("first_column"))
    named = (
        cells.select("file", "line_no", F.posexplode("cells").alias("pos", "cell"))
        .filter(F.col("pos") > 0)
        .groupBy("file", "pos")
        .agg(
            *[
                F.max(F.when(F.col("line_no") == number, F.col("cell"))).alias(name)
                for number, name in HEADER_FIELDS.items()
            ]
        )
    )
    return named.join(offsets, "file").select(
        "file",
        F.xxhash64("file").alias("file_key"),
        "pos",
        (F.col("first_column") + F.col("pos")).alias("column"),
        "station_code",
        "station_name",
        "pollutant_name",
        "pollutant_code",
        "unit",
    )


def filled_columns(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """The columns with their number of filled cells and of numbers: one hash aggregate over the stored pass."""
    counts = rows.filter(F.col("pos") > TIMED_LINE).groupBy("file_key", "pos").agg(F.count("*").alias("n_filled"), F.count("value").alias("n_numbers"))
    return metadata.join(counts, ["file_key", "pos"], "left").fillna(0, ["n_filled", "n_numbers"])


def read_wide(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """The cells of a pass that hold a number, with their station and pollutant."""
    cells = rows.filter((F.col("pos") > TIMED_LINE) & F.col("value").isNotNull())
    named = metadata.select("file_key", "pos", "column", "station_code", "pollutant_code")
    return cells.join(named, ["file_key", "pos"]).select(
        "column", F.col("time").alias("end_utc"), "timestamp", F.col("value").alias("raw_value"), "station_code", "pollutant_code"
    )


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """A5: files with a plain header `time,<segment>,..`; the pollutant is in the file name."""
    return segment_cells(read_lines(spark, folder, SEGMENT_FILE))


def segment_cells(lines: DataFrame) -> DataFrame:
    """A5: clock time, segment, pollutant and value of each filled cell; the lines are scanned once and stored."""
    rows = store_pass(lines).rows
    heads = rows.filter(F.col("pos") == HEADER_LINE).select(
        "file_key",
        F.upper(F.regexp_extract("file", SEGMENT_FILE, 2)).alias("pollutant_code"),
        F.posexplode(split_row(F.col("text"))).alias("pos", "segment"),
    )
    cells = rows.filter((F.col("pos") > TIMED_LINE) & F.col("value").isNotNull())
    return cells.join(heads, ["file_key", "pos"]).select("time", "segment", "pollutant_code", "value")
