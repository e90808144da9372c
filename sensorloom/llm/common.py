"""What the operators of this folder share: tables, scratch, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows in a new table of the shared folder, read back: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of counted rows up to which a side of a join goes to every task.
SENT_BYTES = 8 << 20


def sent(df: DataFrame, rows: int, width: int = 64) -> DataFrame:
    """A side of a join, at most so many rows of about so many bytes: it goes to every task, or both sides are sorted.

    To the planner a stored table is as large as its compressed files and an exploded row is one row. It would
    bring rows to the driver, to send them to every task, that take many times more memory than that.
    """
    return F.broadcast(df) if rows * width <= SENT_BYTES else df.hint("merge")


def joined(left: DataFrame, right: DataFrame, on: str, rows: tuple[int, int], widths: tuple[int, int] = (64, 64)) -> DataFrame:
    """The inner join of two counted sides; the smaller one says how."""
    if rows[0] * widths[0] < rows[1] * widths[1]:
        return sent(left, rows[0], widths[0]).join(right, on)
    return left.join(sent(right, rows[1], widths[1]), on)


def whole_text(name: str = "text") -> Column:
    """The text, the empty string where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo the divisor; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
