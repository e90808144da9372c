"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.session import scratch_path


def dense_ids(df: DataFrame, order: Sequence[Column | str], identifier: str) -> DataFrame:
    """1, 2, 3, .. in a total order, without sorting anything in one task.

    A range sort splits hot values of the first order column because the whole order is unique.
    The sorted rows are written to the shared folder, so the counts per partition and the numbered
    rows see the same partitions even when an executor is lost in between.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ordered")
    df.sort(*order).withColumn("_slot", F.monotonically_increasing_id()).write.parquet(path)
    ordered = spark.read.parquet(path)
    part = F.shiftrightunsigned("_slot", 33).alias("_part")
    counts = ordered.groupBy(part).agg(F.count("*").alias("_rows"))
    # One row per sort partition: bounded by the shuffle partitions, hence window and broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(
        (F.col("_offset") + within + 1).alias(identifier), *[F.col(name) for name in df.columns]
    )


def small_ids(df: DataFrame, order: Sequence[Column | str], identifier: str) -> DataFrame:
    """N1 for a dimension: the same numbering, as 32-bit keys."""
    return dense_ids(df, order, identifier).withColumn(identifier, F.col(identifier).cast("int"))
