"""Files dropped into a folder: the daily aggregate (E1) as a stream that ends when it is caught up.

An hour keeps one value and a day is published once, when its watermark says that no more of its
hours can arrive. State is one row per open hour and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sensorloom.functions.numeric import mean_of_parts, portable_round, scaled
from sensorloom.operators.completeness import at_least


def read_dropped(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Typed Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def daily_stream(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    value: str,
    min_hours: int,
    lateness: str = "2 days",
    decimals: int = 4,
) -> DataFrame:
    """E1 with a watermark: a day is emitted once, when no more of its hours can arrive.

    One value per hour is kept, the smallest, so a file delivered twice changes nothing.
    """
    hour = F.window(time, "1 hour").alias("hour")
    hourly = (
        stream.withWatermark(time, lateness)
        .groupBy(hour, *keys)
        .agg(F.min(value).alias("value"))
    )
    daily = hourly.groupBy(F.window("hour", "1 day").alias("day"), *keys).agg(
        F.try_sum(scaled(F.col("value"), decimals)).alias("total"),
        F.count(scaled(F.col("value"), decimals)).alias("fitting"),
        F.sum(F.col("value").cast("double")).alias("plain"),
        F.max("value").alias("max"),
        F.count("value").alias("n_hours"),
    )
    mean = mean_of_parts(F.col("total"), F.col("fitting"), F.col("plain"), F.col("n_hours"), decimals)
    return at_least(daily, "n_hours", min_hours).select(
        F.col("day.start").cast("date").alias("date"),
        *keys,
        portable_round(mean, 2, "half_even").alias("mean"),
        portable_round(F.col("max"), 2, "half_even").alias("max"),
        "n_hours",
    )


def run_until_caught_up(daily: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the finished days to a Parquet table and stop."""
    return (
        daily.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
