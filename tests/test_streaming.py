"""The incremental daily aggregate equals the batch one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sensorloom.operators.completeness import aggregate_daily
from sensorloom.streaming import incremental


def test_stream_equals_batch(spark, tmp_path):
    layout = "t timestamp, station string, value double"

    def drop(rows):
        spark.createDataFrame(rows, layout).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def hours(day, n, value):
        return [(dt.datetime(2024, 1, day, h), "s", value + h) for h in range(n)]

    first, second = hours(1, 24, 1.0), hours(2, 17, 2.0) + hours(3, 20, 3.0)
    drop(first)
    # A file delivered twice changes nothing; a later day closes the earlier ones.
    drop(first + second)
    drop(hours(20, 1, 0.0))
    schema = spark.createDataFrame([], layout).schema
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(3):
        stream = incremental.read_dropped(spark, str(tmp_path / "in"), schema)
        daily = incremental.daily_stream(stream, "t", ["station"], "value", 18)
        incremental.run_until_caught_up(daily, out, checkpoint).awaitTermination()
        drop(hours(25, 1, 0.0))
    found = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    unique = spark.createDataFrame(first + second, layout)
    batch = aggregate_daily(unique, F.col("t").cast("date"), ["station"], "value", 18)
    expected = sorted((r.date, r.station, r["mean"], r["max"], r.n_hours) for r in batch.collect())
    assert found == expected and len(found) == 2
