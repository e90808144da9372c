"""The two halves of a table by a Bloom filter of keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.llm.membership import absent, passing


def test_every_given_key_passes_and_halves_make_the_whole(spark):
    rows = spark.range(5000).select(F.col("id"), F.lit("b").alias("block"), F.lit(1).alias("w0"))
    given = spark.range(0, 5000, 50)
    inside, outside = passing(rows, F.col("id"), given), absent(rows, F.col("id"), given)
    assert inside.columns == outside.columns == rows.columns
    found, rest = [sorted(r.id for r in half.collect()) for half in (inside, outside)]
    assert sorted(found + rest) == list(range(5000))
    assert set(range(0, 5000, 50)) <= set(found) and len(found) < 300


def test_null_keys_repeated_rows_and_no_keys(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("a",), ("b",)], "key string")
    given = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert [r.key for r in passing(rows, F.col("key"), given.filter("key = 'a'")).collect()] == ["a", "a"]
    assert sorted(str(r.key) for r in absent(rows, F.col("key"), given).collect()) == ["None", "b"]
    nothing = given.limit(0)
    assert passing(rows, F.col("key"), nothing).collect() == [] and absent(rows, F.col("key"), nothing).count() == 4
