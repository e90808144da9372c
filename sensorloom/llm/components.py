"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import sent, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: every node of a link with the smallest node that it reaches.

    Large-star and small-star steps in turn: each node's neighbours are linked to the least of them, until
    only stars are left. Every step groups and joins by node, from tables in the shared folder; only a
    count and a checksum come to the driver. Links of a node to itself and NULL ends say nothing. Stars
    compress to a byte or two a row, so that the least neighbours are counted before they go to every task.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(sent(least, least.count()), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        met = large.join(sent(least, least.count()), "u")
        small = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(least.select("u", F.col("m").alias("v")).unionAll(small).distinct(), "small-star")
        last, state = state, _state(edges)
        if state == last:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
