"""Rows whose key may be among given keys, and rows whose key is not, without moving a row.

The blocked Bloom filter of the keys is broadcast; its size has a bound (`urls.MOST_BLOCKS`). A row whose key is given
always passes; a longer list lets more others pass, which costs more later and changes no result. What does not pass
needs no join with the keys and stays where it is. Only DataFrame functions.

Defined results: a NULL key is not among the keys; no keys let nothing pass; repeated rows keep a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import urls


def _probed(rows: DataFrame, key: Column, given: DataFrame, among: bool) -> DataFrame:
    blocks = max(1, min(urls.MOST_BLOCKS, -(-given.count() // urls.KEYS_PER_BLOCK)))
    filter_ = urls.bloom(given.select(F.col(given.columns[0]).alias("key")), blocks)
    filter_ = filter_.select([F.col(name).alias(f"__filter_{name}") for name in filter_.columns])
    met = rows.join(F.broadcast(filter_), urls.block_of(key, blocks) == F.col("__filter_block"), "left")
    every = F.lit(True)
    for n, at in enumerate(urls.positions(key)):
        every = every & (F.getbit(f"__filter_w{n}", at) == 1)
    may = key.isNotNull() & F.coalesce(every, F.lit(False))
    return met.filter(may if among else ~may).select(rows.columns)


def passing(rows: DataFrame, key: Column, given: DataFrame) -> DataFrame:
    """The rows whose key is in the one column of `given`, and a few others. Key and column are of one type."""
    return _probed(rows, key, given, True)


def absent(rows: DataFrame, key: Column, given: DataFrame) -> DataFrame:
    """The other rows: none of them has a key of `given`."""
    return _probed(rows, key, given, False)
