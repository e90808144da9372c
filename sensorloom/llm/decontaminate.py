"""Benchmark decontamination by the q-gram lemma and banded alignment.

An item of m characters occurs in a text if some part of it is within k edits, k = 8 % of m (and at most
(m - q) / q, so that the lemma keeps a bound). Such a part shares at least m - q + 1 - k q character q-grams
with the item, on diagonals at most k apart. Shared q-grams are counted per item in diagonal bands of
2 (k + 1) that overlap by half; regions that meet the bound are verified by alignment in the band.

The benchmark is worked through in blocks of about BLOCK_CHARS characters, each sent to the tasks; the
documents are never shuffled. Letters are compared in lower case, white space as one kind of character.

Defined results: NULL or empty texts hold nothing and stay; items that are NULL or shorter than q
characters are ignored; repeated rows of either table are matched each; columns of other names are
kept as they are, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Q = 10
EDITS = 0.08
#: Characters of benchmark text sent to the tasks at once, about.
BLOCK_CHARS = 1_000_000
#: Shared q-grams expanded at once.
HITS_AT_ONCE = 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22
#: No letter with a case and no white space lies beyond.
_FOLDED = 0x20000
_LOWER = np.arange(_FOLDED, dtype=np.uint32)
for _code in range(_FOLDED):
    _folded = chr(_code).lower()
    _LOWER[_code] = ord(_folded) if len(_folded) == 1 else _code
    if chr(_code).isspace():
        _LOWER[_code] = 32


class Match(NamedTuple):
    text: int
    item: int
    edits: int
    start: int
    end: int


def codes(text: str) -> np.ndarray:
    """The characters as numbers, folded one to one."""
    found = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(found < _FOLDED, _LOWER[np.minimum(found, _FOLDED - 1)], found)


def qgrams(found: np.ndarray) -> np.ndarray:
    """A hash of every q-gram (Q = 10), by doubling."""
    with np.errstate(over="ignore"):
        one = found.astype(np.uint64)
        two = one[:-1] * _BASE + one[1:]
        power = _BASE * _BASE
        four = two[:-2] * power + two[2:]
        eight = four[:-4] * (power * power) + four[4:]
        return eight[:-2] * power + two[8:]


def _slot(hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((hashes ^ (hashes >> np.uint64(29))) * _BASE) >> np.uint64(64 - _BITS)


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids = [item for item, _ in items]
        self.codes = [codes(text) for _, text in items]
        self.size = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.edits = np.minimum((EDITS * self.size).astype(np.int64), (self.size - Q) // Q)
        self.least = self.size - Q + 1 - self.edits * Q
        hashes = [qgrams(c) for c in self.codes]
        every = np.concatenate(hashes)
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        at = np.concatenate([np.arange(len(h)) for h in hashes])
        order = np.argsort(every, kind="stable")
        self.item, self.at = item[order], at[order]
        self.hashes, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << _BITS, dtype=bool)
        self.maybe[_slot(self.hashes)] = True

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose q-gram the index has, and which it is."""
        if len(text) < Q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = qgrams(text)
        found = np.flatnonzero(self.maybe[_slot(hashes)])
        known = np.minimum(np.searchsorted(self.hashes, hashes[found]), len(self.hashes) - 1)
        same = self.hashes[known] == hashes[found]
        return found[same], known[same]


def regions(index: Index, text: np.ndarray) -> list[tuple[int, int]]:
    """(item, first diagonal of a band) with at least the shared q-grams that the lemma asks for."""
    position, known = index.hits(text)
    out: list[tuple[int, int]] = []
    if not len(position):
        return out
    keys, counts = [], []
    step = max(1, HITS_AT_ONCE // max(1, int(index.count[known].max())))
    for begin in range(0, len(position), step):
        where, gram = position[begin : begin + step], known[begin : begin + step]
        times = index.count[gram]
        place = np.repeat(index.first[gram] - np.cumsum(times) + times, times) + np.arange(times.sum())
        item = index.item[place]
        diagonal = np.repeat(where, times) - index.at[place]
        half = diagonal // (index.edits[item] + 1)
        key, count = np.unique((item << 40) + (half + (1 << 39)), return_counts=True)
        keys.append(key)
        counts.append(count)
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(back, np.concatenate(counts)).astype(np.int64)
    # A band is a half and the one after it; every half begins a band, and ends one.
    bands = np.unique(np.concatenate([key, key - 1]))
    total = np.zeros(len(bands), dtype=np.int64)
    for shift in (0, 1):
        at = np.minimum(np.searchsorted(key, bands + shift), len(key) - 1)
        total += np.where(key[at] == bands + shift, count[at], 0)
    item = bands >> 40
    half = (bands & ((1 << 40) - 1)) - (1 << 39)
    enough = total >= index.least[item]
    for one, number in zip(item[enough].tolist(), half[enough].tolist()):
        out.append((one, number * (int(index.edits[one]) + 1)))
    return out


def align(item: np.ndarray, text: np.ndarray, diagonal: int, width: int, most: int, anchored: bool = False) -> tuple[int, int]:
    """Fewest edits of the item against a part of the text within the band, and that part's end.

    Band column x of row j stands for text position diagonal + x + j. The part begins anywhere, or with the
    text if anchored. Beyond `most` edits the answer is any number above it.
    """
    far = len(item) + len(text) + 1
    steps = np.arange(width)
    # Around the text stand characters that equal none: to take one costs what leaving out its partner costs.
    low, high = diagonal, diagonal + width + len(item)
    outside = np.uint32(0xFFFFFFFF)
    padded = np.concatenate(
        [np.full(max(0, -low), outside), text[max(0, low) : max(0, high)], np.full(max(0, high - max(low, len(text))), outside)]
    )
    place = diagonal + steps
    row = np.where(place >= 0, place, far) if anchored else np.zeros(width, dtype=np.int64)
    left_out = np.full(width, far)
    for j, char in enumerate(item):
        left_out[:-1] = row[1:]
        row = np.minimum(row + (padded[j : j + width] != char), left_out + 1) - steps
        row = np.minimum.accumulate(row) + steps
        if j % 16 == 15 and row.min() > most:
            break
    best = int(row.argmin())
    return int(row[best]), min(len(text), diagonal + best + len(item))


def verified(item: np.ndarray, text: np.ndarray, diagonal: int, k: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the item in a band of 2 (k + 1) diagonals, if within k edits."""
    width = 2 * (k + 1)
    low = max(0, diagonal)
    part = text[low : max(low, diagonal + width + len(item))]
    same, raw, own = -1, part.tobytes(), item.tobytes()
    while (same := raw.find(own, same + 1)) >= 0:
        if same % 4 == 0:
            return 0, low + same // 4, low + same // 4 + len(item)
    edits, end = align(item, text, diagonal, width, k)
    if edits > k:
        return None
    # From the end backwards, which tells the start.
    back = text[max(0, end - len(item) - k) : end][::-1]
    _, length = align(item[::-1], back, -k, 2 * k + 1, k, anchored=True)
    return edits, end - length, end


def search(index: Index, texts: list[str]) -> list[Match]:
    """The best match of every item in every text: fewest edits, then first."""
    out = []
    for number, text in enumerate(texts):
        if len(text) < Q:
            continue
        found = codes(text)
        best: dict[int, tuple[int, int, int]] = {}
        for item, diagonal in regions(index, found):
            if item in best and best[item][0] == 0:
                continue  # bands come in the order of the text: none is better and earlier
            match = verified(index.codes[item], found, diagonal, int(index.edits[item]))
            if match and (item not in best or match < best[item]):
                best[item] = match
        out += [Match(number, item, *match) for item, match in sorted(best.items())]
    return out


@lru_cache(maxsize=1)
def _index(shared) -> Index:
    return Index(shared.value)


def item_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of a bounded number of characters, about."""
    usable = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).filter(F.length("text") >= Q)
    chars = usable.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = math.ceil(chars / BLOCK_CHARS)
    for block in range(blocks):
        rows = usable.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        if rows:
            yield sorted(((r.item, r.text) for r in rows), key=lambda r: (str(r[0]), r[1]))


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """key, item, edits, start, end: every item that occurs in a text, where it does best."""
    spark = docs.sparkSession
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    item_type = benchmark.schema[item].dataType
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("item", item_type)])
    for name in ("edits", "start", "end"):
        schema = schema.add(name, "long")
    found = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, item, text):
        found = found.unionAll(named.mapInArrow(_reporter(spark.sparkContext.broadcast(block), schema), schema))
    return found.withColumnsRenamed({"key": key, "item": item})


def _reporter(shared, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared)
        for batch in batches:
            texts = [one or "" for one in batch.column("text").to_pylist()]
            keys = batch.column("key").to_pylist()
            found = search(index, texts)
            columns = [[keys[m.text] for m in found], [index.ids[m.item] for m in found]]
            columns += [[m.edits for m in found], [m.start for m in found], [m.end for m in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return report


def clean(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """The rows in which no item occurs, unchanged."""
    spark = docs.sparkSession
    kept = docs
    for block in item_blocks(benchmark, item, text):
        kept = kept.mapInArrow(_keeper(spark.sparkContext.broadcast(block), text), docs.schema)
    return kept


def _keeper(shared, text: str):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared)
        for batch in batches:
            texts = [one or "" for one in batch.column(text).to_pylist()]
            stays = np.ones(len(texts), dtype=bool)
            stays[[m.text for m in search(index, texts)]] = False
            yield batch.filter(pa.array(stays))

    return keep
