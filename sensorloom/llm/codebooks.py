"""Vector code compression: product quantisation by a Lloyd iteration whose members stay with their owners.

Each component becomes the integer floor(scale * x); a vector is cut into consecutive parts. A part position has a
codebook of entries. Parts are placed once, by (position, entry, salt): the members of an entry and salt are one
owner's. In a round every owner finds the nearest new entry of its members; it keeps the sums of those that stay,
and only those that change entry go through the shuffle, to their new owners. What stays is neither shuffled nor
written again: a layer holds the parts that moved in one round, and a part is still its owner's if no codebook
since then has drawn it away, which the owner tells from the codebooks themselves.

Salts spread an entry with most of the parts over many owners: their number follows the shuffle partitions, and
salts are dealt in turn, so equal vectors part as well. Sums are of integers and therefore the same in any order.
The driver sees codebooks and sums of entries only, `positions * entries` of them. Layers are tables in the shared
folder; a lost executor costs its tasks.

Defined results: rows whose vector is NULL, empty or holds NULL or non-finite components are dropped, and so are those
whose length is not that of most vectors (of several the greatest) or no multiple of the number of parts. The
codebooks start from the smallest ids; a NULL id starts none, of rows that repeat an id the least vector does, fewer
ids make smaller codebooks, no id makes an empty result. Repeated rows count as often as they occur. Integers beyond
2^40 count as 2^40; an error beyond a bigint is the greatest bigint. Other columns are kept, those called code or error
are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import partitions, written

GREATEST = 1 << 40
# Squares of smaller differences add up within 64 bits for parts of up to 2^8 components.
SMALL = 1 << 27
# Differences held at once by a task.
AT_ONCE = 1 << 21
LONGEST = (1 << 63) - 1
# A member has its part, as the bytes of 64-bit integers; a row of `n` members has their sums, comma-joined.
LAYER = "position int, entry int, salt int, n bigint, part binary, total string"
LAYER_ARROW = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("n", pa.int64()), ("part", pa.binary()), ("total", pa.string())])

# [position, entry, component]; every position has as many entries.
Codebooks = np.ndarray


class Compressed(NamedTuple):
    """Rows with `code` (entries in part order) and `error` (squared distances), and the codebooks."""

    codes: DataFrame
    codebooks: Codebooks


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """[row, component] of floor(scale * x)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(scale * flat), -GREATEST, GREATEST).astype(np.int64).reshape(-1, width)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of a codebook nearest to each part, and its squared distance; ties go to the lower entry."""
    entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    if not parts.size:
        return entry, distance
    exact = max(np.abs(parts).max(), np.abs(book).max()) >= SMALL or parts.shape[1] > 1 << 8
    step = max(1, AT_ONCE // book.size)
    for at in range(0, len(parts), step):
        rows = slice(at, at + step)
        difference = parts[rows, None, :] - book
        if exact:
            difference = difference.astype(object)
        squares = (difference * difference).sum(2)
        entry[rows] = squares.argmin(1)
        distance[rows] = np.minimum(squares.min(1), LONGEST)
    return entry, distance


def by_position(parts: np.ndarray, position: np.ndarray, books: Codebooks) -> np.ndarray:
    """The nearest entries of parts of several positions."""
    entry = np.zeros(len(parts), np.int64)
    for p in np.unique(position):
        chosen = position == p
        entry[chosen] = nearest(parts[chosen], books[p])[0]
    return entry


def layer_batch(columns: dict[str, np.ndarray], parts: np.ndarray | None = None, totals: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of a layer: members with their part, or sums of `n` members."""
    rows = len(columns["position"])
    found = {name: pa.array(values, LAYER_ARROW.field(name).type) for name, values in columns.items()}
    if parts is not None:
        offsets = np.arange(rows + 1, dtype=np.int32) * parts.shape[1] * parts.itemsize
        found["part"] = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(parts))])
    else:
        found["total"] = pa.array([",".join(map(str, row)) for row in totals.tolist()], pa.string())
    return pa.record_batch([found.get(f.name, pa.nulls(rows, f.type)) for f in LAYER_ARROW], schema=LAYER_ARROW)


class Sums:
    """Sums and numbers of members by position and entry, exact."""

    def __init__(self, books: Codebooks):
        self.shape = books.shape
        self.total = np.zeros((books.shape[0] * books.shape[1], books.shape[2]), object)
        self.count = np.zeros(len(self.total), np.int64)

    def add(self, position: np.ndarray, entry: np.ndarray, parts: np.ndarray) -> None:
        key = position * self.shape[1] + entry
        # A batch has far fewer than 2^22 rows, components stay within 2^40.
        batch = np.zeros(self.total.shape, np.int64)
        np.add.at(batch, key, parts)
        self.total += batch.astype(object)
        self.count += np.bincount(key, minlength=len(self.count))

    def batch(self) -> pa.RecordBatch:
        """A row per entry that has members."""
        (key,) = np.nonzero(self.count)
        position, entry = np.divmod(key, self.shape[1])
        return layer_batch({"position": position, "entry": entry, "n": self.count[key]}, totals=self.total[key])


def place(width: int, scale: int, books: Codebooks, salts: int) -> Callable:
    """Every part with its nearest entry and a salt, dealt in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            vectors = integers(batch.column("vector"), width, scale).reshape(len(batch), len(books), -1)
            turn = (before + np.arange(len(batch))) % salts
            before += len(batch)
            for p, book in enumerate(books):
                parts = np.ascontiguousarray(vectors[:, p])
                yield layer_batch({"position": np.full(len(parts), p), "entry": nearest(parts, book)[0], "salt": turn}, parts)

    return run


def members(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """position, entry, salt and part of the members in a batch."""
    columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("position", "entry", "salt")]
    part = batch.column("part")
    start = part.offset
    offsets = np.frombuffer(part.buffers()[1], np.int32, len(part) + start + 1)[start:]
    bytes_ = memoryview(part.buffers()[2])[offsets[0] : offsets[-1]] if len(part) else b""
    return *columns, np.frombuffer(bytes_, np.int64).reshape(len(part), size)


def settle(since: list[Codebooks], now: Codebooks) -> Callable:
    """A round over one layer: members that change entry, with the new one, and the sums of those that stay.

    `since` are the codebooks that the layer has met: a part that one of them drew away lives in a later layer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        staying = Sums(now)
        for batch in batches:
            position, entry, salt, parts = members(batch, now.shape[2])
            for books in since:
                here = by_position(parts, position, books) == entry
                position, entry, salt, parts = position[here], entry[here], salt[here], parts[here]
            new = by_position(parts, position, now)
            stays = new == entry
            staying.add(position[stays], entry[stays], parts[stays])
            moves = ~stays
            if moves.any():
                yield layer_batch({"position": position[moves], "entry": new[moves], "salt": salt[moves]}, parts[moves])
        yield staying.batch()

    return run


def owners_sums(books: Codebooks) -> Callable:
    """The sums of the members that a task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Sums(books)
        for batch in batches:
            position, entry, _, parts = members(batch, books.shape[2])
            held.add(position, entry, parts)
        yield held.batch()

    return run


def updated(layer: DataFrame, books: Codebooks) -> Codebooks:
    """The floor of the mean of each entry's members, from those that came and the sums of those that stayed."""
    came = layer.filter("n IS NULL").mapInArrow(owners_sums(books), LAYER)
    sums = layer.filter("n IS NOT NULL").unionByName(came).select("position", "entry", "n", F.posexplode(F.split("total", ",")).alias("at", "x"))
    means = sums.groupBy("position", "entry", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
    new = books.copy()
    for row in means.collect():
        new[row.position, row.entry, row.at] = int(row.x) // row.n
    return new


def first_codebooks(kept: DataFrame, width: int, scale: int, count: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids."""
    ids = kept.select("id").filter("id IS NOT NULL").distinct().orderBy("id").limit(entries)
    least = kept.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("vector").alias("vector")).orderBy("id")
    vectors = pa.array([row.vector for row in least.collect()], pa.list_(pa.float64()))
    return integers(vectors, width, scale).reshape(len(vectors), count, width // count).transpose(1, 0, 2).copy()


def trained(kept: DataFrame, width: int, scale: int, count: int, entries: int, rounds: int) -> Codebooks:
    """The codebooks after all rounds, or after the one that no longer changes them."""
    books = first_codebooks(kept, width, scale, count, entries)
    if not books.size:
        return books
    salts = -(-partitions(kept) // entries)
    owner = ["position", "entry", "salt"]
    # Each layer with the round that placed it: later codebooks may have drawn parts away.
    layers: list[tuple[int, DataFrame]] = []
    history = [books]
    for round_ in range(rounds):
        if round_ == 0:
            moved = kept.select("vector").mapInArrow(place(width, scale, books, salts), LAYER)
        else:
            passes = [layer.filter("n IS NULL").mapInArrow(settle(history[at + 1 : -1], books), LAYER) for at, layer in layers]
            moved = reduce(DataFrame.unionByName, passes)
        layer = written(moved.repartition(*owner), f"owners-{round_}")
        layers.append((round_, layer))
        new = updated(layer, books)
        if np.array_equal(new, books):
            break
        books = new
        history.append(books)
    return books


def coded(width: int, scale: int, books: Codebooks) -> Callable:
    """Rows with the codes and the error of their vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = integers(batch.column("vector"), width, scale).reshape(len(batch), len(books), -1)
            found = [nearest(np.ascontiguousarray(vectors[:, p]), book) for p, book in enumerate(books)]
            digits = np.stack([entry for entry, _ in found], 1)
            code = ["".join(f"{e:02x}" for e in row) for row in digits.tolist()]
            error = [min(LONGEST, sum(d)) for d in zip(*(distance.tolist() for _, distance in found), strict=True)]
            yield pa.record_batch([batch.column("row"), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["row", "code", "error"])

    return run


def compress(
    rows: DataFrame, vector: str = "embedding", key: str = "vec_id", count: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> Compressed:
    """Learn the codebooks and give every sound row its code and error. Writes a layer per round."""
    own = [c for c in rows.columns if c not in ("code", "error")]
    kept = rows.select(F.struct(*own).alias("row"), F.col(key).alias("id"), F.col(vector).alias("vector")).filter(sound(F.col("vector")))
    kept = kept.filter((F.size("vector") > 0) & (F.size("vector") % count == 0))
    widths = kept.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    schema = T.StructType([T.StructField("row", kept.schema["row"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    width = widths[0].width if widths else count
    kept = kept.filter(F.size("vector") == width)
    books = trained(kept.select("id", "vector"), width, scale, count, entries, rounds)
    if not books.size:
        kept = kept.filter(F.lit(False))
    codes = kept.select("row", "vector").mapInArrow(coded(width, scale, books), schema)
    return Compressed(codes.select("row.*", "code", "error"), books)
