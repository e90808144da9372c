"""Exact n-gram Jaccard join and its components.

1. Texts with the same set of shingles are one class; a class stands for all its texts.
2. Sets are ordered with frequent shingles last; two sets that reach the threshold share one of their first
   n - ceil(t n) + 1 shingles. Lists of classes per such shingle are the index. The position of the shingle
   in a set bounds its overlap with any other; classes that no other of the list can reach are skipped.
   In every list the smallest class is the pivot; all lists of a pivot together are its star. Any two
   classes left in a list meet in the star of its pivot, so every candidate pair does, and stars have no
   more rows than lists. Lists of frequent shingles, which may be long, are never gathered: they are
   summed up and joined, with a bound that the sums give.
3. Classes that a smaller star has as well are compared there, so of a star only pairs with a class of its
   own are left. Large stars are cut into blocks by position, the set's size; blocks whose sizes are
   too far apart for the threshold are skipped, the others meet in pairs, each a group of bounded size.
4. Sets carry a sketch: every shingle flips one of about as many bits as the set has shingles. Two sketches differ in
   no more bits than their sets do in shingles, so a pair whose sketches differ in more than a link allows has
   none. Groups are first formed with sketches, and only rows with a possible partner come with their text.
5. In a group the answers of one set against all others are computed; those between the others follow
   from them and from the few shingles in which each differs:
   |y n z| = |r| - |r-y| - |r-z| + |(r-y) n (r-z)| + |(y-r) n (z-r)|.
6. Links that span each group, and links of copies to their class, give the components.

Shingles are 64-bit hashes of their words. Defined results: NULL and empty texts, or texts without a word, have an
empty set and link with nothing; rows that repeat an id are one node with several texts; rows without
id link with nothing and have no component; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import whole_text, written
from sensorloom.llm.components import components
from sensorloom.llm.membership import absent, passing

#: Bytes of text hashed at once.
AT_ONCE = 1_000_000
#: Shingles counted together, in how many texts of these a frequent one is, and how many frequent
#: ones are told to the tasks: they only decide on the order of shingles, never on a result.
COUNT_AT_ONCE = 2_000_000
FREQUENT = 4
MOST_FREQUENT = 1 << 16
#: Entries of a list that are compared with each other; longer lists are left whole.
LIST_AT_ONCE = 4096
#: Rows of a block of a large star.
BLOCK = 128
#: Columns of differing shingles multiplied at once.
COLUMNS = 4096

_random = np.random.default_rng(20240307)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS["up"]) < size:
        inverse = pow(_ODD, -1, 1 << 64)
        for name, base in (("up", _ODD), ("down", inverse)):
            factors = np.full(max(size, AT_ONCE + 1), base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a piece of text."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    space = np.concatenate([[True], _SPACE[data], [True]])
    change = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = change[::2], change[1::2]
    up, down = _powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)])
    sums = (total[ends] - total[starts]) * down[starts]
    return starts, _mixed(sums + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of every text."""
    sets: list[np.ndarray] = []
    parts: list[bytes] = []
    size = 0

    def flush() -> None:
        begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        starts, hashes = _word_hashes(b"\n".join(parts))
        cuts = np.searchsorted(starts, begins)
        factors = [np.uint64(pow(_ODD, 2 * place + 3, 1 << 64)) for place in range(words)]
        together = np.zeros(max(0, len(hashes) - words + 1), dtype=np.uint64)
        for place in range(words):
            together += hashes[place : place + len(together)] * factors[place]
        together = _mixed(together)
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high - low >= words:
                sets.append(np.unique(together[low : high - words + 1]))
            elif high > low:
                short = sum(int(h) * int(f) for h, f in zip(hashes[low:high], factors)) + int(high - low)
                sets.append(_mixed(np.array([short % (1 << 64)], dtype=np.uint64)))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))

    for text in texts:
        parts.append(text.encode())
        size += len(parts[-1]) + 1
        if size >= AT_ONCE:
            flush()
            parts, size = [], 0
    if parts:
        flush()
    return sets


def fingerprint(members: np.ndarray) -> bytes | None:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None


def sketch(members: np.ndarray) -> bytes:
    """The parity of the shingles on each bit; bits are a power of two, 64 or the first from the set's size on."""
    bits = max(64, 1 << (len(members) - 1).bit_length()) if len(members) else 64
    parity = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def may_link(sizes: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """Which sets of a group have another that they may link with, by sizes and sketches.

    The parts of a wider sketch, added up, are the sketch of a smaller width. Sets that may link are within a factor of
    100 / percent in size, and their sketches within twice that, rounded up to a power of two.
    """
    widest = 2 << (-(-100 // percent) - 1).bit_length()
    alive = np.zeros(len(sizes), dtype=bool)
    width = np.array([len(s) for s in sketches])
    for bytes_ in np.unique(width):
        own = np.flatnonzero(width == bytes_)
        ids, parts, times = [], [], 1
        while times <= widest:
            some = np.flatnonzero(width == times * bytes_)
            folded = np.frombuffer(b"".join(sketches[n] for n in some), np.uint64).reshape(len(some), times, bytes_ // 8)
            ids.append(some)
            parts.append(np.bitwise_xor.reduce(folded, axis=1))
            times *= 2
        ids, rows = np.concatenate(ids), np.concatenate(parts)
        for at in range(len(own)):
            others = ids[at + 1 :]
            differ = np.bitwise_count(rows[at + 1 :] ^ rows[at]).sum(axis=1, dtype=np.int64)
            both = sizes[others] + sizes[own[at]]
            may = (differ * (100 + percent) <= both * (100 - percent)) & (100 * np.minimum(sizes[others], sizes[own[at]]) >= percent * np.maximum(sizes[others], sizes[own[at]]))
            if may.any():
                alive[own[at]] = True
                alive[others[may]] = True
    return alive


def frequent_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts share, sorted, and their place among them by count: a table of fixed size."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[np.ndarray] = []
        size = 0

        def often() -> pd.DataFrame:
            found, times = np.unique(np.concatenate(waiting), return_counts=True)
            some = times >= FREQUENT
            return pd.DataFrame({"shingle": found[some].view(np.int64), "times": times[some]})

        for frame in frames:
            for members in shingle_sets(frame["text"].tolist(), words):
                waiting.append(members)
                size += len(members)
                if size >= COUNT_AT_ONCE:
                    yield often()
                    waiting, size = [], 0
        if waiting:
            yield often()

    counts = texts.select("text").mapInPandas(count, "shingle bigint, times bigint")
    top = counts.groupBy("shingle").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "shingle").limit(MOST_FREQUENT)
    rows = top.collect()
    shingles = np.array([r.shingle for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], (len(rows) - np.arange(len(rows)))[order]


def _needed(n: Column | int, percent: int):
    """The least overlap of a set of n with a set that reaches the threshold."""
    return (n * percent + 99) // 100


def shingled(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """id, n, print, first, plain, sketch: each text's set size, the set's fingerprint, its first shingles, how
    many of its shingles are not frequent: these come first, and the set's sketch."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts, words))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = shared.value
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            first, plain = [], []
            for members in sets:
                n = len(members)
                upto = n - _needed(n, percent) + 1 if n else 0
                if len(known) and n:
                    at = np.minimum(np.searchsorted(known, members), len(known) - 1)
                    rank = np.where(known[at] == members, place[at], 0)
                    members = members[np.argsort(rank, kind="stable")]
                    plain.append(int((rank == 0).sum()))
                else:
                    plain.append(n)
                first.append(members[:upto].view(np.int64))
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) for s in sets], pa.binary())]
            columns += [pa.array(first, pa.list_(pa.int64())), pa.array(plain, pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n", "print", "first", "plain", "sketch"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(cut, f"id {kind}, n bigint, print binary, first array<bigint>, plain bigint, sketch binary")


def reachable(n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Which entries of a list have another that they may link with, this being their first common shingle."""
    if len(n) > LIST_AT_ONCE:
        return np.ones(len(n), dtype=bool)
    both = np.minimum.outer(n - place, n - place)
    may = both * (100 + percent) >= percent * np.add.outer(n, n)
    np.fill_diagonal(may, False)
    return may.any(axis=1)


def stars_of_lists(entries: DataFrame, percent: int) -> DataFrame:
    """star, id of the lists of plain shingles, each list read as one stretch of a sorted partition."""
    kind = entries.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if left is None else [left, batch]).combine_chunks()
            shingle = table.column("shingle").to_numpy()
            last = int(np.searchsorted(shingle, shingle[-1], side="left")) if len(shingle) else 0
            yield from answer(table.slice(0, last))
            # The last list may go on in the next batch.
            rest = table.slice(last).combine_chunks().to_batches()
            left = rest[0] if rest else None
        if left is not None:
            yield from answer(pa.Table.from_batches([left]))

    def answer(table: pa.Table) -> Iterator[pa.RecordBatch]:
        stars, ids = [], []
        if len(table):
            shingle, n, place = (table.column(c).to_numpy() for c in ("shingle", "n", "place"))
            bounds = np.append(np.flatnonzero(np.diff(shingle, prepend=~shingle[0])), len(shingle))
            long = np.flatnonzero(np.diff(bounds) > 1)
            for low, high in zip(bounds[long].tolist(), bounds[long + 1].tolist()):
                some = np.flatnonzero(reachable(n[low:high], place[low:high], percent))
                if len(some):
                    found = table.column("id").slice(low, high - low).take(pa.array(some)).to_pylist()
                    stars += [min(found)] * len(found)
                    ids += found
        yield pa.RecordBatch.from_arrays([pa.array(stars, table.schema.field("id").type), pa.array(ids, table.schema.field("id").type)], ["star", "id"])

    dealt = entries.select("shingle", "id", "n", "place").repartition("shingle").sortWithinPartitions("shingle")
    return dealt.mapInArrow(work, f"star {kind}, id {kind}")


def stars_of_frequent(entries: DataFrame, percent: int) -> DataFrame:
    """star, id of the lists of frequent shingles: no list comes together in one place."""
    # The sizes that a partner may have go up to this; up to its own size means any smaller one counts.
    upto = (F.col("n") - F.col("place")) * ((100 + percent) / percent) - F.col("n") + 1e-6
    sized = entries.withColumn("upto", upto).withColumn("small", F.col("upto") >= F.col("n"))
    lists = sized.groupBy("shingle").agg(
        F.min("id").alias("star"),
        F.count_if("small").alias("smalls"),
        F.min(F.when(F.col("small"), F.col("n"))).alias("least"),
        F.max(F.when(F.col("small"), F.col("upto"))).alias("reach"),
        F.max(F.when(~F.col("small"), F.col("upto"))).alias("other_reach"),
    )
    lists = written(lists.filter("smalls > 0"), "frequent-lists")
    met = sized.join(lists, "shingle")
    as_small = F.col("small") & ((F.col("smalls") > 1) | F.coalesce(F.col("other_reach") >= F.col("n"), F.lit(False)))
    as_large = ~F.col("small") & (F.col("least") <= F.col("upto")) & (F.col("reach") >= F.col("n"))
    return met.filter(as_small | as_large).select("star", "id")


def star_groups(classes: DataFrame, percent: int) -> DataFrame:
    """id, print and a group: the classes of each star, large stars in pairs of blocks that sizes allow."""
    entries = classes.select("id", "n", "plain", F.posexplode("first").alias("place", "shingle"))
    entries = entries.withColumn("place", F.col("place").cast("bigint"))
    plain = stars_of_lists(entries.filter("place < plain"), percent)
    met = plain.unionAll(stars_of_frequent(entries.filter("place >= plain"), percent)).distinct()
    met = written(met, "star-pairs")
    # A star whose pivot is in a smaller star: what both have, the smaller one compares.
    smaller = met.filter("id <> star").groupBy(F.col("id").alias("star")).agg(F.min("star").alias("smaller"))
    there = met.select(F.col("star").alias("smaller"), "id", F.lit(1).alias("side"))
    sided = met.join(written(smaller, "smaller-stars"), "star", "left").join(there, ["smaller", "id"], "left")
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int").alias("at")
    members = sided.select("star", "id", F.coalesce("side", F.lit(0)).alias("side"))
    members = written(members.join(classes.select("id", "print", "n", size_class), "id"), "star-members")
    counted = members.groupBy("star", "at", "side").count()
    place = F.col("at") * 2 + F.col("side")
    stars = counted.groupBy("star").agg(
        F.sum("count").alias("rows"),
        F.sum(F.when(F.col("side") == 0, F.col("count"))).alias("own"),
        F.map_from_entries(F.collect_list(F.struct(place, F.ceil(F.col("count") / BLOCK).cast("int")))).alias("blocks"),
    )
    stars = written(stars.filter("rows > 1 AND own > 0"), "stars")
    sized = members.join(stars, "star")

    def many(at: Column, side: int) -> Column:
        return F.coalesce(F.element_at("blocks", at * 2 + side), F.lit(0))

    def pairs(low: Column, low_block, high: Column, high_block, count: Column) -> Column:
        """A group for each block of the other side; none if there is none."""
        every = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            every, lambda o: F.struct(low.alias("low"), low_block(o).alias("i"), high.alias("high"), high_block(o).alias("j"))
        )

    at, side = F.col("at"), F.col("side")
    count = F.when(side == 0, many(at, 0)).otherwise(many(at, 1))
    own = F.pmod(F.xxhash64("id"), F.greatest(count, F.lit(1))).cast("int")
    # Blocks of the star's own rows meet each other and those that a smaller star has too (below zero).
    fresh = [
        pairs(at, lambda o: F.least(own, o), at, lambda o: F.greatest(own, o), many(at, 0)),
        pairs(at, lambda o: own, at + 1, lambda o: o, many(at + 1, 0)),
        pairs(at - 1, lambda o: o, at, lambda o: own, many(at - 1, 0)),
        *[pairs(at, lambda o: own, at + step, lambda o: -o - 1, many(at + step, 1)) for step in (-1, 0, 1)],
    ]
    known = [pairs(at + step, lambda o: o, at, lambda o: -own - 1, many(at + step, 0)) for step in (-1, 0, 1)]
    whole = F.array(F.struct(F.lit(-1).alias("low"), F.lit(0).alias("i"), F.lit(-1).alias("high"), F.lit(0).alias("j")))
    groups = F.when(F.col("rows") <= BLOCK, whole).when(side == 0, F.concat(*fresh)).otherwise(F.concat(*known))
    return sized.select("id", "print", "star", F.explode(groups).alias("block")).select("id", "print", "star", "block.*")


def linked_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of a group link, from the answers of the first one and the differences to it."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    pivot = sets[0]
    owners, columns = [], []
    missing = np.zeros(len(sets), dtype=np.int64)
    for at, members in enumerate(sets):
        place = np.minimum(np.searchsorted(pivot, members), len(pivot) - 1)
        held = pivot[place] == members
        lacking = np.ones(len(pivot), dtype=bool)
        lacking[place[held]] = False
        missing[at] = lacking.sum()
        differing = np.concatenate([pivot[lacking], members[~held]])
        owners.append(np.full(len(differing), at))
        columns.append(differing)
    owner, column = np.concatenate(owners), np.concatenate(columns)
    overlap = (len(pivot) - missing[:, None] - missing[None, :]).astype(np.float64)
    if len(column):
        _, number, times = np.unique(column, return_inverse=True, return_counts=True)
        some = times[number] > 1  # what one set alone differs in is in no intersection
        owner, number = owner[some], np.unique(number[some], return_inverse=True)[1]
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
            a, b = np.searchsorted(number, [low, low + COLUMNS])
            grid = np.zeros((len(sets), COLUMNS), dtype=np.float32)
            grid[owner[a:b], number[a:b] - low] = 1.0
            overlap += grid @ grid.T
    np.fill_diagonal(overlap, sizes)
    union = sizes[:, None] + sizes[None, :] - overlap
    return 100 * overlap >= percent * union


def spanning_links(links: np.ndarray, ids: list) -> list[tuple]:
    """Links that join each component of a group to its least id."""
    out, seen = [], np.zeros(len(ids), dtype=bool)
    for begin in range(len(ids)):
        if seen[begin]:
            continue
        seen[begin] = True
        front, component = [begin], [begin]
        while front:
            new = np.flatnonzero(links[front].any(axis=0) & ~seen)
            seen[new] = True
            front = new.tolist()
            component += front
        least = min(ids[i] for i in component)
        out += [(ids[i], least) for i in component if ids[i] != least]
    return out


GROUP = ["star", "low", "i", "high", "j"]


def possible(groups: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The rows of each group that have a possible partner there, from sizes and sketches alone."""
    kind = groups.schema["id"].dataType.simpleString()
    schema = f"id {kind}, print binary, star {groups.schema['star'].dataType.simpleString()}, low int, i int, high int, j int"

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The last group of a batch may go on in the next one.
        left = None
        for frame in frames:
            frame = frame if left is None else pd.concat([left, frame], ignore_index=True)
            if not len(frame):
                continue
            change = (frame[GROUP] != frame[GROUP].shift()).any(axis=1).to_numpy()
            begins = np.append(np.flatnonzero(change), len(frame))
            left = frame.iloc[begins[-2] :]
            yield answer(frame, begins[:-1])
        if left is not None:
            yield answer(left, np.array([0, len(left)]))

    def answer(frame: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        alive = np.zeros(len(frame), dtype=bool)
        sizes, sketches = frame["n"].to_numpy(), frame["sketch"].tolist()
        for low, high in zip(bounds[:-1], bounds[1:]):
            if high - low > 1:
                alive[low:high] = may_link(sizes[low:high], sketches[low:high], percent)
        return frame.loc[alive, ["id", "print", *GROUP]]

    sized = groups.join(classes.select("id", "n", "sketch"), "id")
    dealt = sized.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInPandas(work, schema)


def group_links(members: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: spanning links of every group of rows id, print, text sorted by group."""
    keys = GROUP

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def answer(ids: list, sets: list) -> list[tuple]:
            return spanning_links(linked_pairs(sets, percent), ids) if len(ids) > 1 else []

        last, ids, sets = None, [], []
        for frame in frames:
            found: list[tuple] = []
            hashed = shingle_sets(frame["text"].tolist(), words)
            for row, members_ in zip(frame[[*keys, "id", "print"]].itertuples(index=False), hashed):
                if tuple(row[:5]) != last:
                    found += answer(ids, sets)
                    last, ids, sets = tuple(row[:5]), [], []
                # An id that repeats may come with the text of another class.
                if fingerprint(members_) == bytes(row.print):
                    ids.append(row.id)
                    sets.append(members_)
            yield pd.DataFrame(found, columns=["a", "b"])
        yield pd.DataFrame(answer(ids, sets), columns=["a", "b"])

    kind = members.schema["id"].dataType.simpleString()
    dealt = members.repartition(*keys).sortWithinPartitions(*keys, "id")
    return dealt.mapInPandas(link, f"a {kind}, b {kind}")


def set_classes(usable: DataFrame) -> DataFrame:
    """print, id, n, first, plain, sketch of every different set, with its least id.

    Only sets that a Bloom filter of the repeated ones passes are shuffled with their shingles.
    """
    repeated = written(usable.groupBy("print").count().filter("count > 1").select("print"), "repeated-sets")
    rest = ["n", "first", "plain", "sketch"]
    several = passing(usable, F.col("print"), repeated).groupBy("print")
    several = several.agg(F.min("id").alias("id"), *[F.first(name).alias(name) for name in rest])
    return absent(usable, F.col("print"), repeated).select(several.columns).unionAll(several)


def join(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id for every row: components of sets that reach `percent` % Jaccard similarity."""
    texts = docs.select(F.col(key).alias("id"), whole_text(text).alias("text"))
    sets = written(shingled(texts, words, percent), "shingled")
    usable = sets.filter("id IS NOT NULL AND print IS NOT NULL")
    classes = written(set_classes(usable), "set-classes")
    groups = written(possible(star_groups(classes, percent), classes, percent), "possible")
    wanted = passing(texts.filter("id IS NOT NULL"), F.col("id"), groups.select("id").distinct())
    members = groups.join(wanted, "id")
    links = group_links(members, words, percent).distinct()
    copies = usable.select("id", "print").join(classes.select("print", F.col("id").alias("least")), "print")
    edges = links.unionAll(copies.filter("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")))
    found = written(components(edges), "components")
    met = sets.join(found, F.col("id") == F.col("node"), "left")
    return met.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
