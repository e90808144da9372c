"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, reranking.

A rotation of the principal directions is learned on a bounded sample so that the signs of the
rotated vectors are balanced binary codes that lose little. Codes are cut into substrings, one table
each; two vectors are candidates if in some table their substrings differ in at most `radius` bits. Length
and radius follow, for each length of vectors, from the largest group's size: the cheapest choice at which vectors right at the
threshold are expected to be found with probability RECALL. Pairs whose whole codes differ in more bits than all but a
millionth of such pairs are left out, and so are those whose sketches do: the sides of random planes through zero that
a vector is on, which differ at the rate of the angle whatever the vectors are. Candidates are reranked by the cosine of the original vectors.

How often a bit differs follows from the angle as seen from the point that codes are taken around. Around the
mean, bits are balanced, but where vectors share a direction the angles of near pairs are wider there: the widest
in the sample counts. Around zero the angle is that of the cosine itself, and bits are less balanced. The
cheaper of the two is taken for each length.

Vectors are compared within a label and a length. Equal vectors of a label are one class and stand for all
their rows; links are between classes, counted with the rows behind them.

Defined results: a vector that is NULL, empty, zero or holds NULL or non-finite components, or whose label is
NULL, links with nothing and is a component by itself; repeated rows are vectors of their own that share an id;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import joined, sent, written
from sensorloom.llm.components import components

#: Vectors that the rotation is learned on, by a hash of the vector: the bound of the sample.
SAMPLE_ROWS = 20_000
ROUNDS = 30
BITS = 64
#: Bits of a sketch, in words of 64.
SKETCH_WORDS = 3
RECALL = 0.97
#: What shuffling a row costs beside meeting one.
SHUFFLED = 3
SEED = 7
#: Bytes of the sample that are copied at a time.
BLOCK_BYTES = 32 << 20


def _blocks(sample: np.ndarray) -> Iterator[np.ndarray]:
    """Views of some rows at a time."""
    rows = max(1, BLOCK_BYTES // (8 * sample.shape[1]))
    return (sample[start : start + rows] for start in range(0, len(sample), rows))


def learn_rotation(sample: np.ndarray, bits: int = BITS, centre: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of iterative quantisation on unit vectors; without `centre` the mean is taken as zero."""
    mean = sample.mean(axis=0) if centre else np.zeros(sample.shape[1])
    bits = min(bits, sample.shape[1])
    _, directions = np.linalg.eigh(sum((some - mean).T @ (some - mean) for some in _blocks(sample)))
    principal = directions[:, ::-1][:, :bits]
    projected = np.concatenate([(some - mean) @ principal for some in _blocks(sample)])
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(bits, bits)))[0]
    for _ in range(ROUNDS):
        codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(codes.T @ projected)
        rotation = (left @ right).T
    return mean, principal @ rotation


def flip_rate(sample: np.ndarray, mean: np.ndarray, projection: np.ndarray, threshold: float) -> float:
    """How often a bit differs between unit vectors at the threshold.

    From the widest angle around the mean that such a pair can have, which is where both are as near to it as any
    vector of the sample; no less than measured on the sample with a partner at the threshold for each vector.
    """
    random, nearest, differing = np.random.default_rng(SEED), math.inf, 0
    for some in _blocks(sample):
        centred = some - mean
        nearest = min(nearest, (centred * centred).sum(axis=1).min())
        aside = random.normal(size=some.shape)
        aside -= (aside * some).sum(axis=1, keepdims=True) * some
        aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
        partners = threshold * some + math.sqrt(max(0.0, 1 - threshold**2)) * aside - mean
        differing += int(((centred @ projection >= 0) != (partners @ projection >= 0)).sum())
    cosine = 1 - (1 - threshold) / nearest if nearest > 0 else -1.0
    measured = differing / (len(sample) * projection.shape[1])
    return max(math.acos(min(1.0, max(-1.0, cosine))) / math.pi, measured)


def tables_for(rows: int, bits: int, flip: float, alike: float = 0.5) -> tuple[float, int, int, int]:
    """(cost, tables, bits of a substring, radius) for a largest group of that many vectors.

    Of the choices that find a pair at the threshold, whose bits differ at the rate `flip`, with probability RECALL,
    the one with the fewest rows to expect per vector: its entries and probes, which are shuffled, and what the
    probes meet where any two vectors have a bit alike at the rate `alike`.
    """
    best = None
    for width in range(1, min(24, bits) + 1):
        tables = bits // width
        near, probes = 0.0, 0
        for radius in range(width + 1):
            near += math.comb(width, radius) * flip**radius * (1 - flip) ** (width - radius)
            probes += math.comb(width, radius)
            if 1 - (1 - near) ** tables >= RECALL:
                cost = tables * (SHUFFLED * (1 + probes) + probes * rows * alike**width)
                best = min(best or (math.inf,), (cost, tables, width, radius))
                break
    return best


def plan(sample: np.ndarray, largest: int, threshold: float) -> tuple[tuple[np.ndarray, np.ndarray], float, tuple[int, int, int]]:
    """((mean, projection), flip rate, (tables, bits of a substring, radius)) for unit vectors of one length.

    Codes are taken around the mean or around zero, whichever has the lower cost.
    """
    found = []
    for centre in (True, False):
        mean, projection = learn_rotation(sample, centre=centre)
        flip = flip_rate(sample, mean, projection, threshold)
        positive = sum(((some - mean) @ projection >= 0).sum(axis=0) for some in _blocks(sample)) / len(sample)
        alike = float((positive**2 + (1 - positive) ** 2).mean())
        cost, *tables = tables_for(largest, projection.shape[1], flip, alike)
        found.append((cost, (mean, projection), flip, tuple(tables)))
    return min(found, key=lambda one: one[0])[1:]


def furthest(bits: int, flip: float) -> int:
    """The Hamming distance that a pair at the threshold, whose bits differ at that rate, exceeds with probability 10^-6."""
    found, distance = 0.0, -1
    while found < 1 - 1e-6 and distance < bits:
        distance += 1
        found += math.comb(bits, distance) * flip**distance * (1 - flip) ** (bits - distance)
    return distance


def _masks(width: int, radius: int) -> list[int]:
    """Every way to flip at most `radius` bits."""
    masks = [0]
    for _ in range(radius):
        masks = sorted({m | 1 << bit for m in masks for bit in range(width)} | set(masks))
    return masks


def classes(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """label, vector (double), id (the least key), rows: the different usable vectors of each label."""
    double = F.col(vector).cast("array<double>")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), double.alias("vector")).filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull() & sound & F.exists("vector", lambda x: x != 0.0)
    )
    return usable.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("rows"))


def _coded(rows: DataFrame, models: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """number, label, size, code and the words of the sketch of each class."""
    words = ["code", *(f"sketch{i}" for i in range(SKETCH_WORDS))]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {length: np.random.default_rng(SEED).normal(size=(length, 64 * SKETCH_WORDS)) for length in models}
        for batch in batches:
            codes = np.zeros((batch.num_rows, 64 * len(words)), dtype=bool)
            for at, value in enumerate(batch.column("vector")):
                one = value.values.to_numpy()
                mean, projection = models[len(one)]
                unit = one / np.linalg.norm(one / np.abs(one).max()) / np.abs(one).max()
                codes[at, : projection.shape[1]] = (unit - mean) @ projection >= 0
                codes[at, 64:] = unit @ planes[len(one)] >= 0
            packed = np.packbits(codes, axis=1, bitorder="little").view("<i8")
            sizes = pa.compute.list_value_length(batch.column("vector"))
            columns = [batch.column("number"), batch.column("label"), sizes, *(pa.array(packed[:, i]) for i in range(len(words)))]
            yield pa.RecordBatch.from_arrays(columns, ["number", "label", "size", *words])

    schema = T.StructType([rows.schema["number"], rows.schema["label"]]).add("size", "integer")
    for word in words:
        schema = schema.add(word, "long")
    return rows.select("number", "label", "vector").mapInArrow(code, schema)


def _near(a: Column, b: Column, table: int, width: int, radius: int) -> Column:
    differing = F.shiftrightunsigned(a.bitwiseXOR(b), table * width).bitwiseAND(F.lit((1 << width) - 1))
    return F.bit_count(differing) <= radius


def candidates(coded: DataFrame, bits: int, flip: float, tables: int, width: int, radius: int, apart: float) -> DataFrame:
    """a, b: pairs of classes of one length that some table brings together, each pair once.

    apart: how often bits of the sketches differ at the threshold.
    """
    sketches = [f"sketch{i}" for i in range(SKETCH_WORDS)]
    sub = F.expr(f"shiftrightunsigned(code, slot * {width}) & {(1 << width) - 1}L")
    tabled = coded.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))).withColumn("sub", sub)
    flips = F.explode(F.array(*[F.lit(m).cast("bigint") for m in _masks(width, radius)]))
    probes = tabled.withColumn("flip", flips).select(
        "label", "size", "slot", F.col("sub").bitwiseXOR(F.col("flip")).alias("sub"), F.col("number").alias("a"), F.col("code").alias("code_a"), *(F.col(c).alias(f"{c}_a") for c in sketches)
    )
    index = tabled.withColumnsRenamed({"number": "b", "code": "code_b"})
    # Entries and probes are many times the codes that they are made of, which is all that the planner would see.
    met = probes.join(index.hint("merge"), ["label", "size", "slot", "sub"]).filter("a < b")
    met = met.filter(F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= furthest(bits, flip))
    differing = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_a"))) for c in sketches), F.lit(0))
    met = met.filter(differing <= furthest(64 * SKETCH_WORDS, apart))
    # A pair that several tables find counts in the first of them.
    earlier = F.lit(False)
    for table in range(tables - 1):
        earlier = earlier | ((F.col("slot") > table) & _near(F.col("code_a"), F.col("code_b"), table, width, radius))
    return met.filter(~earlier).select("a", "b")


def _collected(vectors: DataFrame, length: int) -> np.ndarray:
    """Vectors of that length as the rows of one array that may be written to; they come as packed numbers."""
    column = vectors.toArrow().column(0)
    rows = np.empty((len(column), length))
    start = 0
    for chunk in column.chunks:
        rows[start : start + len(chunk)] = chunk.flatten().to_numpy().reshape(-1, length)
        start += len(chunk)
    return rows


def near_duplicates(vectors: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """key, n_links, component_id, kept for every row."""
    found = written(classes(vectors, key, vector, label), "vector-classes")
    found = written(found.withColumn("number", F.monotonically_increasing_id()), "vector-numbers")
    groups = found.groupBy("label", F.size("vector").alias("size")).count()
    sizes = groups.groupBy("size").agg(F.max("count").alias("largest"), F.sum("count").alias("all")).collect()
    n, wide = sum(r["all"] for r in sizes), max((8 * r["size"] for r in sizes), default=0) + 64
    plans = {}
    for length, group, several in sizes:
        same = found.filter(F.size("vector") == length).select("vector")
        share = SAMPLE_ROWS / max(several, SAMPLE_ROWS)
        rows = _collected(same.filter(F.pmod(F.xxhash64("vector"), F.lit(1_000_003)) <= share * 1_000_003), length)
        if not len(rows):  # a handful of vectors, none of them chosen
            rows = _collected(same.limit(SAMPLE_ROWS), length)
        for some in _blocks(rows):
            some /= np.abs(some).max(axis=1, keepdims=True)
            some /= np.linalg.norm(some, axis=1, keepdims=True)
        plans[length] = plan(rows, group, threshold)
    coded = written(_coded(found, {length: model for length, (model, _, _) in plans.items()}), "codes")
    # Codes have as many bits as their length gives, so each length has its own tables and bound.
    pairs = coded.select(F.col("number").alias("a"), F.col("number").alias("b")).limit(0)
    for length, (_, flip, tables) in plans.items():
        pairs = pairs.unionAll(candidates(coded.filter(F.col("size") == length), min(BITS, length), flip, *tables, math.acos(min(1.0, threshold)) / math.pi))
    # Pairs of a group compress to a byte or two each, so that joins go by how many they are.
    pairs = written(pairs, "candidates")
    links = written(reranked(pairs, found, threshold, (pairs.count(), n), wide), "links")
    many = links.count()
    ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rows_of = found.select(F.col("number").alias("b"), "rows")
    degrees = joined(ends, rows_of, "b", (2 * many, n)).groupBy(F.col("a").alias("number")).agg(F.sum("rows").alias("others"))
    numbers = found.select("number", "id")
    ids = joined(links, numbers.withColumnsRenamed({"number": "a", "id": "id_a"}), "a", (many, n))
    ids = joined(ids, numbers.withColumnsRenamed({"number": "b", "id": "id_b"}), "b", (many, n))
    # Components by id: classes of one id, which repeated ids make, are one node.
    linked = components(ids.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))).withColumnRenamed("node", "id")
    linking = min(n, 2 * many)
    told = numbers.join(sent(degrees, linking), "number", "left").join(sent(linked, linking), "id", "left").drop("id")
    whole = joined(found, told, "number", (n, n), (wide, 64))
    answers = whole.select(
        F.col("label").alias("_label"),
        F.col("vector").alias("_vector"),
        (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    answers = written(answers, "answers")
    rows = vectors.select(F.col(key), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    met = rows.join(sent(answers, n, wide), (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
    component = F.coalesce("component_id", F.col(key))
    return met.select(
        key,
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col(key)).alias("kept"),
    )


def reranked(pairs: DataFrame, found: DataFrame, threshold: float, rows: tuple[int, int], wide: int) -> DataFrame:
    """The pairs whose cosine in double precision reaches the threshold; rows: pairs and classes, of `wide` bytes at most."""
    vectors = found.select("number", "vector")
    both = joined(pairs, vectors.withColumnsRenamed({"number": "a", "vector": "x"}), "a", rows, (64, wide))
    both = joined(both, vectors.withColumnsRenamed({"number": "b", "vector": "y"}), "b", rows, (wide + 64, wide))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = np.zeros(batch.num_rows, dtype=bool)
            sizes = pa.compute.list_value_length(batch.column("x")).to_numpy()
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                x, y = (batch.column(c).take(pa.array(some)).flatten().to_numpy().reshape(len(some), -1) for c in ("x", "y"))
                # Scaled by the largest component first, so that no square overflows.
                x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
                norm = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
                stays[some] = (x * y).sum(axis=1) / norm >= threshold
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(stays))

    return both.select("a", "b", "x", "y").mapInArrow(keep, "a bigint, b bigint")
