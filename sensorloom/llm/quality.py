"""A quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document is a row of statistics of its whole text. Random cosines of the standardised statistics
approximate a Gaussian kernel. Every partition adds up the normal equations of its labelled rows, the
sums (a fixed size) are solved once, and the ridge scores become probabilities by a monotone step
function fitted to all labelled rows, counted per narrow score bin.

Defined results: a NULL text is the empty text and gets a score like any other; NULL labels are not
learned from; a document labelled twice counts twice; without labelled rows, or with one label
only, the score is the share of label 1, and 0.5 where there is none. Only the named columns are read.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Random cosines, their seed, the ridge penalty and the kernel's width in standard deviations.
COSINES = 256
SEED = 20240229
RIDGE = 1.0
WIDTH = 4.0
#: Bins of ridge scores over [-1, 2] for the calibration.
BINS = 1500
#: Standardised statistics are clipped to this many standard deviations.
CLIP = 5.0

FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_words", "repeated_next", "upper_letters", "digits", "marks",
    "odd_marks", "bars", "bangs", "sentence_ends", "spaces", "line_length", "distinct_lines", "short_lines",
    "byte_entropy", "top_word", "upper_words", "marked_words", "long_words",
)

UPPER_WORD = re.compile(r"(?<!\S)[^a-zß-öø-ÿ\s]*[A-ZÀ-ÖØ-Þ]{2}[^a-zß-öø-ÿ\s]*(?!\S)")
MARKED_WORD = re.compile(r"[^\w\s]{2,}(?!\S)")


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of FEATURES."""
    raw = text.encode()
    n = max(1, len(raw))
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    nw = max(1, len(words))
    distinct: dict[str, int] = {}
    for word in words:
        distinct[word] = distinct.get(word, 0) + 1
    lines = text.split("\n")
    share = count[count > 0] / n
    lower, upper = int(count[97:123].sum()), int(count[65:91].sum())
    ends = int(count[46] + count[63])
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    usual = int(count[44] + count[46] + count[39] + count[45] + count[63])
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        len(text) / nw if words else 0.0,
        len(distinct) / nw / (1 + 0.1 * math.log1p(nw)),
        sum(map(operator.eq, words, words[1:])) / nw,
        upper / max(1, lower + upper),
        int(count[48:58].sum()) / n,
        marks / n,
        (marks - usual) / n,
        int(count[124]) / nw,
        int(count[33]) / nw,
        ends / nw,
        int(count[32] + count[10] + count[9]) / n,
        math.log1p(len(text) / len(lines)),
        len(set(lines)) / len(lines),
        sum(len(line) < 20 for line in lines) / len(lines),
        float(-(share * np.log2(share)).sum()) if len(raw) else 0.0,
        max(distinct.values(), default=0) / nw,
        len(UPPER_WORD.findall(text)) / nw,
        len(MARKED_WORD.findall(text)) / nw,
        sum(length > 20 for length in map(len, words)) / nw,
    ]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows without the text, with their statistics in `stats`."""
    rest = [name for name in docs.columns if name not in (text, "stats")]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(one.as_py() or "") for one in batch.column(text)]
            kept = [batch.column(name) for name in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.float64()))], [*rest, "stats"])

    schema = T.StructType([docs.schema[name] for name in rest]).add("stats", T.ArrayType(T.DoubleType()))
    return docs.select(*rest, text).mapInArrow(measure, schema)


def cosines(stats: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of standardised statistics, a constant last."""
    scaled = np.clip((stats - model["mean"]) / model["deviation"], -CLIP, CLIP)
    random = np.random.default_rng(SEED)
    frequency = random.normal(scale=1.0 / WIDTH, size=(stats.shape[1], COSINES))
    phase = random.uniform(0.0, 2.0 * math.pi, COSINES)
    found = math.sqrt(2.0 / COSINES) * np.cos(scaled @ frequency + phase)
    return np.hstack([found, np.ones((len(stats), 1))])


def pool_adjacent(sums: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing means closest to sums / weights, by pooling neighbours that violate the order."""
    blocks: list[list[float]] = []
    for total, weight in zip(sums, weights):
        blocks.append([float(total), float(weight), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, weight, size = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + weight, blocks[-1][2] + size]
    return np.concatenate([np.full(size, total / weight) for total, weight, size in blocks])


def _sums(rows: DataFrame, work, slots: int) -> np.ndarray:
    """Matrices of `slots` rows, one per partition, added up in two steps, so that no task meets them all."""

    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                part = work(np.stack(frame["stats"].to_numpy()), frame["label"].to_numpy(dtype=float))
                total = part if total is None else total + part
        if total is not None:
            some = TaskContext.get().partitionId() % 64
            yield pd.DataFrame({"slot": range(slots), "some": some, "sums": [row.tobytes() for row in total]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(one) for one in frame["sums"]], axis=0)
        return pd.DataFrame({"slot": [frame["slot"].iloc[0]], "some": [0], "sums": [total.tobytes()]})

    ddl = "slot int, some int, sums binary"
    parts = rows.mapInPandas(emit, ddl).groupBy("slot", "some").applyInPandas(add, ddl)
    found = parts.groupBy("slot").applyInPandas(add, ddl).collect()
    return np.stack([np.frombuffer(r.sums) for r in sorted(found, key=lambda r: r.slot)]) if found else np.zeros((0, 0))


def fit(rows: DataFrame) -> dict:
    """The model of rows with `stats` and a 0/1 `label`: means, deviations, weights, calibration."""
    size = len(FEATURES)

    def moments(stats, labels):
        return np.array([[len(labels), labels.sum(), *stats.sum(0), *(stats**2).sum(0)]])

    sums = _sums(rows, moments, 1)
    if not sums.size:
        return {"constant": 0.5}
    n, positive = sums[0, :2]
    if positive in (0, n):
        return {"constant": float(positive / n)}
    mean = sums[0, 2 : 2 + size] / n
    deviation = np.sqrt(np.maximum(sums[0, 2 + size :] / n - mean**2, 0.0))
    model: dict = {"mean": mean, "deviation": np.where(deviation > 1e-9, deviation, 1.0)}

    def normal(stats, labels):
        x = cosines(stats, model)
        return x.T @ np.hstack([x, labels[:, None]])

    equations = _sums(rows, normal, COSINES + 1)
    penalty = RIDGE * np.eye(COSINES + 1)
    penalty[-1, -1] = 0.0
    model["weights"] = np.linalg.solve(equations[:, :-1] + penalty, equations[:, -1])

    def binned(stats, labels):
        at = score_bin(cosines(stats, model) @ model["weights"])
        return np.stack([np.bincount(at, labels, BINS), np.bincount(at, minlength=BINS).astype(float)])

    wins, weights = _sums(rows, binned, 2)
    used = weights > 0
    model["bins"], model["values"] = np.flatnonzero(used).astype(float), pool_adjacent(wins[used], weights[used])
    return model


def score_bin(scores: np.ndarray) -> np.ndarray:
    return np.clip(((scores + 1.0) / 3.0 * BINS).astype(np.int64), 0, BINS - 1)


def calibrated(stats: np.ndarray, model: dict) -> np.ndarray:
    """Probabilities of label 1."""
    if "constant" in model:
        return np.full(len(stats), model["constant"])
    raw = cosines(stats, model) @ model["weights"]
    return np.clip(np.interp(score_bin(raw), model["bins"], model["values"]), 0.0, 1.0)


def accepted(docs: DataFrame, model: dict, least: float = 0.5, text: str = "text") -> DataFrame:
    """The documents that score at least so much, unchanged."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                stats = np.array([statistics(one.as_py() or "") for one in batch.column(text)])
                yield batch.filter(pa.array(calibrated(stats, model) >= least))

    return docs.mapInArrow(keep, docs.schema)


def score(rows: DataFrame, model: dict) -> DataFrame:
    """The measured rows with `score` for `stats`."""
    rest = [name for name in rows.columns if name not in ("stats", "score")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            found = calibrated(stats, model)
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), pa.array(found)], [*rest, "score"])

    schema = T.StructType([rows.schema[name] for name in rest]).add("score", T.DoubleType())
    return rows.select(*rest, "stats").mapInArrow(apply, schema)


def labelled(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """The statistics of labelled documents: stats, label."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("label")).filter("label IN (0, 1)")
    return rows.select(F.col(key).alias("_own"), "stats").join(known, F.col("_own") == F.col("_key")).select("stats", "label")
