"""Operator 12 against a plain Lloyd iteration on Python integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import codebooks
from sensorloom.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, code int, error int, position string, entry int, n int, part int"
EXTRA = ("r", 1, 2, "p", 3, 4, 5)


def plain(rows, count=8, entries=16, rounds=6, scale=4096):
    """(id, code, error) of the kept rows and the codebooks."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][1]) // count
    parts = [[tuple(v[p * size : (p + 1) * size]) for p in range(count)] for _, v in kept]
    first = sorted({i for i, _ in kept if i is not None})[:entries]
    start = [min(v for j, v in kept if j == i) for i in first]
    books = [[tuple(v[p * size : (p + 1) * size]) for v in start] for p in range(count)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(count):
            own = [near(parts_[p], books[p])[1] for parts_ in parts]
            books[p] = [
                tuple(sum(x) // len(m) for x in zip(*m, strict=True)) if (m := [q[p] for q, o in zip(parts, own, strict=True) if o == e]) else c
                for e, c in enumerate(books[p])
            ]
    found = [[near(q[p], books[p]) for p in range(count)] for q in parts]
    return [(i, "".join(f"{e:02x}" for _, e in f), min(codebooks.LONGEST, sum(d for d, _ in f))) for (i, _), f in zip(kept, found, strict=True)], books


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, *EXTRA) for i, v in rows], SCHEMA).repartition(3)


def compare(spark, rows, **options):
    found = codebooks.compress(frame(spark, rows), **options)
    expected, books = plain(rows, **options)
    assert found.codebooks.tolist() == [[list(c) for c in book] for book in books]
    order = lambda row: tuple((x is None, x) for x in row)
    assert sorted(((r.vec_id, r.code, r.error) for r in found.codes.collect()), key=order) == sorted(expected, key=order)


def vectors(rng, n, width, spread=0.3):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(7)]
    return [[float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("width", [8, 24])
def test_equals_a_plain_iteration(spark, width):
    rng = random.Random(width)
    compare(spark, [(n * 3 % 301, v) for n, v in enumerate(vectors(rng, 301, width))])


def test_hot_copies_repeats_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(n, v) for n, v in enumerate(vectors(rng, 60, 16))]
    rows += [(500 + n, rows[0][1]) for n in range(40)]
    rows += [rows[1], rows[1], (1, rows[2][1]), (None, rows[3][1]), (None, rows[4][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 15 + [None]), (903, [float("nan")] * 16), (904, [float("inf")] * 16)]
    compare(spark, rows)
    # Other lengths than that of most rows, or no multiple of the parts, are left out.
    found = codebooks.compress(frame(spark, [*rows, (-1, [1.0] * 8), (-2, [1.0] * 15)])).codes
    assert found.filter("vec_id < 0").count() == 0 and found.count() == 105
    assert found.columns == [*[c for c in SCHEMA.replace(",", "").split()[::2] if c not in ("code", "error")], "code", "error"]


def test_fewer_ids_than_entries_and_no_rows(spark):
    rng = random.Random(3)
    compare(spark, [(n, v) for n, v in enumerate(vectors(rng, 5, 16))])
    compare(spark, [(n % 3, v) for n, v in enumerate(vectors(rng, 50, 8, 2.0))], entries=4, rounds=9)
    assert codebooks.compress(frame(spark, [])).codes.collect() == []
    assert codebooks.compress(frame(spark, [(None, [1.0] * 8), (1, None)])).codes.collect() == []


def test_components_beyond_64_bit_squares(spark):
    rng = random.Random(4)
    rows = [(n, [float(np.float32(rng.choice([-1e6, 1e6, 3e5]) + rng.random())) for _ in range(8)]) for n in range(40)]
    compare(spark, rows, entries=3)
    found = codebooks.compress(frame(spark, [(1, [1e30] * 8), (2, [-1e30] * 8), (3, [1e30] * 8)]), entries=1).codes
    assert {r.error for r in found.collect()} == {(1 << 63) - 1}


def test_only_parts_that_change_entry_move(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(n, v) for n, v in enumerate(vectors(rng, 400, 16, 0.6))]
    layers = []
    store = codebooks.written
    monkeypatch.setattr(codebooks, "written", lambda df, label: layers.append(store(df, label)) or layers[-1])
    codebooks.compress(frame(spark, rows))
    moved = [layer.filter("n IS NULL").count() for layer in layers]
    assert moved[0] == 400 * 8 and 0 < sum(moved[1:]) < 400 * 8
    for layer in layers:
        files = layer.filter("n IS NULL").select("position", "entry", "salt", F.input_file_name().alias("file")).distinct()
        assert files.groupBy("position", "entry", "salt").count().filter("count > 1").count() == 0


def test_query_sums_errors_by_label(spark, tmp_path):
    rng = random.Random(6)
    rows = [(n, v, rng.choice([None, 1, 2])) for n, v in enumerate(vectors(rng, 80, 64))]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = {r.vec_id: r for r in QUERIES["op12_codebooks"](spark, str(tmp_path)).collect()}
    label = {n: x for n, _, x in rows}
    for n, r in found.items():
        assert r.label_error == sum(o.error for m, o in found.items() if label[m] == label[n])
    assert len(found) == 80 and len({r.codebooks_sha256 for r in found.values()}) == 1
