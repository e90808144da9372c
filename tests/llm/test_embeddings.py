"""Operator 10: recall against all pairs, odd vectors."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from sensorloom.llm import common, embeddings, queries
from sensorloom.llm.components import components


def all_pairs(rows, threshold):
    links = {}
    for at, (a, x, label) in enumerate(rows):
        for b, y, other in rows[at + 1 :]:
            if label == other and label is not None and len(x) == len(y):
                if np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links.setdefault(a, set()).add(b)
                    links.setdefault(b, set()).add(a)
    return links


def test_recall_on_hard_pairs(spark):
    """Neighbours just above the threshold, in a group for which the tables are chosen anew."""
    rng = np.random.default_rng(10)
    base = rng.normal(size=(300, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(0.9, 0.97, size=(300, 1))
    near = cosine * base + np.sqrt(1 - cosine**2) * aside
    rows = [(n, v.tolist(), 1 if n < 400 else 2) for n, v in enumerate(np.concatenate([base, near]))]
    rows[300:] = [(n, v, rows[n - 300][2]) for n, v, _ in rows[300:]]
    truth = all_pairs(rows, 0.93)
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), 0.93).collect()
    total = sum(len(v) for v in truth.values())
    assert total > 200 and sum(r.n_links for r in found) >= 0.9 * total
    assert all(r.n_links <= len(truth.get(r.vec_id, ())) for r in found)  # none below the threshold


def test_recall_on_the_given_vectors(spark):
    folder = "/root/testdata/sf0.1"
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = queries.op10_embeddings(spark, folder).collect()
    unit = np.array([r.embedding for r in given], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    labels = np.array([-1 if r.label is None else r.label for r in given])
    near = (unit @ unit.T >= 0.93) & (labels[:, None] == labels) & (labels >= 0)[:, None]
    truth = int(near.sum() - np.diag(near).sum())
    assert len(rows) == len(given) and 0.9 * truth <= sum(r.n_links for r in rows) <= truth
    assert all(r.kept == (r.component_id == r.vec_id) and r.component_id <= r.vec_id for r in rows)


def test_odd_rows_and_no_rows(spark):
    rows = [
        (1, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (3, [1.0, 0.0], 2, "x"), (4, [1.0, 0.0], None, "x"),
        (5, None, 1, "x"), (6, [], 1, "x"), (7, [0.0, 0.0], 1, "x"), (8, [1.0, None], 1, "x"), (9, [1.0, math.nan], 1, "x"),
        (10, [math.inf, 0.0], 1, "x"), (11, [1.0, 0.0, 0.0], 1, "x"), (12, [1e200, 1e150], 1, "x"), (13, [1e-200, 0.0], 1, "x"), (None, [0.0, 1.0], 1, "x"),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, number string")
    found = embeddings.near_duplicates(table, 0.93).collect()
    links = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert len(found) == len(rows)
    assert links[1] == (4, 1, True) and links[2] == links[12] == links[13] == (4, 1, False)
    assert all(links[n] == (0, n, True) for n in (3, 4, 5, 6, 7, 8, 9, 10, 11)) and links[None] == (0, None, True)
    assert embeddings.near_duplicates(table.limit(0), 0.93).collect() == []


def test_rotation_keeps_neighbours_together():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(500, 16))
    mean, projection = embeddings.learn_rotation(sample / np.linalg.norm(sample, axis=1, keepdims=True), 16)
    assert np.allclose(projection.T @ projection, np.eye(16), atol=1e-8)
    assert abs((((sample / np.linalg.norm(sample, axis=1, keepdims=True)) - mean) @ projection >= 0).mean() - 0.5) < 0.05


def near_pairs(rng, base, least=0.93, most=0.97):
    """For every unit vector another one at a cosine between the two given."""
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(least, most, size=(len(base), 1))
    return cosine * base + np.sqrt(1 - cosine**2) * aside


def recall(spark, vectors, threshold=0.93):
    """The share of all links that are found, none of which may be wrong."""
    rows = [(n, [float(x) for x in v], 1) for n, v in enumerate(vectors)]
    truth = all_pairs(rows, threshold)
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), threshold).collect()
    assert len(found) == len(rows) and all(r.n_links <= len(truth.get(r.vec_id, ())) for r in found)
    return sum(r.n_links for r in found) / sum(len(v) for v in truth.values())


def test_a_short_vector_among_long_ones(spark):
    """Each length has tables, radius and distance bound of its own."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(300, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    long = [*base, *near_pairs(rng, base)]
    assert recall(spark, [*long, [1.0, 0.5]]) >= 0.9
    assert recall(spark, [*long, rng.normal(size=8)]) >= 0.9


def test_vectors_with_a_common_direction(spark):
    """Pairs right above the threshold whose angle around the mean is much wider than their own."""
    for shared in (0.8, 0.9):
        rng = np.random.default_rng(12)
        own = rng.normal(size=(300, 63))
        own *= math.sqrt(1 - shared**2) / np.linalg.norm(own, axis=1, keepdims=True)
        base = np.concatenate([np.full((300, 1), shared), own], axis=1)
        assert recall(spark, [*base, *near_pairs(rng, base, 0.931, 0.94)]) >= 0.9


def test_no_join_brings_many_rows_to_the_driver(spark, tmp_path, monkeypatch):
    """Entries of the tables and pairs are many times the files that they come from; a broadcast of them may not happen."""
    rng = np.random.default_rng(13)
    base = rng.normal(size=(6000, 64))
    base[:300] = base[0] + 0.2 * rng.normal(size=(300, 64))  # a group whose pairs compress to little
    rows = [(n, [float(x) for x in v], 1) for n, v in enumerate(base)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").write.parquet(f"{tmp_path}/vectors")
    vectors = spark.read.parquet(f"{tmp_path}/vectors")
    monkeypatch.setattr(common, "SENT_BYTES", 1 << 17)
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(2 << 20))
    try:
        found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(vectors, 0.93).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(found) == 6000 and sum(links for links, _ in found.values()) >= 0.9 * 300 * 299
    assert all(found[n][1] == 0 for n in range(300)) and all(found[n][1] == n for n in range(300, 6000))


def test_exploded_codes_are_not_sent(spark, tmp_path):
    spark.range(1000).selectExpr("id number", "1 label", "64 size", "xxhash64(id) code", "id sketch0", "id sketch1", "id sketch2").write.parquet(f"{tmp_path}/codes")
    pairs = embeddings.candidates(spark.read.parquet(f"{tmp_path}/codes"), 64, 0.12, 5, 12, 1, 0.12)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_counted_sides_of_a_join(spark):
    few, many = spark.range(10).withColumn("x", F.lit(1)), spark.range(200_000).withColumn("y", F.lit(1))
    shown = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in shown(common.joined(many, many.withColumnRenamed("y", "z"), "id", (200_000, 200_000)))
    assert "BuildLeft" in shown(common.joined(few, many, "id", (10, 200_000)))
    assert "BuildRight" in shown(common.joined(many, few, "id", (200_000, 10)))


def test_the_sample_in_parts(spark, monkeypatch):
    """The plan is the same however many vectors are copied at a time."""
    rng = np.random.default_rng(14)
    sample = rng.normal(size=(700, 24)) + 0.3
    table = spark.createDataFrame([([float(x) for x in v],) for v in sample], "vector array<double>").repartition(5)
    packed = embeddings._collected(table, 24)
    assert sorted(map(tuple, packed)) == sorted(map(tuple, sample))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    (mean, projection), flip, tables = embeddings.plan(sample, 5000, 0.93)
    monkeypatch.setattr(embeddings, "BLOCK_BYTES", 8 * 24 * 64)
    (other_mean, other), other_flip, other_tables = embeddings.plan(sample, 5000, 0.93)
    assert tables == other_tables and math.isclose(flip, other_flip, rel_tol=1e-9) and np.allclose(mean, other_mean)
    assert (((sample - mean) @ projection >= 0) == ((sample - other_mean) @ other >= 0)).mean() > 0.999


def test_components_by_sorted_joins(spark, monkeypatch):
    links = spark.createDataFrame([(n, n + 1) for n in range(40) if n % 10 != 9] + [(7, 7), (None, 3)], "a bigint, b bigint")
    small = sorted(map(tuple, components(links).collect()))
    monkeypatch.setattr(common, "SENT_BYTES", 0)
    assert sorted(map(tuple, components(links).collect())) == small == [(n, n - n % 10) for n in range(40)]


def test_sketches_keep_links_and_leave_out_the_rest(spark):
    """Pairs at the threshold pass, also with a common direction; nearly all others that tables bring together do not."""
    rng = np.random.default_rng(15)
    for shared in (0.0, 0.8):
        own = rng.normal(size=(1000, 63))
        own *= math.sqrt(1 - shared**2) / np.linalg.norm(own, axis=1, keepdims=True)
        base = np.concatenate([np.full((1000, 1), shared), own], axis=1)
        both = np.concatenate([base, near_pairs(rng, base, 0.93, 0.9301)])
        rows = spark.createDataFrame([(n, 1, [float(x) for x in v]) for n, v in enumerate(both)], "number bigint, label int, vector array<double>")
        coded = {r.number: r for r in embeddings._coded(rows, {64: embeddings.learn_rotation(both)}).collect()}
        most = embeddings.furthest(64 * embeddings.SKETCH_WORDS, math.acos(0.93) / math.pi)
        words = range(embeddings.SKETCH_WORDS)
        apart = lambda a, b: sum(((coded[a][f"sketch{i}"] ^ coded[b][f"sketch{i}"]) & (1 << 64) - 1).bit_count() for i in words)  # noqa: E731, B023
        assert all(apart(n, n + 1000) <= most for n in range(1000))
        if not shared:
            assert sum(apart(n, n + 1) <= most for n in range(999)) == 0
