"""Operator 8: pooling against its definition, held-out accuracy, odd inputs."""

from __future__ import annotations

import itertools
import random

import numpy as np

from sensorloom.llm import quality, queries


def test_pooling_is_the_closest_monotone_fit():
    rng = random.Random(8)
    for _ in range(60):
        weights = np.array([rng.randint(1, 4) for _ in range(rng.randint(1, 6))], dtype=float)
        sums = np.array([rng.randint(0, int(w)) for w in weights], dtype=float)
        fitted = quality.pool_adjacent(sums, weights)
        assert (np.diff(fitted) >= -1e-12).all()
        # The best fit is constant between cuts; try them all.
        best = min(
            (
                sum(((sums[a:b].sum() / weights[a:b].sum() - sums[a:b] / weights[a:b]) ** 2 * weights[a:b]).sum() for a, b in itertools.pairwise(edges))
                for k in range(len(sums))
                for inner in itertools.combinations(range(1, len(sums)), k)
                if (edges := (0, *inner, len(sums)))
                and all(x <= y + 1e-12 for x, y in itertools.pairwise([sums[a:b].sum() / weights[a:b].sum() for a, b in itertools.pairwise(edges)]))
            )
        )
        assert abs(((fitted - sums / weights) ** 2 * weights).sum() - best) < 1e-9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op8_quality(spark, folder)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = rows.collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    for label in (0, 1):
        some = [r for r in held if labels[r.doc_id] == label]
        assert sum(r.predicted == label for r in some) / len(some) > 0.97
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_odd_rows_and_no_rows(spark, odd, none):
    measured = quality.measured(odd)
    assert all(r.key == 7 for r in measured.collect())
    some = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (4, 0), (5, None), (None, 1), (99, 0)], "doc_id bigint, quality int")
    model = quality.fit(quality.labelled(measured, some))
    scores = quality.score(measured, model).collect()
    assert len(scores) == 10 and all(0 <= r.score <= 1 for r in scores)
    assert quality.accepted(none, model).collect() == [] and quality.score(quality.measured(none), model).collect() == []
    # Without labels nothing is known, with one label only its share is the score.
    assert quality.fit(quality.labelled(measured, some.limit(0))) == {"constant": 0.5}
    assert quality.accepted(odd, {"constant": 0.5}).count() == 10
    assert quality.fit(quality.labelled(measured, some.filter("quality = 0"))) == {"constant": 0.0}
