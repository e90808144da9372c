"""Operator 5 and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sensorloom.llm import jaccard
from sensorloom.llm.components import components

SPACES = " \t\n\v\f\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, size):
    words, word = [], ""
    for c in lower(text or "") + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_force(rows, size, percent):
    sets = {n: shingles(text, size) for n, text in rows}
    least = {n: n for n in sets}

    def find(n):
        while least[n] != n:
            n = least[n]
        return n

    names = sorted(sets)
    for at, a in enumerate(names):
        for b in names[at + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                least[max(x, y)] = min(x, y)
    return {n: (len(sets[n]), find(n)) for n in sets}


def found(rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows.collect()}


def corpus(rng, families, copies):
    words = [f"w{n}" for n in range(400)] + ["É", "É", "a b", "x y"]
    rows = []
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_equals_brute_force(make, size, percent):
    rows = corpus(random.Random(size), 40, 6)
    assert found(jaccard.join(make(rows).repartition(3), size, percent)) == brute_force(rows, size, percent)


def test_large_stars_are_cut_into_blocks(make, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = corpus(random.Random(11), 3, 70)
    expected = brute_force(rows, 3, 90)
    assert len({c for _, c in expected.values()}) < len(rows)
    assert found(jaccard.join(make(rows), 3, 90)) == expected


def test_answers_follow_from_the_first_set():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(250, 300), replace=False), rng.integers(0, 2**63, 8, dtype=np.uint64)])) for _ in range(30)]
    sets.append(np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64)))
    links = jaccard.linked_pairs(sets, 80)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert links[i, j] == (100 * both >= 80 * (len(a) + len(b) - both))


def test_odd_rows_and_no_rows(odd, none):
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.join(odd, 3, 90).collect())
    assert len(rows) == 10
    by_id = {r[0]: r for r in rows}
    assert by_id[5][2] == 1 and rows[1] == rows[2]  # a copy, and a repeated row
    assert by_id[2][1:] == (0, 2) and by_id[3][1:] == (0, 3) and by_id[6][1:] == (0, 6)
    assert by_id[7][1:] == (1, 7) and by_id[0][2] is None
    assert jaccard.join(none).collect() == []


def test_a_repeated_id_is_one_node(make):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "e f g h"), (3, "e f g h")]
    assert {r.doc_id: r.component_id for r in jaccard.join(make(rows), 3, 90).collect()} == {1: 1, 2: 1, 3: 1}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(n, n + 1) for n in range(200, 240)] + [(300, n) for n in range(301, 360)]
    found_ = {r.node: r.component for r in components(spark.createDataFrame([*edges, (7, None), (500, 500)], "a bigint, b bigint")).collect()}
    least = {n: n for e in edges for n in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert found_ == {n: least[n] for n in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(3)
    for percent in (30, 80, 90):
        sets = []
        for size in (1, 2, 5, 40, 63, 64, 65, 130, 1000):
            base = rng.integers(0, 2**63, size, dtype=np.uint64)
            for share in (0.0, 0.05, 0.1, 0.15, 0.3):
                kept = base[rng.random(size) >= share]
                sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, int(share * size / 2), dtype=np.uint64)])))
        sets = [s for s in sets if len(s)]
        sizes = np.array([len(s) for s in sets])
        alive = jaccard.may_link(sizes, [jaccard.sketch(s) for s in sets], percent)
        linked = np.zeros(len(sets), bool)
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= percent * (sizes[a] + sizes[b] - both):
                    linked[[a, b]] = True
        assert linked.any() and not (linked & ~alive).any() and (percent < 50 or not alive.all())
