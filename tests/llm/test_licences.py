"""Operator 2 against a plain scan, and inheritance by path."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from sensorloom.llm import licences

MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
FILES = [
    ("a/LICENSE", APACHE),
    ("a/x.py", "code and more code\n" + MIT + "\nand more of it, for a while, and so on and on and on\n" * 3),
    ("a/y.py", "no notice here"),
    ("a/b/c/z.py", "none here either"),
    ("a/b/LICENSE.md", "hello world of words"),  # the name alone says nothing
    ("ab/w.py", "not below a, whatever its name"),
    ("q/short", MIT + "\nthe end"),
    ("q/r/s", "plain"),
    ("top", None),
    (None, "the licence of nothing under the version of a work"),
]


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.createDataFrame([(n, path, text, "x", 1.0) for n, (path, text) in enumerate(FILES)], "n int, path string, text string, above string, file_cosine double")
    return table, {r.n: r for r in licences.scan(table).collect()}


def test_own_and_inherited(rows):
    _, found = rows
    assert len(found) == len(FILES)
    assert found[1].licence == "MIT" and found[1].cosine == pytest.approx(1.0) and found[1].effective == "MIT"
    assert [(found[n].licence, found[n].inherited, found[n].inherited_from) for n in (2, 3)] == [(None, "Apache-2.0", "a")] * 2
    assert found[5].effective is None and found[8].effective is None and found[9].effective is None
    assert found[7].effective == "MIT" and found[7].inherited_from == "q"


def test_bound_is_exact(rows):
    """Scoring every segment of every file gives the same."""
    table, found = rows
    seen = Counter(w for _, text in FILES for w in set(licences.terms(text or "")))
    weights = licences.Weights(licences.TEMPLATES, len(FILES), seen)
    for n, (_, text) in enumerate(FILES):
        best = max((weights.closest(s)[0] for s in licences.segments(text or "")), default=0.0)
        assert best <= weights.bound(set(licences.terms(text or ""))) + 1e-9
        assert (best >= licences.SEGMENT_COSINE) == (found[n].licence is not None)


def test_cosine_by_hand():
    weights = licences.Weights({"A": ("one two",), "B": ("two three",)}, 10, {"two": 9})
    idf = {"one": math.log(11) + 1, "two": math.log(11 / 10) + 1}
    length = math.sqrt(idf["one"] ** 2 + idf["two"] ** 2)
    cosine, name = weights.closest("One, two and")
    assert name == "A" and cosine == pytest.approx(length / math.sqrt(length**2 + (math.log(11) + 1) ** 2))


def test_odd_rows_and_no_rows(odd, none):
    found = licences.scan(odd).collect()
    assert len(found) == 10 and all(r.effective is None and r.key == 7 for r in found)
    assert licences.scan(none).collect() == []


def test_a_common_word_in_the_notice_at_any_size(spark):
    """A word of half of all files weighs little, however many files there are."""
    cosines = []
    for files in (200, 10_000):
        text = f"CASE WHEN id % 10 = 0 THEN '{MIT} Example' WHEN id % 2 = 0 THEN 'one example of words' ELSE 'other words' END"
        table = spark.range(files).selectExpr("id", "concat('d', id, '/x') AS path", f"{text} AS text")
        found = licences.scan(table).collect()
        assert len(found) == files and all((r.licence == "MIT") == (r.id % 10 == 0) for r in found)
        cosines.append(min(r.cosine for r in found if r.licence))
    assert cosines[0] == pytest.approx(cosines[1], abs=0.01) and cosines[1] > 0.95
