"""Operator 3: the automaton against all substrings, the parse against a plain one, held-out accuracy."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np

from sensorloom.llm import langid, queries

SMALL = "/root/testdata/sf0.01"


def plain_parse(text: bytes, substrings: set[bytes]) -> int:
    at = pieces = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in substrings:
            size += 1
        at += size
        pieces += 1
    return pieces


def test_automaton_and_parse():
    rng = random.Random(3)
    for _ in range(40):
        texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 4))]
        edges = langid.suffix_automaton(texts)
        follow = defaultdict(dict)
        for source, byte, target in zip(*(column.tolist() for column in edges[:3])):
            follow[source][byte] = target
        accepted, waiting = set(), [(0, b"")]
        while waiting:
            state, word = waiting.pop()
            for byte, target in follow[state].items():
                accepted.add(word + bytes([byte]))
                waiting.append((target, word + bytes([byte])))
        substrings = {t[i:j] for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        assert accepted == substrings
        queries_ = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 40))) for _ in range(5)]
        counts = langid.count_pieces([np.frombuffer(q, np.uint8) for q in queries_], [langid.parse_table(*edges)])
        assert counts[:, 0].tolist() == [plain_parse(q, substrings) for q in queries_]


def test_held_out_accuracy(spark):
    found = queries.op3_language(spark, SMALL)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in queries.documents(spark, SMALL).collect()}
    rows = found.collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows_and_no_rows(odd, none):
    models = langid.learn(odd)
    assert [m[0] for m in models] == ["de", "en"]
    rows = langid.identify(odd, models).collect()
    assert len(rows) == 10 and all(r.key == 7 for r in rows)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {2, 3, 6, 8}
    # The texts of both languages are the same: the first in order wins.
    assert {r.lang_pred for r in rows if r.doc_id == 5} == {"de"}
    assert langid.identify(none, models).collect() == []
    assert {r.lang_pred for r in langid.identify(odd, langid.learn(none)).collect()} == {"und"}


def test_copies_of_few_texts(spark):
    """A language of many copies is learned like one without copies."""
    texts = {"de": "Der schnelle braune Fuchs springt über den faulen Hund", "en": "The quick brown fox jumps over the lazy dog", "it": "La volpe veloce salta sopra il cane pigro"}
    once = [(text, lang) for lang, text in texts.items()]
    many = spark.createDataFrame(once, "text string, lang string").selectExpr("text", "lang", "explode(sequence(1, 5000)) AS n")
    models = langid.learn(many)
    assert [m[0] for m in models] == ["de", "en", "it"]
    plain = langid.learn(spark.createDataFrame(once, "text string, lang string"))
    assert [(m[0], m[1], m[2][3]) for m in models] == [(m[0], m[1], m[2][3]) for m in plain]
    found = langid.identify(spark.createDataFrame(once, "text string, truth string"), models).collect()
    assert all(r.lang_pred == r.truth for r in found)
