"""Operator 9: patterns against plain ones, the field against all labellings, odd inputs."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from sensorloom.llm import pii, queries

PARTS = ["a.b@c.de", "@", "x@y", "+1 (555) 555-0123", "4111 1111 1111 1111", "4111111111111112", "10.0.0.1", "999.1.1.1", "1.2.3.4.5.6.7.8", " ", "-", ".", "+", "12", "é", "word", "\n", "a%b+c@mail.example.com."]


def expected(text):
    spans = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        check = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
        if 13 <= len(digits) <= 19 and check % 10 == 0:
            spans.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def test_patterns_equal_plain_ones():
    rng = random.Random(9)
    total = 0
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == expected(text)
        total += len(expected(text))
    assert total > 1000


@pytest.fixture(scope="module")
def model(spark):
    return pii.learn(pii.labelled_table(queries.documents(spark, "/root/testdata/sf0.1")))


def test_best_labelling(model):
    """Viterbi over stretches equals trying every labelling of whole short texts."""
    rng = random.Random(1)
    used = [0, 1, 2, 5, 6, 7]
    link, unary = model["link"], model["unary"]
    small = {"unary": unary.copy(), "link": link.copy()}
    for tag in set(range(len(pii.TAGS))) - set(used):
        small["unary"][0][:, tag] = -1e6
    words = ["4111111111111111", "x@y.de", "word", "+1", "12", "(555)", "a", "555-0123", "plain"]
    for _ in range(25):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 5)))
        starts, _, shape = pii.shapes(text.encode())
        first = np.arange(len(starts)) == 0
        before, after = pii.neighbours(shape, first)
        score = small["unary"][0][shape] + small["unary"][1][before] + small["unary"][2][after]

        def value(tags, score=score):
            return sum(score[i, t] for i, t in enumerate(tags)) + sum(small["link"][a, b] for a, b in itertools.pairwise(tags))

        tags = pii.decode(shape, first, small, pii.certain_outside(small))
        best = max(value(t) for t in itertools.product(used, repeat=len(shape)))
        assert abs(value(tags.tolist()) - best) < 1e-6
        # The saving is exact: with nothing certain the labelling is as good.
        leads, _ = pii.certain_outside(small)
        assert abs(value(pii.decode(shape, first, small, (leads, 1e9)).tolist()) - best) < 1e-6


def test_field_finds_what_it_was_shown(model):
    texts = [f"and then {span} was there again" for span in ("le.42@mail6.example.com", "+1 (900) 555-2077", "203.0.113.77")]
    found = pii.field_spans(texts, model, pii.certain_outside(model))
    assert [[s[0] for s in one] for one in found] == [["email"], ["phone"], ["ip"]]
    assert pii.field_spans(["nothing to see here, move on."], model, pii.certain_outside(model)) == [[]]


def test_added_spans_hold_and_are_free(model, make):
    # The run of digits and blanks is one failed match of the pattern; the card in it is the field's.
    rows = [(1, "the 20953013749 4111111111111111 was"), (2, "the 4111111111111112 was"), (3, None)]
    found = {r.doc_id: r for r in pii.find(make(rows), model).collect()}
    assert found[1].base == [] and [(s["kind"], s["start"], s["end"]) for s in found[1].added] == [("card", 16, 32)]
    assert found[2].added == [] and found[3].base == []


def test_odd_rows_and_no_rows(odd, none, model):
    for used in (model, None):
        rows = pii.find(odd, used).collect()
        assert len(rows) == 10 and all(r.base == [] and r.added == [] and r.key == 7 for r in rows)
        assert pii.find(none, used).collect() == []
    assert pii.learn(pii.labelled_table(none)) is None
    assert pii.learn(pii.labelled_table(odd)) is not None


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in queries.documents(spark, folder).collect()}
    for r in queries.op9_pii(spark, folder).collect():
        base = expected(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(",")) | {""}
