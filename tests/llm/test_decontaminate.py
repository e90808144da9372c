"""Operator 1 against plain edit distances."""

from __future__ import annotations

import random

import numpy as np

from sensorloom.llm import decontaminate


def folded(text):
    return "".join(" " if c.isspace() else c.lower() if len(c.lower()) == 1 else c for c in text)


def fewest_edits(item, text):
    row = [0] * (len(text) + 1)
    for char in item:
        new = [row[0] + 1]
        for j, c in enumerate(text):
            new.append(min(row[j] + (c != char), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, text, times):
    text = list(text)
    for _ in range(times):
        at, kind = rng.randrange(len(text)), rng.random()
        if kind < 0.4:
            text[at] = rng.choice("xyzÉ")
        elif kind < 0.7:
            del text[at]
        else:
            text.insert(at, rng.choice("xyz"))
    return "".join(text)


def test_equals_plain_edit_distance():
    rng = random.Random(1)
    words = ["the", "theory", "of", "Ünits", "and", "tion", "plus", "a", "an", "reason"]
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(3, 40)))) for n in range(25)]
    items = [(n, t) for n, t in items if len(t) >= decontaminate.Q]
    index = decontaminate.Index(items)
    hits = 0
    for _ in range(50):
        number, item = rng.choice(items)
        k = min(int(0.08 * len(item)), (len(item) - decontaminate.Q) // decontaminate.Q)
        before, after = (" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(2))
        text = f"{before}\n{edited(rng, item.upper(), rng.randint(0, k + 2))} {after}"
        found = {index.ids[m.item]: m for m in decontaminate.search(index, [text])}
        for other, words_ in items:
            least = fewest_edits(folded(words_), folded(text))
            allowed = min(int(0.08 * len(words_)), (len(words_) - decontaminate.Q) // decontaminate.Q)
            assert (least <= allowed) == (other in found)
            if other in found:
                m = found[other]
                assert m.edits == least == decontaminate_whole(folded(words_), folded(text)[m.start : m.end])
                hits += 1
    assert hits > 30


def decontaminate_whole(item, part):
    row = list(range(len(part) + 1))
    for j, char in enumerate(item):
        new = [j + 1]
        for i, c in enumerate(part):
            new.append(min(row[i] + (c != char), row[i + 1] + 1, new[i] + 1))
        row = new
    return row[-1]


def test_tables_in_blocks(spark, make, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    items = [(1, "the quick brown fox jumps over it"), (2, "pack my box with five dozen jugs"), (3, None), (4, "short"), (1, "the quick brown fox jumps over it")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = make([(1, "so The Quick  brown fox jumps over it."), (2, "nothing"), (3, "Pack my box with five dozen jugs"), (4, "short"), (5, None)])
    found = decontaminate.matches(docs, benchmark)
    assert found.columns == ["doc_id", "item_id", "edits", "start", "end"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 1, 3, 37), (1, 1, 1, 3, 37), (3, 2, 0, 0, 32)]
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5]


def test_odd_rows_and_no_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "text goes on and on without an end"), (2, "🙂🙂 never there 🙂🙂")], "item_id bigint, text string")
    assert {r.doc_id for r in decontaminate.matches(odd, items).collect()} == {4}
    assert decontaminate.clean(odd, items).count() == 9
    assert decontaminate.matches(none, items).collect() == [] and decontaminate.clean(none, items).collect() == []
    assert decontaminate.matches(odd, items.limit(0)).collect() == [] and decontaminate.clean(odd, items.limit(0)).count() == 10


def test_qgrams_are_equal_only_where_the_text_is():
    text = decontaminate.codes("abcdefghijXabcdefghij")
    hashes = decontaminate.qgrams(text)
    assert hashes[0] == hashes[11] and len(np.unique(hashes)) == len(hashes) - 1


def test_every_letter_is_folded():
    """Vietnamese, Greek with accents, Deseret; wide and thin spaces."""
    assert decontaminate.codes("TIẾNG VIỆT ἈΡΧῊ 𐐀\u3000\u2009").tolist() == decontaminate.codes("tiếng việt ἀρχὴ 𐐨  ").tolist()
    every = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if len(c.lower()) == 1]
    wanted = [32 if c.isspace() else ord(c.lower()) for c in every]
    assert decontaminate.codes("".join(every)).tolist() == wanted
