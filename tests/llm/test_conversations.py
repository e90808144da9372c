"""Operator 11 against a search over all edits, and against a plain program over rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from sensorloom.llm import conversations as conv
from sensorloom.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, c int, t string, at int, audit int"
EXTRA = (1, "x", 2, 3)
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    """The first fault of each (role, text) row."""
    seen, out = set(), []
    for role, text in rows:
        ended = text.rstrip(WHITE)
        out.append("b" if not ended else "d" if (role, text) in seen else "t" if ended[-1] not in ".!?" else "k")
        seen.add((role, text))
    return out


def all_audits(initials, wrong):
    """Every audit of rows with at most two insertions anywhere, that gives a sound conversation: (cost, audit)."""
    gaps = ["", "I", "II"]
    for edits in product("KRD", repeat=len(initials)):
        if any(e != "D" and f in "bd" for e, f in zip(edits, wrong)):
            continue
        for inserted in product(gaps, repeat=len(initials) + 1):
            audit = inserted[0] + "".join(e + i for e, i in zip(edits, inserted[1:]))
            made, rows = "", iter(zip(initials, wrong))
            cost = 0
            for e in audit:
                turn = "a" if made.endswith("u") else "u"
                if e == "I":
                    made, cost = made + turn, cost + 5
                    continue
                initial, fault = next(rows)
                if e == "D":
                    cost += 2
                    continue
                made += initial if e == "K" else turn
                cost += (e == "R") + 5 * (fault == "t")
            if re.fullmatch("(s?(ua)+)?", made):
                yield cost, audit


def plain(rows):
    """Cost, audit and repaired lines by a program over rows and states; rows as (role, text) in order."""
    best = {"": (0, "", ())}

    def better(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    def opened(table):
        table = dict(table)
        for _ in range(2):
            for last, (cost, audit, made) in list(table.items()):
                role = "assistant" if last == "u" else "user"
                better(table, role[0], (cost + 5, audit + "I", (*made, f"{role}:")))
        return table

    for (role, text), fault in zip(rows, faults(rows)):
        after = {}
        for last, (cost, audit, made) in opened(best).items():
            better(after, last, (cost + 2, audit + "D", made))
            if fault in "bd":
                continue
            more = 5 * (fault == "t")
            turn = "assistant" if last == "u" else "user"
            if role[:1] == turn[0] or (last == "" and role[:1] == "s"):
                better(after, role[0], (cost + more, audit + "K", (*made, f"{role}:{text}")))
            better(after, turn[0], (cost + 1 + more, audit + "R", (*made, f"{turn}:{text}")))
        best = after
    return min(v for k, v in opened(best).items() if k in ("", "a"))


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_matrices_find_what_a_search_over_all_edits_finds(length):
    kinds = [(i, f) for i in "suao" for f in "kbdt"]
    rng = random.Random(length)
    for chosen in product(kinds, repeat=length) if length < 3 else [rng.choices(kinds, k=3) for _ in range(300)]:
        vector = [(0, conv.Rope("")), None, None, None]
        for one in chosen:
            vector = conv.product([vector], conv.single(*one).matrix)[0]
        assert conv.whole(vector) == min(all_audits([i for i, _ in chosen], [f for _, f in chosen])), chosen


def test_ropes_compare_like_strings():
    rng = random.Random(1)
    for _ in range(500):
        parts = ["".join(rng.choices("DK", k=rng.randint(1, 4))) for _ in range(6)]
        a, b = (sum((conv.Rope(p) for p in rng.sample(parts, rng.randint(1, 4))), conv.Rope("")) for _ in range(2))
        assert (a < b) == (str(a) < str(b))
        assert (a.length == b.length and a.code == b.code) == (str(a) == str(b))


def expected(rows):
    """The report of each conversation from its (turn, role, text) rows."""
    groups = {}
    for c, *row in rows:
        groups.setdefault(c, []).append(row)
    out = {}
    for c, own in groups.items():
        own = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in own]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()))
        lines = [(r, x) for _, r, x in own]
        wrong = faults(lines)
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] or "-" for r, _ in lines]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, made = plain(lines)
        out[c] = (gaps, *(wrong.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def report(found):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    hashes = {r.conv_id: r.repaired_sha256 for r in conv.digests(found.rows).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*[r[n] for n in names], hashes.get(r.conv_id, empty)) for r in found.conversations.collect()}


def some(rng, c, n):
    texts = ["Yes.", "No!", "Why?", "open end", "", " \t\n", "Fine. \n", None, "é😀.", "x\x1f"]
    roles = ["system", "user", "assistant", "tool", "", None, "S"]
    return [(c, rng.choice([None, *range(n)]) if rng.random() < 0.2 else k, rng.choices(roles, [2, 9, 9, 1, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}.") for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)


def test_conversations_equal_a_plain_program(spark):
    rng = random.Random(11)
    rows = [r for c in range(120) for r in some(rng, None if c == 50 else c, rng.randint(1, 9))]
    rows += some(rng, 500, 400) + [(501, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(700)]
    rows += [(502, 1, "user", "same.")] * 300 + [(503, 0, "user", "long " * 200_000 + "."), (503, 9, "assistant", "Yes.")] + rows[:5]
    assert report(conv.repair(frame(spark, rows))) == expected(rows)


def test_many_pieces_and_few_rules_change_nothing(spark, monkeypatch):
    rng = random.Random(12)
    rows = [r for c in range(12) for r in some(rng, c, 60)]
    found = report(conv.repair(frame(spark, rows)))
    assert found == expected(rows)
    monkeypatch.setattr(conv.learn_rules, "__defaults__", (1, 1))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pieces = []
    store = conv.written
    monkeypatch.setattr(conv, "written", lambda df, label: pieces.append(store(df, label)) or pieces[-1])
    try:
        assert report(conv.repair(frame(spark, rows))) == found
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert pieces[0].count() > 12  # some conversation lies in several partitions


def test_rules_are_shared_and_stand_for_their_rows(spark):
    sequences = spark.createDataFrame([("IEIEIEIE",), ("AIEIEIE",), ("IE",)], "seq string")
    rules = conv.learn_rules(sequences)
    assert rules[0][1] in ("IE", "EI") and len(rules) > 1
    short = [r.short for r in sequences.select(conv.compressed(conv.F.col("seq"), rules).alias("short")).collect()]
    assert max(map(len, short)) < 5
    known = conv.grammar(rules)
    full = conv.reduce(conv.Sequence.then, [known[s] for s in "IEIEIEIE"])
    packed = conv.reduce(conv.Sequence.then, [known[s] for s in short[0]])
    show = lambda s: [[e and (e[0], str(e[1])) for e in row] for row in s.matrix]
    assert show(full) == show(packed) and full[1:] == packed[1:]


def test_no_rows(spark):
    found = conv.repair(frame(spark, []))
    assert found.conversations.collect() == [] and found.rows.collect() == [] and conv.digests(found.rows).collect() == []


def test_query_damages_and_repairs_every_conversation(spark, tmp_path):
    rng = random.Random(13)
    rows = [(c, k, ("user", "assistant")[k % 2], f"Turn {k} of {c}.") for c in range(80) for k in range(rng.randint(1, 6))]
    rows += [(None, None, None, None), (900, 0, "user", None)] + [(1000 + n, 0, "user", "One row.") for n in range(60)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    after = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        after += [(c, t, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    want = expected(after)
    none = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    found = QUERIES["op11_conversations"](spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == {c: want.get(c, none) for c in {r[0] for r in rows}}
    assert len(found) == 142 and any(r.audit == "" for r in found)
