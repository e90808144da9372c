"""Operator 4 against Python's regular expressions, and what the ledger saves."""

from __future__ import annotations

import random
import re
from dataclasses import replace

from pyspark.sql import functions as F

from sensorloom.llm import secrets
from sensorloom.session import scratch_path

PARTS = ["password", "Token", " = ", ": ", '"', "'", "api_key", "APIKEY", "abcdef0123456789", "AKIA", "ABCDEFGHIJKLMNOP", "é😀", " ", "\n", "x=y", "secret=short", "0123456789abcdef" * 3]


def expected(text: str):
    spans = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 12:
            spans.append(("assign", m.start(), m.end()))
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def plain(rows):
    return {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.spans] for r in rows}


def test_spans_equal_plain_patterns(make):
    rng = random.Random(4)
    rows = [(n, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))) for n in range(300)]
    found = plain(secrets.scan(make(rows)).collect())
    assert found == {n: expected(text) for n, text in rows}
    assert sum(map(len, found.values())) > 100


def test_ledger_scans_only_unseen_pairs(spark, make):
    ledger = scratch_path(spark, "ledger")
    first = [(1, "token = abcdefghijklmnop"), (2, "nothing"), (3, "nothing")]
    secrets.scan(make(first), ledger)
    assert secrets.read_ledger(spark, ledger).count() == 2  # two different texts
    second = [*first, (4, "password: abcdefghijklmnop")]
    found = plain(secrets.scan(make(second), ledger).collect())
    assert secrets.read_ledger(spark, ledger).count() == 3
    assert found[1] == [("assign", 0, 24)] and found[4] == [("assign", 0, 26)]
    # A new version of one rule is applied to all texts, the other rules to none.
    newer = [replace(secrets.RULES[0], version=2, least=17), *secrets.RULES[1:]]
    found = plain(secrets.scan(make(second), ledger, newer).collect())
    scans = secrets.read_ledger(spark, ledger).select(F.explode("rules").alias("rule")).groupBy("rule").count()
    assert {r["rule"]: r["count"] for r in scans.collect()} == {"assign@1": 3, "assign@2": 3, "access@1": 3, "hex@1": 3}
    assert found == {1: [], 2: [], 3: [], 4: []}


def test_odd_rows_and_no_rows(odd, none):
    rows = secrets.scan(odd).collect()
    assert len(rows) == 10 and all(r.spans == [] for r in rows)
    assert all(r.key == 7 and r.n == 10 for r in rows)
    assert secrets.scan(none).collect() == []


def test_redaction(make):
    rows = [(1, "é token = 0123456789abcdef end"), (2, "clean"), (3, None)]
    found = secrets.scan(make(rows)).select("doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("text"))
    assert {r.doc_id: r.text for r in found.collect()} == {1: "é [SECRET] end", 2: "clean", 3: None}


def test_redaction_equals_plain_cuts(make):
    rng = random.Random(9)
    rows = [(n, "".join(rng.choice(PARTS) for _ in range(rng.choice([3, 14, 400])))) for n in range(60)]

    def plain_redaction(text):
        out, at = "", 0
        for _, start, end in expected(text):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        return out + text[at:]

    found = secrets.scan(make(rows)).select("doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("text"))
    assert {r.doc_id: r.text for r in found.collect()} == {n: plain_redaction(text) for n, text in rows}


def test_one_text_with_many_secrets(make):
    text = "é password = 0123456789abcdef and\n" * 20_000
    row = secrets.scan(make([(1, text)])).select("spans", secrets.redacted(F.col("text"), F.col("spans")).alias("text")).first()
    assert [(s["kind"], s["start"], s["end"]) for s in row.spans] == expected(text)
    assert row.text == "é [SECRET] and\n" * 20_000


def test_a_second_scan_shuffles_no_text(spark, make):
    ledger = scratch_path(spark, "ledger")
    rows = [(n, f"text {n} token = abcdefghijklmnop{n}") for n in range(50)]
    first = plain(secrets.scan(make(rows), ledger).collect())
    files = set(spark.read.parquet(ledger).inputFiles())
    assert plain(secrets.scan(make(rows), ledger).collect()) == first
    assert set(spark.read.parquet(ledger).inputFiles()) == files
    # A scan that was appended twice finds nothing twice.
    spark.read.schema(secrets.LEDGER).parquet(ledger).write.parquet(copy := scratch_path(spark, "copy"))
    spark.read.schema(secrets.LEDGER).parquet(copy).write.mode("append").parquet(ledger)
    assert plain(secrets.findings(make(rows), ledger).collect()) == first
