"""The stages, each against a plain version on its own input."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest

import corpus_pipeline
from sensorloom.llm import bpe
from test_decontaminate import fewest_edits, folded
from test_jaccard import brute_force
from test_secrets import expected

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    """What each stage was given and what it returned."""
    docs = corpus_pipeline.documents(spark, FOLDER)
    given = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, FOLDER), name)
        given.append((docs, out))
        docs = out
    return given


def test_columns(outputs):
    for docs, out in outputs[:-1]:
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_quality(spark, outputs):
    docs, out = outputs[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in out.collect()}
    known = [r.doc_id for r in docs.collect() if r.doc_id in labels]
    assert sum((n in kept) == (labels[n] == 1) for n in known) / len(known) > 0.95


def test_near_duplicates(outputs):
    docs, out = outputs[1]
    components = brute_force([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert sorted(r.doc_id for r in out.collect()) == sorted(n for n, (_, c) in components.items() if n == c)


def test_decontamination(spark, outputs):
    docs, out = outputs[2]
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in out.collect()}
    for r in docs.collect():
        if any(folded(item) in folded(r.text) for item in items):
            assert r.doc_id not in kept
        elif r.doc_id not in kept:
            assert any(fewest_edits(folded(item), folded(r.text)) <= 0.08 * len(item) for item in items)


def test_secrets(outputs):
    docs, out = outputs[3]
    after = {r.doc_id: r for r in out.collect()}
    assert len(after) == docs.count()
    for r in docs.collect():
        text, spans = r.text, expected(r.text)
        if not spans:
            assert after[r.doc_id] == r
            continue
        cut, at = "", 0
        for _, begin, end in spans:
            if begin >= at:
                cut += text[at:begin] + "[SECRET]"
            at = max(at, end)
        assert after[r.doc_id].text == cut + text[at:] and after[r.doc_id].n_chars == len(cut + text[at:])


def test_encoding(outputs):
    docs, out = outputs[4]
    library = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    assert all(r.text == texts[r.doc_id] and list(r.ids) == library.encode_ordinary(r.text) for r in rows)


def test_run_has_the_last_stage(spark, outputs):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()) == sorted(r.doc_id for r in outputs[-1][1].collect())


def test_odd_rows_and_no_rows(odd, none, spark):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns
            docs = corpus_pipeline.written(out, name)
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
        assert len(rows) == docs.count()


def test_near_duplicates_of_odd_rows(odd, spark):
    kept = sorted((r.doc_id or 0) for r in corpus_pipeline.keep_one_of_each(spark, odd, FOLDER).collect())
    assert kept == [0, 1, 2, 3, 4, 6, 7, 8]


def test_two_texts_under_one_id(make, spark):
    words = [f"word{n}" for n in range(40)]
    first, other, third = " ".join(words), " ".join(reversed(words)), " ".join(sorted(words * 2))
    rows = [(1, first), (2, other), (2, first), (2, None), (3, first), (4, third), (4, other), (4, other), (None, first), (None, other)]
    chosen = {(r.doc_id, r.text) for r in corpus_pipeline.one_row_an_id(make(rows)).collect()}
    by_hash = lambda *texts: min(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert chosen == {(1, first), (2, None), (3, first), (4, by_hash(third, other)), (None, first), (None, other)}
    kept = corpus_pipeline.keep_one_of_each(spark, make(rows), FOLDER).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 1, 2, 4]
