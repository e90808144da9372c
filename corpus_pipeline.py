"""A corpus pipeline in stages, each written as Parquet and read again as the next one's documents.

1. quality: documents that the quality classifier rejects go. It learns from the labels of the
   documents at hand; without labels nothing is rejected.
2. near duplicates: of every component of 5-word shingle sets that are 80 % alike, the document with the
   smallest id stays. Documents without a word, and rows without an id, stay. Of rows that repeat an id, that
   with the least hash of its text is the document, and the others go.
3. decontamination: documents in which a benchmark item occurs go.
4. secrets: every document stays, its secrets replaced by a mark; `n_chars` follows.
5. encoding: every document with its token ids, and the text that they decode to.

All stages but the last return the columns of documents, whatever others there are besides.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import bpe, decontaminate, jaccard, quality, secrets
from sensorloom.llm.common import documents, written
from sensorloom.llm.membership import passing
from sensorloom.operators.dedup import keep_first

WORDS = 5
PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; only labelled ones are measured to fit it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("known"))
    learned = passing(docs.select("doc_id", "text"), F.col("doc_id"), known)
    model = quality.fit(written(quality.labelled(quality.measured(learned), labels), "labelled"))
    return quality.accepted(docs, model)


def one_row_an_id(docs: DataFrame) -> DataFrame:
    """Of rows that repeat an id, the one whose text has the least SHA-256, NULL first; rows without an id all stay."""
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = written(repeated, "repeated")
    # Only ids that repeat need a choice among their rows.
    single = docs.join(repeated, "doc_id", "left_anti").select(docs.columns)
    several = docs.join(repeated, "doc_id", "left_semi").select(docs.columns)
    return single.unionByName(keep_first(several, ["doc_id"], [F.sha2("text", 256)]))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every component; of rows that repeat an id, the first by text."""
    docs = one_row_an_id(docs)
    groups = jaccard.join(docs.select("doc_id", "text"), WORDS, PERCENT)
    others = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    others = written(others, "others")
    return docs.join(others, F.col("doc_id") == F.col("_gone"), "left_anti")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    found = secrets.scan(docs.withColumnsRenamed({c: f"_doc_{c}" for c in docs.columns}), text="_doc_text")
    text = secrets.redacted(F.col("_doc_text"), F.col("spans"))
    secret = F.size("spans") > 0
    changed = {"text": text, "n_chars": F.when(secret, F.length(text).cast("bigint")).otherwise(F.col("_doc_n_chars"))}
    return found.select([changed.get(c, F.col(f"_doc_{c}")).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("encoding", encode),
]
# Scores, links and encodings are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
