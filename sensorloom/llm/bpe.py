"""Byte-level BPE encoding and decoding.

Pre-tokens with their positions are kept per block, every distinct pre-token of the corpus is encoded
once, the ids are joined back and each document's ids are put together by position. Decoding joins
the ids to the token-byte table, a fixed table of the vocabulary.

Defined results: a NULL text is the empty text, which has no ids; repeated rows and repeated keys
keep a row each; an empty table gives an empty result; only the named columns are read. The pattern may use
the classes of letters, numbers and white space, and must match every character.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import words

#: Bytes of a vocabulary file above which it is not sent to the tasks.
VOCABULARY_BYTES = 64 << 20
#: From here on versions of Unicode differ in what is a letter.
RARE = regex.compile("[\u0500-\U0010ffff]")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """token bytes -> rank, from the lines of a rank file."""
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary has {len(data)} bytes, more than {VOCABULARY_BYTES}")
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The vocabulary of a file, loaded once per worker."""
    with open(path, "rb") as file:
        return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=read_ranks(file.read()), special_tokens={})


@lru_cache(maxsize=1)
def _class_probes() -> list[tuple[tiktoken.Encoding, str]]:
    """Encodings that find only letters, only numbers or only white space, each with one that stands for all."""
    ranks = {bytes([b]): b for b in range(256)}
    kinds = ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", "\t"))
    return [(tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=ranks, special_tokens={}), one) for kind, one in kinds]


def stand_ins(characters: set[str]) -> dict[int, str]:
    """For each character one of its class that all versions of Unicode agree on, as the library sees it."""
    found = {ord(c): "!" for c in characters}
    text = "".join(sorted(characters))
    for probe, one in _class_probes():
        found |= {ord(c): one for c in bytes(probe.encode_ordinary(text)).decode()}
    return found


def cut(text: str, pattern: regex.Pattern) -> list[str]:
    """The pre-tokens of a text; rare characters are cut by their class in the library's own Unicode."""
    if text.isascii() or not RARE.search(text):
        return pattern.findall(text)
    rare = set(RARE.findall(text))
    pieces, at = [], 0
    for piece in pattern.findall(text.translate(stand_ins(rare))):
        pieces.append(text[at : at + len(piece)])
        at += len(piece)
    return pieces


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The token-byte table: the bytes of every id."""
    with open(path, "rb") as file:
        ranks = read_ranks(file.read())
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


@lru_cache(maxsize=2)
def id_names(path: str) -> list[bytes]:
    """The decimal text of every id."""
    return [str(i).encode() for i in range(len(token_bytes(path)))]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids: the ids of every text as packed 32-bit integers (`unpack_ids`)."""

    def result(keys, ids, _texts):
        return {"key": keys, "ids": [one.astype("<u4").tobytes() for one in ids]}

    kind = docs.schema[key].dataType.simpleString()
    out = _encoded(docs, path, pattern, key, text, result, f"key {kind}, ids binary")
    return out.withColumnRenamed("key", key)


def encode_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: encoded, decoded again, and digested."""

    def result(keys, ids, decoded):
        names = id_names(path)
        listed = [b" ".join(map(names.__getitem__, one.tolist())) for one in ids]
        return {
            "key": keys,
            "n_tokens": [len(one) for one in ids],
            "ids_sha256": [hashlib.sha256(one).hexdigest() for one in listed],
            "decoded_sha256": [hashlib.sha256(one).hexdigest() for one in decoded],
        }

    kind = docs.schema[key].dataType.simpleString()
    ddl = f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _encoded(docs, path, pattern, key, text, result, ddl).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids, text: the ids as an array and the text that they decode to."""

    def result(keys, ids, decoded):
        return {
            "key": keys,
            "n_tokens": [len(one) for one in ids],
            "ids": [one.astype(np.int32) for one in ids],
            "text": [one.decode() for one in decoded],
        }

    kind = docs.schema[key].dataType.simpleString()
    ddl = f"key {kind}, n_tokens bigint, ids array<int>, text string"
    return _encoded(docs, path, pattern, key, text, result, ddl).withColumnRenamed("key", key)


def _encoded(docs: DataFrame, path: str, pattern: str, key: str, text: str, result, ddl: str) -> DataFrame:
    compiled = regex.compile(pattern)

    def answer(distinct: list[str]) -> list[bytes]:
        encoder = encoding(path, pattern)._core_bpe
        return [np.array(encoder.encode_single_piece(word.encode()), dtype="<u4").tobytes() for word in distinct]

    def assemble(keys, kept, _extra, answers):
        table = token_bytes(path)
        lengths = np.fromiter((len(one) // 4 for one in answers), dtype=np.int64, count=len(answers))
        ids, decoded = [], []
        for packed in kept:
            places = words.unpack_indices(packed)
            one = np.frombuffer(b"".join(map(answers.__getitem__, places.tolist())), "<u4")
            if len(one) != int(lengths[places].sum()):
                raise ValueError("ids are missing for a pre-token")
            ids.append(one)
            decoded.append(b"".join(map(table.__getitem__, one.tolist())))
        return pd.DataFrame(result(keys, ids, decoded))

    stored = words.blocks(docs, key, text, lambda one: cut(one, compiled), words.pack_indices, lambda _: 0)
    return words.rejoined(stored, words.answered(stored, answer), assemble, ddl)


def unpack_ids(packed: bytes) -> list[int]:
    """The ids of `encode_documents`."""
    return np.frombuffer(packed, "<u4").tolist()


def token_table(spark, path: str) -> DataFrame:
    """The token-byte table as rows id, token."""
    with open(path, "rb") as file:
        rows = [(rank, bytearray(token)) for token, rank in read_ranks(file.read()).items()]
    return spark.createDataFrame(rows, "id int, token binary")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text: arrays of ids joined to the token-byte table and put together by position.

    Ids that the table lacks are an error. A key stands for one row.
    """
    pieces = encoded.select(F.col(key).alias("_key"), F.posexplode_outer(ids).alias("_at", "id"))
    met = pieces.join(F.broadcast(token_table(encoded.sparkSession, path)), "id", "left")
    missing = F.raise_error(F.concat(F.lit("no token has id "), F.col("id").cast("string")))
    token = F.when(F.col("id").isNull(), F.lit(b"")).otherwise(F.coalesce("token", missing.cast("binary")))
    gathered = met.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_at", token.alias("token")))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda out, part: F.concat(out, part["token"]))
    return gathered.select(F.col("_key").alias(key), F.decode(whole, "UTF-8").alias("text"))
