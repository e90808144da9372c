"""Distinct pre-tokens, shared by the encoder and the token counter.

Texts are cut into pre-tokens block by block: a block is some whole documents of one input partition,
at least `BLOCK_CHARS` characters of them. A block keeps its distinct pre-tokens once and, per
document, a packed list that refers to them, so that what is shuffled is a block's distinct
pre-tokens and not every occurrence. They are dealt out by a hash of the pre-token, each distinct
one of the whole corpus is worked on once, and the answers go back to the blocks.

The blocks are a table bucketed by block number: the answers are brought to it, it does not move again.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sensorloom.llm.common import partitions, whole_text
from sensorloom.session import scratch_path

BLOCK_CHARS = 12_000_000
#: Bytes of packed indices whose documents are answered together, about a sixteenth of a block.
KEPT_AT_ONCE = 250_000

#: Cuts a text into pre-tokens.
Cut = Callable[[str], list[str]]
#: Packs the indices (into the block's pre-tokens) of one document.
Keep = Callable[[np.ndarray], bytes]
#: Answers distinct pre-tokens, one bytes value each.
Answer = Callable[[list[str]], list[bytes]]


def compress(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def decompress(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def join_bytes(parts: list[bytes]) -> bytes:
    """Several values as one: their lengths, then the values, compressed."""
    lengths = np.fromiter(map(len, parts), dtype="<u4", count=len(parts))
    return compress(np.uint32(len(parts)).tobytes() + lengths.tobytes() + b"".join(parts))


def cut_bytes(packed: bytes) -> list[bytes]:
    """The values of `join_bytes`."""
    raw = decompress(packed)
    count = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = 4 + 4 * count + np.cumsum(np.frombuffer(raw, "<u4", count, 4), dtype=np.int64)
    ends = ends.tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * count, *ends], ends)]


def pack_indices(indices: np.ndarray) -> bytes:
    """Indices by byte planes, which compress better than whole numbers."""
    planes = np.ascontiguousarray(indices.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return compress(planes.tobytes())


def unpack_indices(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _numbered() -> dict[str, int]:
    """Pre-tokens that are numbered as they are first asked for.

    Nothing in it refers to it, so that its memory is free with the block and does not wait for the cycle collector.
    """
    return defaultdict(itertools.count().__next__)


def _block(number: int, keys: list, vocabulary: dict, kept: list[bytes], extra: list[int], dealt: int) -> dict:
    """A row: the documents with their packed indices, the pre-tokens sorted into shares by their hash."""
    words = [word.encode() for word in vocabulary]
    share = np.fromiter((zlib.crc32(word) % dealt for word in words), dtype=np.int64, count=len(words))
    # Sorted inside a share, which compresses best.
    order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
    order = order[np.argsort(share[order], kind="stable")]
    bounds = np.searchsorted(share[order], np.arange(dealt + 1))
    packs = []
    for number_of_share in range(dealt):
        chosen = order[bounds[number_of_share] : bounds[number_of_share + 1]]
        if len(chosen):
            packs.append({"share": number_of_share, "words": join_bytes([words[i] for i in chosen])})
    return {"block": number, "keys": keys, "kept": kept, "extra": extra, "order": compress(order.astype("<u4").tobytes()), "packs": packs}


def blocks(docs: DataFrame, key: str, text: str, cut: Cut, keep: Keep, extra: Callable[[str], int]) -> DataFrame:
    """The bucketed table of blocks; `extra` is one number per document that the caller wants along."""
    dealt = partitions(docs)
    size = BLOCK_CHARS
    named = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    pack = T.StructType([T.StructField("share", T.IntegerType()), T.StructField("words", T.BinaryType())])
    row = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(named.schema["key"].dataType)),
            T.StructField("kept", T.ArrayType(T.BinaryType())),
            T.StructField("extra", T.ArrayType(T.LongType())),
            T.StructField("order", T.BinaryType()),
            T.StructField("packs", T.ArrayType(pack)),
        ]
    )
    schema = to_arrow_schema(row)

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        vocabulary, keys, kept, numbers, chars = _numbered(), [], [], [], 0

        def flush():
            row = _block(number, keys, vocabulary, kept, numbers, dealt)
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.column("text")[at].as_py()
                pieces = cut(one)
                indices = np.fromiter(map(vocabulary.__getitem__, pieces), dtype=np.uint32, count=len(pieces))
                keys.append(batch.column("key")[at].as_py())
                kept.append(keep(indices))
                numbers.append(extra(one))
                chars += len(one)
                if chars >= size:
                    done = flush()
                    number += 1
                    vocabulary, keys, kept, numbers, chars = _numbered(), [], [], [], 0
                    yield done
                    del done
        if keys:
            yield flush()

    found = named.mapInArrow(cut_batches, row)
    table = f"blocks_{uuid.uuid4().hex}"
    writer = found.write.bucketBy(dealt, "block").format("parquet").option("compression", "zstd")
    writer.option("path", scratch_path(docs.sparkSession, "blocks")).saveAsTable(table)
    return docs.sparkSession.table(table)


def answered(stored: DataFrame, answer: Answer) -> DataFrame:
    """Per block the answers of its pre-tokens: every distinct pre-token of a share is answered once."""

    def work(share: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        asked = []
        for packed in share["words"]:
            asked.append([known.setdefault(word, len(known)) for word in cut_bytes(packed)])
        answers = answer([word.decode() for word in known])
        packs = [join_bytes([answers[i] for i in indices]) for indices in asked]
        return pd.DataFrame({"block": share["block"], "share": share["share"], "answers": packs})

    packs = stored.select("block", F.explode("packs").alias("pack")).select("block", "pack.share", "pack.words")
    done = packs.groupBy("share").applyInPandas(work, "block bigint, share int, answers binary")
    # One row per block and share: bounded by the number of shares.
    return done.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("share", "answers"))).alias("answers"))


def _parts(kept: list[bytes]) -> Iterator[slice]:
    """Stretches of documents with about KEPT_AT_ONCE bytes of packed indices."""
    if not kept:
        return
    part = np.cumsum([len(one) for one in kept]) // KEPT_AT_ONCE
    bounds = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(kept)).tolist()
    yield from (slice(low, high) for low, high in zip(bounds[:-1], bounds[1:]))


def rejoined(stored: DataFrame, answers: DataFrame, work: Callable, result: str) -> DataFrame:
    """`work(keys, kept, extra, answers by index)` for a few documents of a block at a time, a frame of result rows each."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                order = np.frombuffer(decompress(row.order), "<u4")
                given = [one for pack in row.answers for one in cut_bytes(pack["answers"])]
                by_index: list[bytes] = [b""] * len(order)
                for place, value in zip(order.tolist(), given):
                    by_index[place] = value
                keys, kept, extra = list(row.keys), list(row.kept), list(row.extra)
                for some in _parts(kept):
                    yield work(keys[some], kept[some], extra[some], by_index)

    # A block of texts without any pre-token has no answers; it still has its documents.
    none = F.array().cast("array<struct<share:int,answers:binary>>")
    met = stored.drop("packs").join(answers, "block", "left").withColumn("answers", F.coalesce("answers", none))
    return met.mapInPandas(each, result)
