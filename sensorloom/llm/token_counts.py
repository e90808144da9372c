"""Token counts of a tokenizer file, without making ids.

A document is its frequencies of distinct pre-tokens. Every distinct pre-token of the corpus is counted
in pieces once, the counts are joined to the frequencies and summed.

Special strings of the tokenizer (`<|endoftext|>`) are one piece each, as the library takes them by
default. Defined results: a NULL text is the empty text with 0 tokens; repeated rows keep a row each;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from sensorloom.llm import words

# Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below this character all Unicode versions agree on letters, digits and space.
SETTLED = "Ԁ"


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def special_strings(path: str) -> tuple[str, ...]:
    """The added tokens; this counter handles those matched as they stand."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    kind = given.get("pre_tokenizer") or {}
    if given.get("normalizer") or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space"):
        raise ValueError("only byte-level tokenizers without normalizer and prefix space are counted")
    added = given.get("added_tokens", [])
    if any(one["lstrip"] or one["rstrip"] or one["single_word"] or one["normalized"] for one in added):
        raise ValueError("added tokens that strip, normalise or need word ends are not counted")
    return tuple(one["content"] for one in added)


@lru_cache(maxsize=2)
def cutter(path: str):
    """text -> pre-tokens, special strings among them."""
    common = regex.compile(PATTERN)
    rare = regex.compile(f"[{SETTLED}-\U0010ffff]")
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    specials = special_strings(path)
    split = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None

    def plain(text: str) -> list[str]:
        if rare.search(text):
            # The library's own cut, which follows its own version of Unicode.
            return [text[a:b] for _, (a, b) in level.pre_tokenize_str(text)]
        return common.findall(text)

    def cut(text: str) -> list[str]:
        if split is None or not any(one in text for one in specials):
            return plain(text)
        out: list[str] = []
        for at, part in enumerate(split.split(text)):
            out += [part] if at % 2 else plain(part)
        return out

    return cut


def pack_frequencies(indices: np.ndarray) -> bytes:
    """Distinct indices and how often each comes, as one packed list."""
    distinct, times = np.unique(indices, return_counts=True)
    steps = np.diff(distinct.astype(np.int64), prepend=0)
    return words.pack_indices(np.concatenate([steps, times]))


def unpack_frequencies(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = words.unpack_indices(packed).astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit."""

    def cut(one: str) -> list[str]:
        return cutter(path)(one)

    def answer(distinct: list[str]) -> list[bytes]:
        counts = [len(one.ids) for one in tokenizer(path).encode_batch(distinct, add_special_tokens=False)]
        return [np.uint32(one).tobytes() for one in counts]

    def total(keys, kept, extra, answers):
        pieces = np.frombuffer(b"".join(answers), "<u4").astype(np.int64)
        sums = []
        for packed in kept:
            distinct, times = unpack_frequencies(packed)
            sums.append(int(pieces[distinct] @ times))
        return pd.DataFrame({"key": keys, "n_bytes": extra, "n_tokens": sums})

    kind = docs.schema[key].dataType.simpleString()
    stored = words.blocks(docs, key, text, cut, pack_frequencies, lambda one: len(one.encode()))
    counted = words.rejoined(stored, words.answered(stored, answer), total, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumns({"over_limit": F.col("n_tokens") > limit}).withColumnRenamed("key", key)
