"""Operators 6 and 7 against the libraries."""

from __future__ import annotations

import gc
import hashlib
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from sensorloom.llm import bpe, queries, token_counts, words

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["the", " there's", "  ", "\n\n", "I'll", "ünï", "Ԁ֘₏", "😀", "12345", " !!", "<|endoftext|>", "日本語", "'s", "\t", "՘ab", "a" * 50]


@pytest.fixture(scope="module")
def mixed(make):
    rng = random.Random(6)
    rows = [(n, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))) for n in range(300)]
    return dict(rows), make(rows).repartition(3)


def test_encoding_equals_the_library(monkeypatch, mixed):
    monkeypatch.setattr(words, "BLOCK_CHARS", 500)  # several blocks
    texts, docs = mixed
    library: tiktoken.Encoding = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    rows = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id]) and r.text == texts[r.doc_id] and r.n_tokens == len(r.ids)
    packed = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: bpe.unpack_ids(r.ids) for r in packed} == {r.doc_id: list(r.ids) for r in rows}


def test_decoding_joins_the_token_table(spark, mixed):
    texts, docs = mixed
    encoded = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).select("doc_id", "ids")
    assert {r.doc_id: r.text for r in bpe.decode(encoded, RANKS).collect()} == texts
    unknown = spark.createDataFrame([(1, [70000])], "doc_id bigint, ids array<int>")
    with pytest.raises(Exception, match="no token has id 70000"):
        bpe.decode(unknown, RANKS).collect()


def test_digests(spark):
    folder = "/root/testdata/sf0.001"
    library = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in queries.documents(spark, folder).collect()}
    for r in queries.op6_bpe(spark, folder).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_counts_equal_the_library(monkeypatch, mixed):
    monkeypatch.setattr(words, "BLOCK_CHARS", 500)
    texts, docs = mixed
    library = Tokenizer.from_file(JSON)
    rows = token_counts.count_tokens(docs, JSON, limit=40).collect()
    assert len(rows) == len(texts)
    for r in rows:
        count = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (count, len(texts[r.doc_id].encode()), count > 40)


def test_odd_rows_and_no_rows(odd, none):
    rows = bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == 10 and sorted(r.n_tokens for r in rows if r.doc_id in (2, 3)) == [0, 0]
    counts = token_counts.count_tokens(odd, JSON).collect()
    assert sorted(r.n_tokens for r in counts) == sorted(r.n_tokens for r in rows)
    assert sum(r.over_limit for r in counts) == 1 and sum(r.doc_id is None for r in counts) == 1
    assert bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).collect() == []
    assert token_counts.count_tokens(none, JSON).collect() == []


def test_packing():
    values = [b"", b"abc", b"\x00" * 10]
    assert words.cut_bytes(words.join_bytes(values)) == values and words.cut_bytes(words.join_bytes([])) == []


def test_a_block_frees_its_pre_tokens():
    class Piece(str):
        """A string that can be watched."""

    piece = Piece("a")
    seen, known = weakref.ref(piece), words._numbered()
    gc.disable()
    try:
        assert known[piece] == 0
        del piece, known
        assert seen() is None
    finally:
        gc.enable()


def test_pre_tokens_of_a_block_are_ordered_by_share_and_word():
    known = words._numbered()
    asked = [f"{n * 37 % 101}é" for n in range(300)]
    indices = [known[one] for one in asked]
    block = words._block(5, [1], known, [b""], [0], 4)
    order = np.frombuffer(words.decompress(block["order"]), "<u4").tolist()
    dealt = [(pack["share"], word) for pack in block["packs"] for word in words.cut_bytes(pack["words"])]
    assert dealt == sorted({(zlib.crc32(one.encode()) % 4, one.encode()) for one in asked})
    back = dict(zip(order, (word.decode() for _, word in dealt)))
    assert [back[i] for i in indices] == asked


def test_numbers_and_names_of_ids(tmp_path):
    known = words._numbered()
    assert [known[p] for p in ("b", "a", "b", "c")] == [0, 1, 0, 2] and list(known) == ["b", "a", "c"]
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    assert bpe.id_names(str(path)) == [b"0", b"1", b"2"]
    # Texts without a rare character are cut as they are.
    assert bpe.cut("né 12 ok", regex.compile(r"\p{L}+|\p{N}+|\s")) == ["né", " ", "12", " ", "ok"]
