"""Language identification by cross-parsing entropy.

Per language a suffix automaton is built over a bounded sample of labelled texts. Another text is parsed
greedily into the longest pieces that occur in the sample; each piece costs a pointer into the sample,
log2 of its size in bits. The language with the fewest bits per byte wins.

The automaton accepts exactly the substrings of the sample, so the longest match is found by following
transitions until none is left; the next piece starts with the byte that did not fit. As a complete
table this is one lookup per byte, done for many pieces of text at once. Texts are parsed in segments of
`SEGMENT` bytes so that a very long text is many lanes, not one long loop; no byte is left out.

Defined results: a NULL text, or one without a letter, is `und` with score 0; so is every text if nothing is
labelled. Equal entropies go to the first language in order. Repeated rows keep a row each, and
only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of labelled text per language, and of all languages together: the bound of the sample.
SAMPLE_BYTES = 48_000
ALL_SAMPLES = 2_000_000
#: Different texts per language among which the sample is chosen, by a hash of their text.
SAMPLE_ROWS = 400
#: Languages above which labels are taken for something else.
MOST_LANGUAGES = 1_000
SEGMENT = 1024
#: Bytes of text parsed at once.
AT_ONCE = 4_000_000
LETTER = r"\p{L}"
SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def parsed_bytes(text: str) -> bytes:
    """What is parsed: lower case, every run of ASCII characters that are no letters as one space."""
    return b" ".join(text.lower().encode().translate(SPACED).split())


def suffix_automaton(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Transitions (from, byte, to) of the automaton of all substrings within single texts, and its states.

    State 0 is the start; states are numbered by the length of their longest substring.
    """
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    for text in texts:
        last = 0  # substrings do not run on from one text into the next
        for byte in text:
            if byte in follow[last]:
                there = follow[last][byte]
                if length[there] == length[last] + 1:
                    last = there
                    continue
                last = _split(follow, link, length, last, there, byte)
                continue
            new = len(follow)
            follow.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and byte not in follow[at]:
                follow[at][byte] = new
                at = link[at]
            if at >= 0:
                there = follow[at][byte]
                link[new] = there if length[there] == length[at] + 1 else _split(follow, link, length, at, there, byte)
            last = new
    order = np.argsort(np.array(length), kind="stable")
    renamed = np.empty(len(order), dtype=np.int32)
    renamed[order] = np.arange(len(order), dtype=np.int32)
    edges = [(state, byte, to) for state, out in enumerate(follow) for byte, to in out.items()]
    source, label, target = (np.array(column, dtype=np.int32) for column in zip(*edges)) if edges else (np.zeros(0, np.int32),) * 3
    return renamed[source], label.astype(np.uint8), renamed[target], len(follow)


def _split(follow, link, length, at, there, byte) -> int:
    """A copy of `there` for the shorter substrings that end in it."""
    copy = len(follow)
    follow.append(dict(follow[there]))
    link.append(link[there])
    length.append(length[at] + 1)
    while at >= 0 and follow[at].get(byte) == there:
        follow[at][byte] = copy
        at = link[at]
    link[there] = copy
    return copy


def parse_table(source: np.ndarray, label: np.ndarray, target: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray]:
    """The complete table and the class of each byte.

    Entry (state, class) is twice the row offset of the next state, plus 1 where a new piece begins.
    Class 0 is every byte that the sample lacks: a piece by itself.
    """
    classes = np.zeros(256, dtype=np.uint8)
    used = np.unique(label)
    classes[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    start = np.zeros(width, dtype=np.int32)
    first = source == 0
    start[classes[label[first]]] = target[first]
    table = np.broadcast_to(start * (2 * width) + 1, (states, width)).astype(np.int32)
    inside = ~first
    table[source[inside], classes[label[inside]]] = target[inside] * (2 * width)
    return table.reshape(-1), classes


@lru_cache(maxsize=1)
def _tables(models):
    """The tables of the broadcast models, made once per worker."""
    return [(lang, math.log2(max(2, size)), *parse_table(*edges)) for lang, size, edges in models.value]


def count_pieces(segments: list[np.ndarray], tables) -> np.ndarray:
    """Pieces of every segment (at most SEGMENT bytes each) by every table."""
    lengths = np.array([len(s) for s in segments])
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max())
    grid = np.zeros((longest, len(segments)), dtype=np.uint8)
    for lane, at in enumerate(order):
        grid[: lengths[at], lane] = segments[at]
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    counts = np.empty((len(segments), len(tables)), dtype=np.int64)
    for column, (table, classes) in enumerate(tables):
        coded = classes[grid].astype(np.int32)
        state = np.zeros(len(segments), dtype=np.int32)
        pieces = np.zeros(len(segments), dtype=np.int32)
        for step in range(longest):
            n = active[step]
            found = table.take((state[:n] >> 1) + coded[step, :n])
            state[:n] = found
            pieces[:n] += found & 1
        counts[order, column] = pieces
    return counts


def entropies(texts: list[bytes], models) -> np.ndarray:
    """Bits per byte of every non-empty text under every model (language, log2 size, table, classes)."""
    tables = [(table, classes) for _, _, table, classes in models]
    owner, segments = [], []
    for at, text in enumerate(texts):
        whole = np.frombuffer(text, np.uint8)
        for begin in range(0, len(whole), SEGMENT):
            owner.append(at)
            segments.append(whole[begin : begin + SEGMENT])
    pieces = np.zeros((len(texts), len(models)))
    np.add.at(pieces, np.array(owner), count_pieces(segments, tables))
    bits = np.array([model[1] for model in models])
    return pieces * bits / np.array([len(t) for t in texts])[:, None]


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, int, tuple]]:
    """(language, sample bytes, transitions) per language: a model of bounded size.

    The sample is chosen by a hash of the text: about SAMPLE_ROWS different texts per language, all if there are
    fewer, of these whole texts in hash order as long as they fit into the bytes allowed. Copies count once.
    """
    known = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(LETTER)
    )
    place = F.xxhash64("text")
    different = known.select("lang", place.alias("place")).distinct()
    counts = {row["lang"]: row["count"] for row in different.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different languages are labelled")
    if not counts:
        return []
    allowed = min(SAMPLE_BYTES, ALL_SAMPLES // len(counts))
    share = F.create_map(*[F.lit(x) for one, n in counts.items() for x in (one, min(1.0, SAMPLE_ROWS / n))])
    chosen = known.filter(F.pmod(place, F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)
    # Copies end before the shuffle, so that a group is as large as its different texts.
    chosen = chosen.select("lang", "text").distinct().withColumn("place", place)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        texts, room = [], allowed
        candidates = [parsed_bytes(t) for t in rows.sort_values(["place", "text"])["text"]]
        for one in candidates:
            if len(one) <= room:
                texts.append(one)
                room -= len(one)
        texts = texts or [min(candidates, key=len)[:allowed]]
        source, label, target, states = suffix_automaton(texts)
        return pd.DataFrame(
            {"lang": [rows["lang"].iloc[0]], "size": [sum(map(len, texts))], "states": [states], "source": [source.tobytes()],
             "label": [label.tobytes()], "target": [target.tobytes()]}
        )

    ddl = "lang string, size bigint, states int, source binary, label binary, target binary"
    rows = chosen.groupBy("lang").applyInPandas(build, ddl).collect()
    return [
        (r.lang, r.size, (np.frombuffer(r.source, np.int32), np.frombuffer(r.label, np.uint8), np.frombuffer(r.target, np.int32), r.states))
        for r in sorted(rows, key=lambda r: r.lang)
    ]


def identify(docs: DataFrame, models: list, text: str = "text") -> DataFrame:
    """The rows with `lang_pred` and `score`: the entropy of the second best over the sum of the best two."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(models)
    names = docs.columns
    clash = {"lang_pred", "score"} & set(names)
    if clash:
        docs = docs.drop(*clash)
        names = docs.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = regex.compile(LETTER)
        tables = _tables(shared)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if t and tables and letter.search(t)]
            begin = 0
            while begin < len(known):
                group, size = [], 0
                while begin < len(known) and size < AT_ONCE:
                    group.append(known[begin])
                    size += len(texts[known[begin]])
                    begin += 1
                bits = entropies([parsed_bytes(texts[i]) for i in group], tables)
                ranked = np.sort(bits, axis=1)
                for i, best, low in zip(group, np.argmin(bits, axis=1), ranked):
                    langs[i] = tables[best][0]
                    scores[i] = 1.0 if len(low) == 1 else float(low[1] / (low[0] + low[1]))
            kept = [batch.column(name) for name in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*rest, "lang_pred", "score"])

    rest = [name for name in names if name != text]
    schema = docs.drop(text).schema.add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(predict, schema)
