"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

Segments of a file (lines, paragraphs, the whole text) and licence templates are sparse vectors of words,
weighted by how rare a word is among all files, whether a template has it or not. A
file's own licence is the template closest to any of its segments, if the cosine reaches the threshold.
No segment can come closer than the share of a template's length that lies on words of the file
(Cauchy-Schwarz), so files below that bound need no segment scored: an exact saving. What a segment shares with the
templates is known where it is read; its other words weigh at least 1 each, and only the segments that could still
reach the threshold are joined to the document frequencies of their other words.

A file that is a licence file by its name, or because its whole text is close to a template, speaks for its
directory. A file without a licence of its own takes that of the nearest directory above it: directories
are joined to their ancestors by path, and files to directories.

Defined results: NULL or empty texts have no licence of their own; files without a path inherit
nothing; of equal cosines the first template by name wins, of several licence files in a directory the
closest one, then the first by licence name; repeated rows keep a row each; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import written

# Licence names and the wording of their usual notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|notice)(\.[a-z]+)?$"
#: Cosines from which a segment has a licence, and a whole text is a licence file.
SEGMENT_COSINE = 0.75
FILE_COSINE = 0.5
#: Different words that a task counts before it passes its counts on.
HELD_WORDS = 200_000

MARKS = ".,;:()[]{}<>\"'*#/!?%&$|-"


def terms(text: str) -> list[str]:
    """Words in lower case without the marks around them."""
    return [word for word in (part.strip(MARKS) for part in text.lower().split()) if word]


class Weights:
    """Vectors of the templates under the document frequencies of their words."""

    def __init__(self, templates: dict[str, tuple[str, ...]], files: int, seen: dict[str, int]):
        self.files, self.seen = files, seen
        self.words: set[str] = set()
        self.vectors: list[tuple[str, dict[str, float]]] = []
        for name, texts in sorted(templates.items()):
            for text in texts:
                counts = Counter(terms(text))
                self.words |= counts.keys()
                vector = {word: times * self.idf(word) for word, times in counts.items()}
                length = math.sqrt(sum(v * v for v in vector.values()))
                self.vectors.append((name, {word: v / length for word, v in vector.items()}))

    def idf(self, word: str) -> float:
        """At least 1."""
        return math.log((1 + self.files) / (1 + self.seen.get(word, 0))) + 1

    def bound(self, words: set[str]) -> float:
        """No segment made of these words comes closer to a template."""
        known = words & self.words
        return max((math.sqrt(sum(v * v for word, v in vector.items() if word in known)) for _, vector in self.vectors), default=0.0)

    def shared(self, counts: dict[str, int]) -> tuple[float, str | None, float]:
        """The product with the closest template, its name, and the squared length on words of the templates."""
        weights = {word: times * self.idf(word) for word, times in counts.items() if word in self.words}
        best: tuple[float, str | None] = (0.0, None)
        for name, vector in self.vectors:
            product = sum(v * vector[word] for word, v in weights.items() if word in vector)
            if product > best[0] * (1 + 1e-12):
                best = (product, name)
        return (*best, sum(v * v for v in weights.values()))

    def closest(self, segment: str) -> tuple[float, str | None]:
        """The cosine of the closest template and its name, if `seen` has all words."""
        counts = Counter(terms(segment))
        product, name, known = self.shared(counts)
        others = sum((times * self.idf(word)) ** 2 for word, times in counts.items() if word not in self.words)
        return (product / math.sqrt(known + others), name) if name else (0.0, None)


def segments(text: str) -> Iterator[str]:
    """Lines, paragraphs of several lines, and the whole text."""
    lines = text.split("\n")
    yield from lines
    if len(lines) > 1:
        for paragraph in re.split(r"\n\s*\n", text):
            if "\n" in paragraph:
                yield paragraph
        yield text


def document_frequencies(files: DataFrame, text: str) -> DataFrame:
    """word, files: the files with each word, and all files as those with the empty word."""

    def summed(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "files"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for one in batch.column("text").to_pylist():
                seen.update({part.strip(MARKS) for part in set(one.lower().split())} | {""})
                if len(seen) > HELD_WORDS:
                    yield summed(seen)
                    seen.clear()
        yield summed(seen)

    rows = files.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(count, "word string, files bigint")
    return rows.groupBy("word").agg(F.sum("files").alias("files"))


def weights_of(frequencies: DataFrame, templates: dict[str, tuple[str, ...]]) -> Weights:
    """The templates under the document frequencies: only those of their words are collected."""
    vocabulary = sorted({word for texts in templates.values() for one in texts for word in terms(one)})
    seen = {r["word"]: r["files"] for r in frequencies.filter(F.col("word").isin(["", *vocabulary])).collect()}
    return Weights(templates, seen.pop("", 0), seen)


OTHERS = T.ArrayType(T.StructType().add("word", "string").add("times", "integer"))
SEGMENTS = T.ArrayType(T.StructType().add("at", "integer").add("licence", "string").add("product", "double").add("known", "double").add("others", OTHERS))
SEGMENTS_ARROW = pa.list_(
    pa.struct(
        [("at", pa.int32()), ("licence", pa.string()), ("product", pa.float64()), ("known", pa.float64()),
         ("others", pa.list_(pa.struct([("word", pa.string()), ("times", pa.int32())])))]
    )
)


def possible_segments(one: str, weights: Weights) -> list[dict]:
    """The segments that reach their threshold if their other words weigh 1 each; the whole text as number 0."""
    bound = weights.bound({part.strip(MARKS) for part in set(one.lower().split())})
    tried = [(0, one, FILE_COSINE)] if bound >= min(SEGMENT_COSINE, FILE_COSINE) else []
    if bound >= SEGMENT_COSINE:
        tried += [(at, segment, SEGMENT_COSINE) for at, segment in enumerate(segments(one), 1)]
    found = []
    for at, segment, least in tried:
        counts = Counter(terms(segment))
        product, name, known = weights.shared(counts)
        others = {word: times for word, times in counts.items() if word not in weights.words}
        if name and product >= (least - 1e-9) * math.sqrt(known + sum(times * times for times in others.values())):
            words = [{"word": word, "times": times} for word, times in others.items()]
            found.append({"at": at, "licence": name, "product": product, "known": known, "others": words})
    return found


def own_licences(files: DataFrame, weights: Weights, frequencies: DataFrame, text: str = "text") -> DataFrame:
    """The rows without the text, with `licence`, `cosine` and `file_cosine` of the whole text."""
    rest = [name for name in files.columns if name not in (text, "licence", "cosine", "file_cosine", "file_licence", "_segments", "_row")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [possible_segments(one or "", weights) for one in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), pa.array(found, SEGMENTS_ARROW)], [*rest, "_segments"])

    schema = T.StructType([files.schema[name] for name in rest]).add("_segments", SEGMENTS)
    rows = files.select(*rest, text).mapInArrow(search, schema).withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "licence-segments")
    found = rows.select("_row", F.explode("_segments").alias("segment")).select("_row", "segment.*")
    words = found.select("_row", "at", F.explode("others").alias("other")).select("_row", "at", "other.word", "other.times")
    weight = F.col("times") * (F.log((1.0 + weights.files) / (1.0 + F.col("files"))) + 1.0)
    # Summed in order of size, so that the sum does not depend on the order of rows.
    others = F.aggregate(F.array_sort(F.collect_list(weight * weight)), F.lit(0.0), lambda total, one: total + one)
    lengths = words.join(frequencies, "word").groupBy("_row", "at").agg(others.alias("others"))
    cosine = F.col("product") / F.sqrt(F.col("known") + F.coalesce(F.col("_others"), F.lit(0.0)))
    scored = found.drop("others").join(lengths.withColumnRenamed("others", "_others"), ["_row", "at"], "left").withColumn("cosine", cosine)
    # Of equal cosines the first segment.
    own = F.when((F.col("at") > 0) & (F.col("cosine") >= SEGMENT_COSINE), F.struct((-F.round("cosine", 12)).alias("order"), "at", "cosine", "licence"))
    whole = F.when(F.col("at") == 0, F.struct("cosine", "licence"))
    best = scored.groupBy("_row").agg(F.min(own).alias("_own"), F.max(whole).alias("_whole"))
    return rows.join(best, "_row", "left").select(
        *rest,
        F.coalesce("_own.cosine", F.lit(0.0)).alias("cosine"),
        F.col("_own.licence").alias("licence"),
        F.coalesce("_whole.cosine", F.lit(0.0)).alias("file_cosine"),
        F.col("_whole.licence").alias("file_licence"),
    )


def directory(path: Column) -> Column:
    """The directory of a path, empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(files: DataFrame, path: str) -> DataFrame:
    """dir, inherited, inherited_from: for every directory the licence of the nearest one that has any."""
    named = F.regexp_extract(path, "([^/]*)$", 1).rlike(LICENCE_NAME)
    speaks = F.when(named & F.col("licence").isNotNull(), F.struct("cosine", "licence")).when(
        F.col("file_cosine") >= FILE_COSINE, F.struct(F.col("file_cosine").alias("cosine"), F.col("file_licence").alias("licence"))
    )
    placed = files.filter(F.col(path).isNotNull()).select(directory(F.col(path)).alias("dir"), speaks.alias("speaks"))
    # The closest licence file of a directory: the largest cosine, then the first name.
    first = F.min(F.struct((-F.col("speaks.cosine")).alias("cosine"), F.col("speaks.licence").alias("licence")))
    declared = placed.filter("speaks IS NOT NULL").groupBy("dir").agg(first.alias("best"))
    declared = written(declared.select(F.col("dir").alias("above"), F.col("best.licence").alias("licence")), "declared")
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    above = F.transform(F.sequence(F.lit(0), depth), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    directories = placed.select("dir").distinct().select("dir", F.explode(above).alias("up")).select("dir", "up.depth", "up.above")
    met = directories.join(declared, "above")
    return met.groupBy("dir").agg(F.max_by("licence", "depth").alias("inherited"), F.max_by("above", "depth").alias("inherited_from"))


def scan(files: DataFrame, path: str = "path", text: str = "text", templates=None) -> DataFrame:
    """The rows without the text, with `licence`, `cosine`, `inherited`, `inherited_from` and `effective`."""
    frequencies = written(document_frequencies(files, text), "document-frequencies")
    weights = weights_of(frequencies, TEMPLATES if templates is None else templates)
    own = written(own_licences(files, weights, frequencies, text), "own-licences")
    near = written(inherited(own, path), "inherited").withColumnRenamed("dir", "_dir")
    rest = [name for name in own.columns if name not in ("inherited", "inherited_from", "effective", "file_cosine", "file_licence")]
    met = own.select(*rest, directory(F.col(path)).alias("_own")).join(near, F.col("_own") == F.col("_dir"), "left")
    return met.select(*rest, "inherited", "inherited_from", F.coalesce("licence", "inherited").alias("effective"))
