"""Personal data: exact patterns, and a linear-chain conditional random field that adds to them.

The field labels whitespace-separated tokens by their word shape and the shapes of their neighbours. It
is trained on a small labelled table of bounded size and decoded by Viterbi in numpy batches. A token at
which "outside" wins by more than any transition can give back is outside in every best labelling, so
the text falls into independent stretches and only those are decoded: an exact saving.

What the field finds beyond the patterns counts only if it holds as its kind (digits, Luhn, parts) and
does not touch a span of the patterns; those always stay.

Defined results: a NULL text is the empty text and has no spans; repeated rows keep a row each; an
empty table gives an empty result; without labelled windows nothing is added. Only the named columns
are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds in the order in which they are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-@")
DOTTED = re.compile(r"[0-9][0-9.]*")

TAGS = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))
#: Documents from which the labelled table is taken, its windows, and tokens on either side of a span.
SAMPLE_ROWS = 20_000
WINDOWS = 800
AROUND = 6
ROUNDS = 80
#: Characters decoded at once.
AT_ONCE = 4_000_000

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def holds(kind: str, text: str) -> bool:
    """Whether a string is of a kind by its digits and parts."""
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return EMAIL.fullmatch(text) is not None


def _email_runs(text: str) -> Iterator[tuple[int, str]]:
    """Maximal runs of e-mail characters around an @; a match never leaves its run."""
    at, done = text.find("@"), 0
    while at >= 0:
        begin, end = at, at + 1
        while begin > done and text[begin - 1] in EMAIL_CHARS:
            begin -= 1
        while end < len(text) and text[end] in EMAIL_CHARS:
            end += 1
        yield begin, text[begin:end]
        done = end
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that hold, by kind, then by start, in code points."""
    spans: list[Span] = []
    for begin, run in _email_runs(text):
        spans += [("email", begin + m.start(), begin + m.end()) for m in EMAIL.finditer(run)]
    for run in DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            begin = run.start()
            spans += [("ip", begin + m.start(), begin + m.end()) for m in IP.finditer(run.group()) if holds("ip", m.group())]
    spans += [("card", m.start(), m.end()) for m in CARD.finditer(text) if holds("card", m.group())]
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if holds("phone", m.group())]
    return spans


# Word shapes -----------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_IS = {name: np.zeros(256, np.int8) for name in ("digit", "letter", "dot", "at", "bracket")}
_IS["digit"][48:58] = 1
_IS["letter"][65:91] = _IS["letter"][97:123] = _IS["letter"][128:] = 1
_IS["dot"][46] = 1
_IS["at"][64] = 1
_IS["bracket"][[40, 41, 45]] = 1
_FIRST = np.zeros(256, np.int64)
_FIRST[48:58], _FIRST[43], _FIRST[40] = 1, 2, 3
_DIGITS = np.digitize(np.arange(64), [1, 2, 3, 4, 5, 9, 13, 20])
SHAPES = 9 * 4 * 2 * 2 * 4 * 2
EDGE = SHAPES  # the neighbour of a first or last token


def shapes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and shapes of the whitespace-separated tokens."""
    data = np.frombuffer(raw, np.uint8)
    space = np.concatenate([[True], _SPACE[data], [True]])
    change = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = change[::2], change[1::2]

    def count(name: str) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(_IS[name][data], dtype=np.int32)])
        return total[ends] - total[starts]

    shape = _DIGITS[np.minimum(count("digit"), 63)]
    shape = shape * 4 + np.minimum(count("dot"), 3)
    shape = shape * 2 + (count("at") > 0)
    shape = shape * 2 + (count("letter") > 0)
    shape = shape * 4 + _FIRST[data[starts]] if len(starts) else shape * 4
    return starts, ends, shape * 2 + (count("bracket") > 0)


def neighbours(shape: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shapes before and after each token; `first` marks the first token of a text."""
    before, after = np.roll(shape, 1), np.roll(shape, -1)
    before[first] = EDGE
    after[np.roll(first, -1)] = EDGE
    return before, after


# The field -------------------------------------------------------------------------------------


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def train(windows: list[tuple[list[int], list[int], list[int], list[int]]]) -> dict | None:
    """Weights of the most likely field with a Gaussian prior.

    A window has, per token, the shape, the shapes before and after, and the tag's number.
    """
    if not windows:
        return None
    n, longest, tags = len(windows), max(len(w[0]) for w in windows), len(TAGS)
    grid = np.full((3, n, longest), EDGE)
    gold = np.zeros((n, longest), dtype=np.int64)
    mask = np.zeros((n, longest), dtype=bool)
    for at, (own, before, after, tag) in enumerate(windows):
        size = len(own)
        grid[0, at, :size], grid[1, at, :size], grid[2, at, :size] = own, before, after
        gold[at, :size], mask[at, :size] = tag, True
    unary, link = np.zeros((3, SHAPES + 1, tags)), np.zeros((tags, tags))
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (unary, link)]
    hot = np.eye(tags)[gold] * mask[..., None]
    for turn in range(1, ROUNDS + 1):
        score = sum(unary[k][grid[k]] for k in range(3))
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            step = _logsum(forward[:, t - 1, :, None] + link, 1) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _logsum(link + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        total = _logsum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        pairs = (
            forward[:, :-1, :, None] + link + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        both = mask[:, 1:, None, None]
        expected = (np.exp(np.where(both, pairs, -np.inf))).sum((0, 1))
        seen = np.einsum("nti,ntj->ij", hot[:, :-1] * mask[:, 1:, None], hot[:, 1:])
        slope = np.zeros_like(unary)
        for k in range(3):
            np.add.at(slope[k], grid[k][mask], (hot - marginal)[mask])
        for weights, gradient, (first, second) in zip((unary, link), (slope, seen - expected), moments):
            gradient = gradient / n - 1e-4 * weights
            first += 0.1 * (gradient - first)
            second += 0.02 * (gradient**2 - second)
            weights += 0.3 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.98**turn)) + 1e-8)
    return {"unary": unary, "link": link}


def certain_outside(model: dict) -> tuple[list[np.ndarray], float]:
    """Per feature the least lead of O over any other tag, and the most that transitions can make up for."""
    leads = [w[:, 0] - w[:, 1:].max(axis=1) for w in model["unary"]]
    link = model["link"]
    gain = (link[:, None, 1:] + link.T[None, :, 1:]) - (link[:, None, :1] + link.T[None, :, :1])
    ends = np.concatenate([(link[:, 1:] - link[:, :1]).ravel(), (link.T[:, 1:] - link.T[:, :1]).ravel(), [0.0]])
    return leads, float(max(gain.max(), ends.max()))


def viterbi(score: np.ndarray, lengths: np.ndarray, link: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Best tags of a batch of stretches, padded to one length.

    `begin` and `end` say whether an outside token stands before and after the stretch.
    """
    n, longest, tags = score.shape
    best = score[:, 0] + np.where(begin[:, None], link[0], 0.0)
    back = np.zeros((n, longest, tags), dtype=np.int8)
    same = np.arange(tags)
    for t in range(1, longest):
        ways = best[:, :, None] + link
        on = (t < lengths)[:, None]
        back[:, t] = np.where(on, ways.argmax(axis=1), same)
        best = np.where(on, ways.max(axis=1) + score[:, t], best)
    tag = (best + np.where(end[:, None], link[:, 0], 0.0)).argmax(axis=1)
    path = np.zeros((n, longest), dtype=np.int8)
    for t in range(longest - 1, -1, -1):
        path[:, t] = tag
        tag = back[np.arange(n), t, tag]
    return path


def decode(shape: np.ndarray, first: np.ndarray, model: dict, bound: tuple[list[np.ndarray], float]) -> np.ndarray:
    """The best tag of every token of many texts."""
    tags = np.zeros(len(shape), dtype=np.int8)
    if not len(shape):
        return tags
    before, after = neighbours(shape, first)
    leads, most = bound
    open_ = leads[0][shape] + leads[1][before] + leads[2][after] <= most
    starts = np.flatnonzero(open_ & (first | ~np.roll(open_, 1)))
    last = np.roll(first, -1)
    ends = np.flatnonzero(open_ & (last | ~np.roll(open_, -1))) + 1
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    unary, link = model["unary"], model["link"]
    at = 0
    while at < len(order):
        # Stretches of up to twice the shortest length share a batch.
        upto = int(np.searchsorted(lengths[order], 2 * lengths[order[at]], side="right"))
        upto = min(upto, at + max(1, 200_000 // int(2 * lengths[order[at]])))
        some = order[at:upto]
        longest = int(lengths[some].max())
        place = np.minimum(starts[some][:, None] + np.arange(longest), len(shape) - 1)
        score = unary[0][shape[place]] + unary[1][before[place]] + unary[2][after[place]]
        path = viterbi(score, lengths[some], link, ~first[starts[some]], ~last[ends[some] - 1])
        inside = np.arange(longest) < lengths[some][:, None]
        tags[place[inside]] = path[inside]
        at = upto
    return tags


# On tables -------------------------------------------------------------------------------------


def _grouped(texts: list[str]) -> Iterator[list[int]]:
    group: list[int] = []
    size = 0
    for at, text in enumerate(texts):
        group.append(at)
        size += len(text)
        if size >= AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def _joined(texts: list[str]) -> tuple[bytes, np.ndarray]:
    """Texts as one, a line each, and where each begins."""
    parts = [text.encode() for text in texts]
    begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])[:-1]
    return b"\n".join(parts), begins


def _firsts(starts: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of every token, and whether it is that text's first token."""
    owner = np.searchsorted(begins, starts, side="right") - 1
    return owner, np.diff(owner, prepend=-1) != 0


def _labelled_windows(text: str) -> list[dict]:
    """Windows around the spans of the patterns, or one plain window, of a text."""
    raw = text.encode()
    starts, ends, shape = shapes(raw)
    if not len(starts):
        return []
    first = np.arange(len(starts)) == 0
    before, after = neighbours(shape, first)
    tags = np.zeros(len(starts), dtype=np.int64)
    middles = []
    for kind, begin, end in base_spans(text):
        begin, end = len(text[:begin].encode()), len(text[:end].encode())
        low, high = np.searchsorted(ends, begin, side="right"), np.searchsorted(starts, end, side="left")
        tags[low:high] = 2 + 2 * KINDS.index(kind)
        tags[low] -= 1
        middles.append((low, high))
    digits = np.flatnonzero(shape >= SHAPES // 9)  # numbers that are nothing, too
    middles += [(at, at + 1) for at in digits[tags[digits] == 0][:2]]
    middles = middles[:4] or [(len(starts) // 2, len(starts) // 2 + 1)]
    cuts = [slice(max(0, low - AROUND), high + AROUND) for low, high in middles]
    return [{"own": shape[c].tolist(), "before": before[c].tolist(), "after": after[c].tolist(), "tags": tags[c].tolist()} for c in cuts]


def labelled_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """A small labelled table: windows of a sample of documents with the tags of the patterns.

    Documents are chosen by a hash of their text, about SAMPLE_ROWS of them, and of their windows
    the WINDOWS with tags and as many without that come first by hash: a bounded sample.
    """
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    share = SAMPLE_ROWS / max(rows.count(), SAMPLE_ROWS)
    place = F.xxhash64("text")
    chosen = rows.withColumn("place", place).filter(F.pmod(place, F.lit(1_000_003)) <= share * 1_000_003)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [{"place": p, **w} for p, t in zip(frame["place"], frame["text"]) for w in _labelled_windows(t)]
            yield pd.DataFrame(found, columns=["place", "own", "before", "after", "tags"])

    ddl = "place bigint, own array<int>, before array<int>, after array<int>, tags array<int>"
    windows = chosen.mapInPandas(cut, ddl).withColumn("tagged", F.exists("tags", lambda t: t > 0)).distinct()
    order = ["place", "own", "before", "after", "tags"]
    return windows.filter("tagged").orderBy(*order).limit(WINDOWS).unionAll(windows.filter("NOT tagged").orderBy(*order).limit(WINDOWS))


def learn(labelled: DataFrame) -> dict | None:
    """The field of a labelled table of bounded size."""
    rows = labelled.select("own", "before", "after", "tags").limit(4 * WINDOWS).collect()
    return train([(r.own, r.before, r.after, r.tags) for r in rows])


def _added(text: str, stretch: Span, taken: list[Span]) -> Span | None:
    """A stretch of tokens as a span of its kind, without the marks around it, if it holds and is free."""
    kind, begin, end = stretch
    while begin < end and not (text[begin].isalnum() or text[begin] == "+"):
        begin += 1
    while end > begin and not text[end - 1].isalnum():
        end -= 1
    free = all(end <= a or b <= begin for _, a, b in taken)
    return (kind, begin, end) if end > begin and free and holds(kind, text[begin:end]) else None


def field_spans(texts: list[str], model: dict, bound) -> list[list[Span]]:
    """Stretches that the field labels, in code points."""
    raw, begins = _joined(texts)
    starts, ends, shape = shapes(raw)
    owner, first = _firsts(starts, begins)
    tags = decode(shape, first, model, bound)
    spans: list[list[Span]] = [[] for _ in texts]
    found = np.flatnonzero(tags)
    at = 0
    while at < len(found):
        token = found[at]
        kind = (tags[token] - 1) // 2
        stop = at + 1
        while stop < len(found) and found[stop] == found[stop - 1] + 1 and tags[found[stop]] == 2 + 2 * kind and not first[found[stop]]:
            stop += 1
        doc = owner[token]
        begin = len(raw[begins[doc] : starts[token]].decode())
        end = begin + len(raw[starts[token] : ends[found[stop - 1]]].decode())
        spans[doc].append((KINDS[kind], begin, end))
        at = stop
    return spans


def find(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """The rows without the text, with `base` and `added`: arrays of spans by kind, then by start."""
    rest = [name for name in docs.columns if name not in (text, "base", "added")]
    bound = certain_outside(model) if model else None

    def rows(spans: list[Span]) -> list[dict]:
        listed = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        return [{"kind": kind, "start": begin, "end": end} for kind, begin, end in listed]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [one or "" for one in batch.column(text).to_pylist()]
            base = [base_spans(one) for one in texts]
            added: list[list[Span]] = [[] for _ in texts]
            for group in _grouped(texts) if model else ():
                for at, stretches in zip(group, field_spans([texts[i] for i in group], model, bound)):
                    taken = list(base[at])
                    for stretch in stretches:
                        span = _added(texts[at], stretch, taken)
                        if span:
                            added[at].append(span)
                            taken.append(span)
            columns = [*(batch.column(name) for name in rest), *(pa.array([rows(s) for s in some], kind) for some in (base, added))]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "base", "added"])

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long")
    schema = T.StructType([docs.schema[name] for name in rest]).add("base", T.ArrayType(span)).add("added", T.ArrayType(span))
    return docs.select(*rest, text).mapInArrow(search, schema)
