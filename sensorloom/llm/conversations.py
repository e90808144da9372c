"""Conversation structure repair: the cheapest edits, by dynamic programming over grammar-compressed sequences.

A row of a conversation is a symbol: the initial of its role and its first fault. A symbol is a 4 x 4 matrix over
(min, +) between the states of what is kept so far (nothing, system, user, assistant): each entry holds the least
cost and, as a rope, the ASCII-least audit of that cost. The matrix of a sequence is the product of its symbols.

1. Rows, without their texts, are ordered by (conversation, turn) over range partitions. What a partition holds of a
   conversation is a piece; a conversation may have many, so a very long one is no task's alone.
2. Re-Pair over the different sequences of all conversations: the most frequent adjacent pairs become rules, round
   after round. Each rule's matrix is computed once, from those of its two symbols, and used wherever it occurs; each
   different sequence is evaluated once and joined back to all pieces that have it.
3. The pieces' matrices of a conversation are multiplied, and its audit is applied to its rows as they stream by.

Rows are moved with their text only in step 3. There a conversation's rows pass one task in order, with memory for its
audit and a batch of rows: what is made of a whole text in order, such as a digest, asks for that. The number of rules
has a bound, past which sequences are compressed less; results do not depend on it.

Audits of equal cost between the same states over the same rows never begin one another: they hold as many letters
for rows, so the longer one would hold more insertions and cost more. Products therefore keep the order of audits.

Defined results: roles and texts that are NULL count as one space; a NULL turn comes first and counts in no gap; rows of
one turn are ordered by the MD5 of role and text; a NULL id is a conversation; repeated rows are duplicates; an
empty table gives empty results; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import written

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
INITIALS, FAULTS = "suao", "kbdt"  # other roles are o; kept as they are, blank, duplicate, truncated
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
# Rules of Re-Pair: rounds, and pairs replaced in each. Rules are characters from U+E000 on.
ROUNDS, PAIRS = 8, 32
FIRST_RULE = 0xE000

# States: nothing kept yet, then the initial of the last row kept. What may follow leads to its own state.
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
TURN_OF = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}

MODULUS, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51


class Repaired(NamedTuple):
    """A row per conversation, and the rows it has after the repair, in order within their partition."""

    conversations: DataFrame
    rows: DataFrame


@lru_cache(maxsize=1 << 16)
def power(n: int) -> int:
    return pow(BASE, n, MODULUS)


class Rope:
    """A string as a tree; its length and hash tell equal stretches apart from others without reading them."""

    __slots__ = ("length", "code", "left", "right")

    def __init__(self, left: Rope | str, right: Rope | None = None):
        self.left, self.right = left, right
        if right is None:
            self.length, self.code = len(left), 0
            for c in left:
                self.code = (self.code * BASE + ord(c)) % MODULUS
        else:
            self.length = left.length + right.length
            self.code = (left.code * power(right.length) + right.code) % MODULUS

    def __add__(self, other: Rope) -> Rope:
        return Rope(self, other) if self.length and other.length else (self if self.length else other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            rope = todo.pop()
            if rope.right is None:
                out.append(rope.left)
            else:
                todo += [rope.right, rope.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """Whether the string comes first: equal stretches are skipped by their hash."""
        ours, theirs = [self], [other]
        while ours and theirs:
            a, b = ours.pop(), theirs.pop()
            if a.length == b.length and a.code == b.code:
                continue
            if a.right is not None and (a.length >= b.length or b.right is None):
                ours += [a.right, a.left]
                theirs.append(b)
            elif b.right is not None:
                theirs += [b.right, b.left]
                ours.append(a)
            else:
                shared = min(a.length, b.length)
                if a.left[:shared] != b.left[:shared]:
                    return a.left[:shared] < b.left[:shared]
                ours += [Rope(a.left[shared:])] * (a.length > shared)
                theirs += [Rope(b.left[shared:])] * (b.length > shared)
        return bool(theirs)


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def least(one: Entry, other: Entry) -> Entry:
    """The cheaper entry; of equal costs, the one whose audit comes first."""
    if one is None or other is None:
        return other if one is None else one
    if one[0] != other[0]:
        return one if one[0] < other[0] else other
    return other if other[1] < one[1] else one


def product(x: Matrix, y: Matrix) -> Matrix:
    """Matrices one after another; audits are put together for the least costs only."""
    out = []
    for row in x:
        line = []
        for j in STATES:
            costs = [row[k][0] + y[k][j][0] if row[k] and y[k][j] else None for k in STATES]
            best = min((c for c in costs if c is not None), default=None)
            ways = [(best, row[k][1] + y[k][j][1]) for k in STATES if best is not None and costs[k] == best]
            line.append(reduce(least, ways, None))
        out.append(line)
    return out


def insertions() -> Matrix:
    """Any number of rows inserted: a third one never helps."""
    out: Matrix = [[None] * 4 for _ in STATES]
    for start in STATES:
        state = start
        for n in range(3):
            out[start][state] = least(out[start][state], (n * INSERT, Rope("I" * n)))
            state = NEXT[state, TURN_OF[state]]
    return out


class Sequence(NamedTuple):
    """What a stretch of rows comes to; two stretches are put together from this alone."""

    matrix: Matrix
    faults: tuple[int, int, int]  # blank, duplicate, truncated
    illegal: int
    first: str
    last: str

    def then(self, other: Sequence) -> Sequence:
        joint = self.last + other.first not in LEGAL
        faults = tuple(a + b for a, b in zip(self.faults, other.faults, strict=True))
        return Sequence(product(self.matrix, other.matrix), faults, self.illegal + other.illegal + joint, self.first, other.last)


def symbol(initial: str, fault: str) -> str:
    """A row's character."""
    return chr(ord("A") + INITIALS.index(initial) * len(FAULTS) + FAULTS.index(fault))


def single(initial: str, fault: str) -> Sequence:
    """A row: insertions, then its deletion, or unless it must go, a new role or none."""
    step: Matrix = [[None] * 4 for _ in STATES]
    more = TRUNCATED if fault == "t" else 0
    for state in STATES:
        step[state][state] = (DELETE, Rope("D"))
        if fault in "kt":
            turned = NEXT[state, TURN_OF[state]]
            step[state][turned] = least(step[state][turned], (REROLE + more, Rope("R")))
            if (state, initial) in NEXT:
                kept = NEXT[state, initial]
                step[state][kept] = least(step[state][kept], (more, Rope("K")))
    faults = tuple(int(fault == f) for f in "bdt")
    return Sequence(product(insertions(), step), faults, 0, initial, initial)


def alphabet() -> dict[str, Sequence]:
    return {symbol(i, f): single(i, f) for i in INITIALS for f in FAULTS}


def whole(vector: list[Entry]) -> tuple[int, str]:
    """Cost and audit of a conversation, from the entries of its start; nothing or whole pairs must be left."""
    end = insertions()
    ends = [(v[0] + end[k][j][0], v[1] + end[k][j][1]) for k, v in enumerate(vector) for j in (START, ASSISTANT) if v and end[k][j]]
    cost, audit = reduce(least, ends)
    return cost, str(audit)


# --- rows to pieces ---------------------------------------------------------------------------------


def described(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows as c, t, digest, role and text, without NULL roles or texts."""
    role_, text_ = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    digest = F.unhex(F.md5(F.concat_ws(":", F.length(role_).cast("string"), role_, text_).cast("binary")))
    return rows.select(F.col(conversation).alias("c"), F.col(turn).cast("bigint").alias("t"), digest.alias("digest"), role_.alias("role"), text_.alias("text"))


def faults_of(rows: DataFrame) -> DataFrame:
    """Different rows of a conversation and turn with their number `n`, initial, and what is wrong with them."""
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    light = rows.select(
        "c",
        "t",
        "digest",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    different = light.groupBy(light.columns).agg(F.count("*").alias("n"))
    # A row is seen first in the first turn that has it; turns that are NULL come before all others.
    firsts = different.groupBy(F.col("c").alias("c_"), F.col("digest").alias("digest_")).agg(F.min("t").alias("t_"), F.max(F.col("t").isNull()).alias("none_"))
    same = F.col("c").eqNullSafe(F.col("c_")) & (F.col("digest") == F.col("digest_"))
    first = F.col("t").isNull() | (~F.col("none_") & (F.col("t") == F.col("t_")))
    return different.join(firsts, same).select("c", "t", "digest", "initial", "blank", "cut", "n", first.alias("first"))


def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretch of each conversation in an ordered partition: its symbols and turns."""
    task = TaskContext.get().partitionId()
    names = ["c", "piece", "seq", "first_turn", "last_turn", "turns"]
    kind, c, seq, first_turn, last_turn, turns = None, None, [], None, None, 0

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * len(names)
        kinds = [kind, pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(list(v), k) for v, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        kind, done = batch.schema.field("c").type, []
        for r in batch.to_pylist():
            if not seq or r["c"] != c:
                done += [(c, task, "".join(seq), first_turn, last_turn, turns)] if seq else []
                c, seq, first_turn, last_turn, turns = r["c"], [], None, None, 0
            fault = "b" if r["blank"] else "d" if not r["first"] else "t" if r["cut"] else "k"
            seq.append(symbol(r["initial"], fault) + symbol(r["initial"], "b" if r["blank"] else "d") * (r["n"] - 1))
            if r["t"] is not None and (not turns or last_turn != r["t"]):
                first_turn, last_turn, turns = r["t"] if not turns else first_turn, r["t"], turns + 1
        yield batch_of(done)
    if seq:
        yield batch_of([(c, task, "".join(seq), first_turn, last_turn, turns)])


# --- the grammar ------------------------------------------------------------------------------------


def compressed(seq: Column, rules: list[tuple[str, str]]) -> Column:
    """The sequence with every rule's pair replaced, rule after rule."""
    return reduce(lambda out, rule: F.replace(out, F.lit(rule[1]), F.lit(rule[0])), rules, seq)


def learn_rules(sequences: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> list[tuple[str, str]]:
    """Re-Pair over all different sequences: (rule, pair), a rule after those that its pair holds.

    A round replaces the most frequent pairs, one after another; at most rounds * pairs rules come to the driver.
    """
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        # Each position begins a pair, so matches overlap.
        every = F.regexp_extract_all(compressed(F.col("seq"), rules), F.lit("(?s)(?=(..))"), F.lit(1))
        counted = sequences.select(F.explode(every).alias("pair")).groupBy("pair").count().filter("count > 1")
        best = [r.pair for r in counted.orderBy(F.desc("count"), "pair").limit(pairs).collect()]
        if not best:
            break
        rules += [(chr(FIRST_RULE + len(rules) + n), pair) for n, pair in enumerate(best)]
    return rules


def grammar(rules: list[tuple[str, str]]) -> dict[str, Sequence]:
    """What every symbol and rule comes to, bottom-up."""
    known = alphabet()
    for rule, (left, right) in rules:
        known[rule] = known[left].then(known[right])
    return known


VALUE = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, costs array<bigint>, audits array<string>"


def evaluate(known: dict[str, Sequence]) -> Callable:
    """Each sequence as the product of its symbols: its value, matrices row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [reduce(Sequence.then, (known[s] for s in short)) for short in batch.column("short").to_pylist()]
            entries = [[e for row in f.matrix for e in row] for f in found]
            columns = [pa.array([f.faults[n] for f in found], pa.int64()) for n in range(3)]
            columns += [pa.array([f.illegal for f in found], pa.int64()), pa.array([f.first for f in found], pa.string()), pa.array([f.last for f in found], pa.string())]
            columns.append(pa.array([[e and e[0] for e in m] for m in entries], pa.list_(pa.int64())))
            columns.append(pa.array([[e and str(e[1]) for e in m] for m in entries], pa.list_(pa.string())))
            names = ["blank", "duplicate", "truncated", "illegal", "first", "last", "costs", "audits"]
            yield pa.record_batch([batch.column("seq"), *columns], ["seq", *names])

    return run


def conclude(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation from its pieces, in order."""
    for batch in batches:
        rows = []
        for pieces in batch.column("pieces").to_pylist():
            vector: list[Entry] = [(0, Rope("")), None, None, None]
            sums, illegal, last, turns, last_turn = [0, 0, 0], 0, None, 0, None
            for p in pieces:
                cells = [(c, Rope(a)) if c is not None else None for c, a in zip(p["costs"], p["audits"], strict=True)]
                vector = product([vector], [cells[4 * k : 4 * k + 4] for k in STATES])[0]
                sums = [x + p[n] for x, n in zip(sums, ("blank", "duplicate", "truncated"), strict=True)]
                illegal += p["illegal"] + (last is not None and last + p["first"] not in LEGAL)
                last = p["last"]
                turns += p["turns"] - (p["turns"] > 0 and p["first_turn"] == last_turn)
                last_turn = p["last_turn"] if p["turns"] else last_turn
            firsts = [p["first_turn"] for p in pieces if p["turns"]]
            gaps = last_turn - firsts[0] + 1 - turns if firsts else 0
            rows.append((min(gaps, (1 << 63) - 1), *sums, illegal, *whole(vector)))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        arrays = [pa.array(list(v), pa.string() if n == 6 else pa.int64()) for n, v in enumerate(columns)]
        yield pa.record_batch([batch.column("c"), *arrays], ["c", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


# --- edits ------------------------------------------------------------------------------------------


def apply_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows after the repair; a conversation's audit comes before its rows."""
    names = ["c", "at", "edit", "role", "text"]
    c, audit, next_, state, at, kind = None, "", 0, START, 0, None
    out: list[tuple] = []

    def keep(edit: str, role: str, text: str, initial: str) -> None:
        nonlocal state, at
        out.append((c, at, edit, role, text))
        state, at = NEXT[state, initial], at + 1

    def insert() -> None:
        nonlocal next_
        while audit[next_ : next_ + 1] == "I":
            keep("I", ROLES[TURN_OF[state]], "", TURN_OF[state])
            next_ += 1

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        batch = pa.record_batch([pa.array(list(v), k) for v, k in zip(columns, kinds, strict=True)], names)
        out.clear()
        return batch

    for batch in batches:
        kind = batch.schema.field("c").type
        for c_, role, text in zip(*(batch.column(n).to_pylist() for n in ("c", "role", "text")), strict=True):
            if role is None:  # the audit of the next conversation
                insert()
                c, audit, next_, state, at = c_, text, 0, START, 0
                continue
            insert()
            edit, next_ = audit[next_], next_ + 1
            if edit == "K":
                keep(edit, role, text, role[0])
            elif edit == "R":
                keep(edit, ROLES[TURN_OF[state]], text, TURN_OF[state])
        yield flush()
    insert()
    if out:
        yield flush()


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Repair every conversation to `(s?(ua)+)?` at the least cost; ties go to the ASCII-least audit.

    Writes pieces, different sequences and conversations to the shared folder.
    """
    named = described(rows, conversation, turn, role, text)
    kind = named.schema["c"].dataType

    def schema(rest: str) -> T.StructType:
        return T.StructType([T.StructField("c", kind), *T.StructType.fromDDL(rest).fields])

    order = ["c", "t", "digest"]
    placed = faults_of(named).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = written(placed.mapInArrow(cut_pieces, schema("piece int, seq string, first_turn bigint, last_turn bigint, turns bigint")), "pieces")
    sequences = written(pieces.select("seq").distinct(), "sequences")
    rules = learn_rules(sequences)
    short = sequences.withColumn("short", compressed(F.col("seq"), rules))
    values = short.mapInArrow(evaluate(grammar(rules)), "seq string, " + VALUE).withColumnRenamed("seq", "of")
    members = pieces.join(values, F.col("seq") == F.col("of")).drop("seq", "of")
    gathered = members.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("piece", *[x for x in members.columns if x not in ("c", "piece")]))).alias("pieces"))
    found = schema("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")
    conversations = written(gathered.mapInArrow(conclude, found), "conversations")
    heads = conversations.select("c", F.lit(0).alias("body"), F.lit(None).cast("bigint").alias("t"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    ordered = heads.unionByName(named.withColumn("body", F.lit(1))).repartition("c").sortWithinPartitions("c", "body", "t", "digest")
    repaired = ordered.select("c", "role", "text").mapInArrow(apply_audits, schema("at bigint, edit string, role string, text string"))
    return Repaired(conversations.withColumnRenamed("c", conversation), repaired.withColumnRenamed("c", conversation))


def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each conversation's `role:text` lines, fed row by row."""
    c, state, kind = None, None, None

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        ids, hashes = [d[0] for d in done], [d[1].hexdigest() for d in done]
        return pa.record_batch([pa.array(ids, kind), pa.array(hashes, pa.string())], ["c", "repaired_sha256"])

    for batch in batches:
        kind, done = batch.schema.field("c").type, []
        for c_, role, text in zip(*(batch.column(n).to_pylist() for n in ("c", "role", "text")), strict=True):
            if state is None or c_ != c:
                done += [(c, state)] if state else []
                c, state = c_, sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        yield batch_of(done)
    if state:
        yield batch_of([(c, state)])


def digests(rows: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """repaired_sha256 of each conversation that has rows after the repair; `rows` as `repair` gives them."""
    kind = rows.schema[conversation].dataType
    schema = T.StructType([T.StructField("c", kind), T.StructField("repaired_sha256", T.StringType())])
    named = rows.select(F.col(conversation).alias("c"), "role", "text")
    return named.mapInArrow(digest_rows, schema).withColumnRenamed("c", conversation)
