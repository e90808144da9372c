"""Secret scans with an incremental blob ledger, on DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger is a table
with a row per blob and scan: the rules (kind and version) applied then and what they found. A scan
applies a rule to a blob only where no ledger row pairs the two, appends what it did, and joins the
findings back to all paths and versions by blob.

Defined results: a NULL text is the empty text; repeated rows keep a row each; an empty table gives
an empty result and an empty scan; other columns are kept, those called blob or spans are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import written
from sensorloom.llm.membership import absent, passing
from sensorloom.session import scratch_path

#: Matches that are placed one after another; before them stands the sum of all earlier ones.
STRETCH = 64

SPAN = "struct<kind:string,start:bigint,end:bigint>"
LEDGER = f"blob string, rules array<string>, found array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """A pattern of a kind; matches whose `group` is shorter than `least` are dropped.

    `hint` is a cheap condition every text with a kept match meets.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
RULES = (
    Rule("assign", 1, ASSIGN, 2, 12, "[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]{12}"),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16, r"[0-9a-f]{16}"),
)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def _stretches(length: Column, size: Column | int) -> Column:
    """Where each stretch of `size` items begins, counted from 0."""
    return F.when(length > 0, F.sequence(F.lit(0), length - 1, F.lit(size).cast("int"))).otherwise(F.array().cast("array<int>"))


def _within(begin: Column, size: Column | int, length: Column) -> Column:
    return F.sequence(begin, F.least(begin + size, length) - 1)


def matches(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as spans in code points, end exclusive.

    The pieces between matches and the matches themselves alternate, so a running length places them: a sum
    before each stretch of STRETCH matches, then within each stretch, so that no list grows match by match.
    """
    pattern = F.lit(rule.pattern)
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    measured = F.transform(
        pieces,
        lambda p: F.struct(
            F.length(p["gap"]).cast("bigint").alias("gap"),
            F.coalesce(F.length(p["whole"]), F.lit(0)).cast("bigint").alias("whole"),
            (F.length(p["part"]) >= rule.least).alias("keep"),
        ),
    )
    zero = F.lit(0).cast("bigint")

    def located(steps: Column) -> Column:
        length = F.size(steps)

        def item(n: Column) -> Column:
            return F.get(steps, n)

        def total(begin: Column) -> Column:
            return F.aggregate(_within(begin, STRETCH, length), zero, lambda sum_, n: sum_ + item(n)["gap"] + item(n)["whole"])

        def running(state: Column, begin: Column) -> Column:
            before = F.struct(begin.alias("begin"), state["at"].alias("at"))
            return F.struct((state["at"] + total(begin)).alias("at"), F.concat(state["out"], F.array(before)).alias("out"))

        first = F.struct(zero.alias("at"), F.array().cast("array<struct<begin:int,at:bigint>>").alias("out"))
        befores = F.aggregate(_stretches(length, STRETCH), first, running, lambda state: state["out"])

        def step(state: Column, n: Column) -> Column:
            start = state["at"] + item(n)["gap"]
            end = start + item(n)["whole"]
            span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end"))
            out = F.when(item(n)["keep"], F.concat(state["out"], F.array(span))).otherwise(state["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        def spans(before: Column) -> Column:
            begin = F.struct(before["at"].alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
            return F.aggregate(_within(before["begin"], STRETCH, length), begin, step, lambda state: state["out"])

        return F.flatten(F.transform(befores, spans))

    none = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(rule.hint), _with(measured, located)).otherwise(none)


def blob_of(text: str = "text") -> Column:
    """The address of a text's content."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def scan_unseen(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text") -> None:
    """Apply each rule to each blob of `versions` that the ledger does not pair with it, and append that.

    The ledger is asked with addresses alone. Of texts only those that a Bloom filter passes are shuffled: in a first
    scan the filter of repeated addresses, later that of the unseen ones; none if nothing is unseen.
    """
    spark = versions.sparkSession
    blobs = versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    wanted = F.array(*[F.lit(rule.key) for rule in rules])
    past = read_ledger(spark, ledger)
    if past is None:
        repeated = written(blobs.groupBy("blob").count().filter("count > 1").select("blob"), "repeated-blobs")
        several = passing(blobs, F.col("blob"), repeated).dropDuplicates(["blob"])
        pending = absent(blobs, F.col("blob"), repeated).unionByName(several).withColumn("rules", wanted)
    else:
        seen = past.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
        unseen = blobs.select("blob").distinct().join(seen, "blob", "left")
        unseen = unseen.select("blob", F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>"))).alias("rules"))
        unseen = written(unseen.filter(F.size("rules") > 0), "unseen-blobs")
        if unseen.isEmpty():
            return
        some = passing(blobs, F.col("blob"), unseen.select("blob")).dropDuplicates(["blob"])
        pending = some.join(unseen, "blob")
    none = F.array().cast(f"array<{SPAN}>")
    parts = [F.when(F.array_contains("rules", rule.key), matches(F.col("_text"), rule)).otherwise(none) for rule in rules]
    found = pending.select("blob", "rules", F.concat(*parts).alias("found"))
    found.write.mode("append").option("compression", "zstd").parquet(ledger)


def read_ledger(spark, ledger: str) -> DataFrame | None:
    """The ledger, or None before its first scan."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The versions with `blob` and `spans`: what the given rules found, by start, then by the rules' order."""
    current = F.array(*[F.lit(rule.kind) for rule in rules])
    table = read_ledger(versions.sparkSession, ledger)
    wanted = F.array(*[F.lit(rule.key) for rule in rules])
    # A ledger row holds what its own rules found; rows of older versions of a rule do not count.
    kinds = F.transform(F.array_intersect("rules", wanted), lambda key: F.substring_index(key, "@", 1))
    hits = (
        table.filter(F.size("found") > 0)
        .select("blob", F.filter("found", lambda span: F.array_contains(kinds, span["kind"])).alias("found"))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("found")).alias("found"))
    )
    ranked = F.array_sort(
        F.transform("found", lambda s: F.struct(s["start"].alias("start"), F.array_position(current, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    # Scans side by side, or an append that was repeated, leave the same span more than once.
    once = _with(ranked, lambda all_: F.filter(all_, lambda s, n: (n == 0) | (s != F.get(all_, n - 1))))
    hits = hits.select(
        F.col("blob").alias("__hit_blob"),
        F.transform(once, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("__hit_spans"),
    )
    path = scratch_path(versions.sparkSession, "secret-hits")
    hits.write.parquet(path)
    hits = versions.sparkSession.read.schema(hits.schema).parquet(path)
    none = F.array().cast(f"array<{SPAN}>")
    addressed = versions.withColumns({"blob": blob_of(text)})
    # Versions without a finding are not joined, so their texts do not move.
    keys = hits.select("__hit_blob")
    joined = passing(addressed, F.col("blob"), keys).join(hits, F.col("blob") == F.col("__hit_blob"), "left")
    joined = joined.withColumns({"spans": F.coalesce("__hit_spans", none)}).drop("__hit_blob", "__hit_spans")
    return absent(addressed, F.col("blob"), keys).withColumns({"spans": none}).select(joined.columns).unionByName(joined)


def scan(versions: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Scan what is unseen, then the findings of all versions; without a ledger, a new one."""
    ledger = ledger or scratch_path(versions.sparkSession, "secret-ledger")
    scan_unseen(versions, ledger, rules, text)
    return findings(versions, ledger, rules, text)


def shown(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by the mark.

    Spans come by start. They are taken in stretches, as many as a stretch has spans: a stretch has its own part of
    the text, from the furthest end before it to its own furthest end, so no string grows over the whole text.
    """
    zero = F.lit(0).cast("bigint")

    def part(begin: Column, end: Column) -> Column:
        return F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))

    def replaced(own: Column) -> Column:
        length = F.size(own)
        size = F.ceil(F.sqrt(length)).cast("int")

        def item(n: Column) -> Column:
            return F.get(own, n)

        def running(state: Column, begin: Column) -> Column:
            upto = F.aggregate(_within(begin, size, length), state["at"], lambda most, n: F.greatest(most, item(n)["end"]))
            stretch = F.struct(begin.alias("begin"), state["at"].alias("from"), upto.alias("to"))
            return F.struct(upto.alias("at"), F.concat(state["out"], F.array(stretch)).alias("out"))

        first = F.struct(zero.alias("at"), F.array().cast("array<struct<begin:int,from:bigint,to:bigint>>").alias("out"))
        stretches = F.aggregate(_stretches(length, size), first, running)

        def cut(stretch: Column) -> Column:
            def inside(piece: Column) -> Column:
                def step(state: Column, n: Column) -> Column:
                    at, start = state["at"], item(n)["start"] - stretch["from"]
                    before = F.substring(piece, (at + 1).cast("int"), (start - at).cast("int"))
                    out = F.when(start >= at, F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"])
                    return F.struct(F.greatest(at, item(n)["end"] - stretch["from"]).alias("at"), out.alias("out"))

                begin = F.struct(zero.alias("at"), F.lit("").alias("out"))
                return F.aggregate(_within(stretch["begin"], size, length), begin, step, lambda state: state["out"])

            return _with(part(stretch["from"], stretch["to"]), inside)

        def whole(state: Column) -> Column:
            rest = F.substring(text, (state["at"] + 1).cast("int"), F.length(text))
            return F.concat(F.array_join(F.transform(state["out"], cut), ""), rest)

        return _with(stretches, whole)

    return F.when(F.size(spans) > 0, _with(spans, replaced)).otherwise(text)
