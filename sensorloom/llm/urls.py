"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A canonical URL is the host, A-Z in lower case, and the path; scheme, query and fragment do not count. An entry
lists its host with all subdomains, and every path that starts with its own. A page therefore asks for the
ends of its host joined with the beginnings of its path, as many labels and characters as entries have. Those
that pass the Bloom filter go to the hash join with the entries, which takes the false positives out.

The filter is a table of blocks of 256 bits; a key sets one bit in each of the four words of one block. It is
broadcast, and its size has a bound (MOST_BLOCKS): a longer list passes more false positives, not other results.

Rules come before listed URLs, longer entries before shorter ones (host and path together, then the longer
host), of equal entries the one that blocks. A page without any is allowed. Only DataFrame functions.

Defined results: a URL that is NULL or has no `://` has an empty host and path, which only an entry with an empty
host could fit, and such entries are dropped; repeated rows keep a row each; an empty table gives an empty result,
empty lists allow everything; other columns are kept, those called host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import written

WORDS = 4
KEYS_PER_BLOCK = 16
# 40 bytes a block: the broadcast stays below 3 MB.
MOST_BLOCKS = 1 << 16

# An entry's rank as one number: a rule, the length of its key, the length of its host, whether it blocks.
RULE_BIT, LENGTH_BIT, HOST_BIT = 62, 32, 1
MASK_LENGTH, MASK_HOST = (1 << 30) - 1, (1 << 31) - 1


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty where there is none."""
    raw = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def entries(spark: SparkSession, rows: Iterable[tuple[str, str, str]]) -> DataFrame:
    """A few rows of (host, path, verdict) as a table, without a Python worker."""
    rows = list(rows)
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    items = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rows]
    return spark.range(1).select(F.inline(F.array(*items)))


def keyed(rules: DataFrame, listed: DataFrame) -> DataFrame:
    """Every entry once: key, rank, its number of host labels and its length of path."""

    def ranked(table: DataFrame, is_rule: int) -> DataFrame:
        host, path = host_of(F.concat(F.lit("://"), "host")), F.coalesce("path", F.lit(""))
        key = F.concat(host, path)
        rank = (
            F.lit(is_rule << RULE_BIT)
            + F.shiftleft(F.length(key).cast("bigint"), LENGTH_BIT)
            + F.shiftleft(F.length(host).cast("bigint"), HOST_BIT)
            + (F.col("verdict") == "block").cast("bigint")
        )
        fit = table.filter((F.coalesce(host, F.lit("")) != "") & F.col("verdict").isin("block", "allow"))
        return fit.select(key.alias("key"), rank.alias("rank"), F.size(F.split(host, "[.]")).alias("labels"), F.length(path).alias("chars"))

    both = ranked(rules, 1).unionByName(ranked(listed, 0))
    return both.groupBy("key").agg(F.max("rank").alias("rank"), F.max("labels").alias("labels"), F.max("chars").alias("chars"))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def positions(key: Column) -> list[Column]:
    """The bit that a key sets in each word of its block."""
    spread = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(spread, 6 * n).bitwiseAND(63).cast("int") for n in range(WORDS)]


def bloom(table: DataFrame, blocks: int) -> DataFrame:
    """The blocks that keys fall into: block, w0, w1, .."""
    one = F.lit(1).cast("bigint")
    words = [F.bit_or(F.call_function("shiftleft", one, at)).alias(f"w{n}") for n, at in enumerate(positions(F.col("key")))]
    return table.groupBy(block_of(F.col("key"), blocks).alias("block")).agg(*words)


def asked(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys a page asks for: as many labels of its host and characters of its path as entries have."""
    labels = F.split(host, "[.]")

    def key(labels_wanted: int, chars: int) -> Column:
        fits = (F.size(labels) >= labels_wanted) & (F.length(path) >= chars)
        end = F.array_join(F.slice(labels, F.size(labels) - labels_wanted + 1, labels_wanted), ".")
        return F.when(fits, F.concat(end, F.substring(path, 1, chars)))

    return F.array_compact(F.array(*[key(*shape) for shape in shapes]))


def possible_hits(urls: DataFrame, table: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """host, path and key of what passes the Bloom filter: every true hit and a few others."""
    blocks = max(1, min(MOST_BLOCKS, -(-table.count() // KEYS_PER_BLOCK)))
    filter_ = bloom(table, blocks)
    keys = urls.select("host", "path", F.explode(asked(F.col("host"), F.col("path"), shapes)).alias("key"))
    probed = keys.withColumn("block", block_of(F.col("key"), blocks)).join(F.broadcast(filter_), "block")
    every = F.lit(True)
    for n, at in enumerate(positions(F.col("key"))):
        every = every & (F.getbit(f"w{n}", at) == 1)
    return probed.filter(every).select("host", "path", "key")


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """Every page with host, path, the rule that fits it (`host/path`, else NULL) and the verdict.

    `rules` and `listed` are tables of host, path and verdict (block or allow). Writes the entries to the shared
    folder first, to know their number, so that their size decides between a broadcast and a shuffled hash join.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*own).alias("page"), F.col(url).alias("url"))
    rows = rows.select("page", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"))
    table = written(keyed(rules, listed), "url-entries")
    # One row per different pair of lengths, which the length of URLs bounds.
    shapes = [tuple(r) for r in table.select("labels", "chars").distinct().orderBy("labels", "chars").collect()]
    best = F.lit(None).cast("bigint").alias("rank")
    if not shapes:
        judged = rows.withColumn("rank", best)
    else:
        hits = possible_hits(rows, table, shapes).join(table.select("key", "rank").hint("shuffle_hash"), "key")
        longest = hits.groupBy("host", "path").agg(F.max("rank").alias("rank"))
        judged = rows.join(longest, ["host", "path"], "left")
    key_chars = F.shiftright("rank", LENGTH_BIT).bitwiseAND(MASK_LENGTH).cast("int")
    host_chars = F.shiftright("rank", HOST_BIT).bitwiseAND(MASK_HOST).cast("int")
    is_rule = F.shiftright("rank", RULE_BIT) == 1
    name = F.concat(F.substring("host", F.length("host") - host_chars + 1, host_chars), F.substring("path", F.lit(1), key_chars - host_chars))
    return judged.select(
        "page.*",
        "host",
        "path",
        F.when(is_rule, name).alias("rule"),
        F.when(F.col("rank").bitwiseAND(1) == 1, "block").otherwise("allow").alias("verdict"),
    )
