"""The registered queries of this folder, one per operator, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import bpe, codebooks, conversations, decontaminate, embeddings, jaccard, langid, licences, pii, quality, secrets, token_counts, urls
from sensorloom.llm.common import documents, remainder, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def _secret_spans(kind: str, pattern: str, group: int, least: int) -> str:
    """SQL of the spans of a kind: pieces and matches alternate."""
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, '{kind}' AS kind, begins AS start, begins + length(whole) AS stop FROM (
        SELECT doc_id, whole[i] AS whole, part[i] AS part,
               list_sum(list_transform(gap[1:i], lambda x: length(x)))::BIGINT
               + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0)::BIGINT AS begins
        FROM (
            SELECT doc_id, gap, whole, part, unnest(range(1, len(whole) + 1)) AS i FROM (
                SELECT doc_id, string_split_regex(t, '{quoted}') AS gap, regexp_extract_all(t, '{quoted}') AS whole,
                       regexp_extract_all(t, '{quoted}', {group}) AS part
                FROM texts WHERE regexp_matches(t, '{quoted}')
            )
        )
    ) WHERE length(part) >= {least}"""


SECRETS_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_secret_spans(r.kind, r.pattern, r.group, r.least) for r in secrets.RULES)}),
per_doc AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ','
                      ORDER BY start, list_position(['assign', 'access', 'hex'], kind)) AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id"""


@register("op4_secrets", SECRETS_SQL)
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: documents are paths with one version each; the ledger starts empty."""
    versions = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.scan(versions).select("doc_id", "spans")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    text = secrets.shown(F.col("spans"))
    return found.select(
        "doc_id",
        *[count(rule.kind) for rule in secrets.RULES],
        F.sha2(text.cast("binary"), 256).alias("base_sha256"),
        text.alias("spans"),
    )


@register("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again; tested against the library."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@register("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text; tested against the library."""
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@register("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every text, learned outside the held-out rows; tested by held-out accuracy."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(True))
    models = langid.learn(docs.filter(~held_out).select("text", "lang"))
    found = langid.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@register("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned outside the held-out rows; tested by held-out accuracy."""
    rows = written(quality.measured(documents(spark, sf_dir).select("doc_id", "text")), "statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = quality.labelled(rows, labels.filter(remainder("doc_id", 3) != 1))
    scored = quality.score(rows, quality.fit(written(learned, "labelled")))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text; tested against the patterns and by what the field adds."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find(docs, pii.learn(pii.labelled_table(docs)))
    kinds = F.array(*[F.lit(kind) for kind in pii.KINDS])

    def ranked(spans):
        return F.array_sort(F.transform(spans, lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("rank"), s["start"], s["end"], s["kind"])))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(secrets.shown(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.shown(ranked(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


@register("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents: doc_id, item_id, edits, start, end; tested by brute force."""
    return decontaminate.matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register("op10_embeddings")
def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of a label; its recall is measured against all pairs in the tests."""
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93)


@register("op5_jaccard")
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles are 90 % alike; tested by brute force."""
    return jaccard.join(documents(spark, sf_dir), words=3, percent=90)


@register("op2_licences")
def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of documents placed at source/lang/doc_id; tested by brute force."""
    docs = documents(spark, sf_dir)
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.col("doc_id").cast("string"))
    return licences.scan(docs.select("doc_id", path.alias("path"), "text"))


# The rules as (host, path, verdict).
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# The listed sites: junk under each of the tables' domains.
JUNK_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
DOMAINS = ("example.com", "example.net", "example.org")
URLS_SQL = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), ruled AS (
    SELECT *, CASE
        WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN starts_with(path, '/') AND regexp_matches(host, '(^|[.])({"|".join(JUNK_SITES)})[.]example[.](com|net|org)$') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled"""


@register("op13_urls", URLS_SQL)
def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL: four rules, then the listed junk sites."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    listed = urls.entries(spark, [(f"{site}.{domain}", "/", "block") for site in JUNK_SITES for domain in DOMAINS])
    return urls.judge(pages, urls.entries(spark, URL_RULES), listed).drop("url")


ENTRIES, PARTS, ROUNDS = 16, 8, 6


def _codebook_sql() -> str:
    """The rounds one after another; a mean is floored with integers only."""

    def nearest(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
    SELECT r, p, arg_min(e, ord) AS e, min(dist) AS dist FROM (
        SELECT r, p, e, dist, dist::HUGEINT * {ENTRIES} + e AS ord FROM (
            SELECT x.r, x.p, c.e, list_sum(list_transform(range(1, len(x.part) + 1), lambda i: (x.part[i] - c.part[i]) * (x.part[i] - c.part[i])))::BIGINT AS dist
            FROM parts x JOIN c{n} c ON x.p = c.p
        )
    ) GROUP BY r, p
)"""

    def update(n: int) -> str:
        return f"""m{n} AS (
    SELECT p, e, list(((s - (s % k + k) % k) // k)::BIGINT ORDER BY i) AS part FROM (
        SELECT p, e, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS k FROM (
            SELECT x.p, a.e, unnest(x.part) AS x, unnest(range(len(x.part))) AS i FROM parts x JOIN a{n} a ON x.r = a.r AND x.p = a.p
        ) GROUP BY p, e, i
    ) GROUP BY p, e
), c{n + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.part, c.part) AS part FROM c{n} c LEFT JOIN m{n} m ON c.p = m.p AND c.e = m.e)"""

    steps = [f"{nearest(n)}, {update(n)}" for n in range(ROUNDS)] + [nearest(ROUNDS)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({4096} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT r, vec_id, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS part FROM kept, unnest(range({PARTS})) AS u(p)
), c0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part FROM parts
    WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})
), {", ".join(steps)}, coded AS (
    SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM a{ROUNDS} GROUP BY r
)
SELECT k.vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       sha256((SELECT string_agg(array_to_string(part, ','), ',' ORDER BY p, e) FROM c{ROUNDS})) AS codebooks_sha256
FROM kept k JOIN coded d ON k.r = d.r"""


@register("op12_codebooks", _codebook_sql())
def op12_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sound vector's code and error, errors by label, and the digest of the codebooks."""
    found = codebooks.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"), "embedding", "vec_id", PARTS, ENTRIES, ROUNDS)
    codes = written(found.codes.select("vec_id", "label", "code", "error"), "codes")
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = codes.groupBy("label").agg(F.least(whole, F.lit(codebooks.LONGEST)).cast("bigint").alias("label_error"))
    digest = sha256(",".join(str(x) for x in found.codebooks.ravel().tolist()).encode()).hexdigest()
    joined = codes.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that the check asks for, by the remainder of conversation and turn."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    code = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.filter(code != 0).select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("copy"),
    )


@register("op11_conversations")
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults, the cheapest repair and the digest of what it gives."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = conversations.repair(damaged(rows))
    digests = conversations.digests(found.rows).withColumnRenamed("conv_id", "of")
    joined = found.conversations.join(digests, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    return every.join(joined, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
