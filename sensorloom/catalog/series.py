"""Time series, statistics and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import settings
from sensorloom.catalog import proxies
from sensorloom.catalog.proxies import DAILY_FACT, GUIDELINE, STAR, WEATHER, daily_fact, star_tables, table
from sensorloom.catalog.registry import exact_mean, half_up, register
from sensorloom.functions import dates
from sensorloom.functions.text import contains_ignoring_case, contains_text
from sensorloom.operators import calendar, joins, keys, quality, reshape, statistics, timeseries
from sensorloom.operators.dedup import keep_first
from sensorloom.operators.joins import flag_matching
from sensorloom.plans import context
from sensorloom.sources import sinks

# Every flag on every day of the facts' range.
DENSE = f"""
{DAILY_FACT},
days AS (
    SELECT CAST(UNNEST(GENERATE_SERIES((SELECT MIN(date) FROM daily_fact), (SELECT MAX(date) FROM daily_fact),
                                       INTERVAL 1 DAY)) AS DATE) AS date
),
dense AS (
    SELECT d.date, s.flag, f.mean, f.max
    FROM (SELECT DISTINCT flag FROM daily_fact) s, days d
    LEFT JOIN daily_fact f ON f.date = d.date AND f.flag = s.flag
)"""


def dense_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = daily_fact(spark, sf_dir).select("date", "flag", "mean", "max")
    return timeseries.dense(facts, ["flag"])


@register(
    "previous_row",
    f"""
    WITH {DAILY_FACT}
    SELECT date, flag, mean, LAG(mean) OVER (PARTITION BY flag ORDER BY date) AS before FROM daily_fact""",
)
def previous_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the previous measured day, however long ago."""
    facts = daily_fact(spark, sf_dir).select("date", "flag", "mean")
    return timeseries.previous_row(facts, ["flag"], "mean", "before")


@register(
    "lag_lead_calendar",
    f"""
    WITH {DENSE}
    SELECT date, flag, mean, LAG(mean, 1) OVER w AS lag_1, LAG(mean, 2) OVER w AS lag_2,
           LEAD(mean) OVER w AS next, LEAD(mean) OVER w - mean AS change
    FROM dense WINDOW w AS (PARTITION BY flag ORDER BY date)""",
)
def lag_lead_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F3, F5 on a dense series."""
    value, series = F.col("mean"), ["flag"]
    return dense_facts(spark, sf_dir).select(
        "date",
        "flag",
        "mean",
        timeseries.lag_days(value, 1, series).alias("lag_1"),
        timeseries.lag_days(value, 2, series).alias("lag_2"),
        timeseries.lead_days(value, 1, series).alias("next"),
        timeseries.change_to_next(value, series).alias("change"),
    )


@register(
    "lag_lead_joined",
    f"""
    WITH {DAILY_FACT}
    SELECT f.date, f.flag, f.mean, a.mean AS lag_1, b.mean AS lag_2, c.mean AS next
    FROM daily_fact f
    LEFT JOIN daily_fact a ON a.flag = f.flag AND a.date = f.date - 1
    LEFT JOIN daily_fact b ON b.flag = f.flag AND b.date = f.date - 2
    LEFT JOIN daily_fact c ON c.flag = f.flag AND c.date = f.date + 1""",
)
def lag_lead_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F3 by calendar days on a sparse series."""
    facts = daily_fact(spark, sf_dir).select("date", "flag", "mean")
    return timeseries.at_day_offset(
        facts, ["flag"], {"lag_1": ("mean", 1), "lag_2": ("mean", 2), "next": ("mean", -1)}
    )


@register(
    "rolling7_min5",
    f"""
    WITH {DENSE}
    SELECT date, flag, CASE WHEN COUNT(mean) OVER w >= 5
           THEN CAST(SUM(CAST(mean AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(mean) OVER w END AS mean7
    FROM dense WINDOW w AS (PARTITION BY flag ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def rolling7_min5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 on a dense series."""
    mean7 = timeseries.rolling_mean(F.col("mean"), 7, 5, ["flag"], is_dense=True)
    return dense_facts(spark, sf_dir).select("date", "flag", mean7.alias("mean7"))


@register(
    "rolling7_sparse",
    f"""
    WITH {DAILY_FACT}
    SELECT date, flag, CASE WHEN COUNT(mean) OVER w >= 5
           THEN CAST(SUM(CAST(mean AS DECIMAL(18,2))) OVER w AS DOUBLE) / COUNT(mean) OVER w END AS mean7
    FROM daily_fact
    WINDOW w AS (PARTITION BY flag ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
)
def rolling7_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 on a sparse series: the frame counts days, not rows."""
    mean7 = timeseries.rolling_mean(F.col("mean"), 7, 5, ["flag"])
    return daily_fact(spark, sf_dir).select("date", "flag", mean7.alias("mean7"))


@register(
    "calendar_spine",
    f"""
    WITH {DAILY_FACT},
    days AS (
        SELECT CAST(UNNEST(GENERATE_SERIES((SELECT MIN(date) FROM daily_fact), (SELECT MAX(date) FROM daily_fact),
                                           INTERVAL 1 DAY)) AS DATE) AS date
    ),
    {WEATHER.strip()}
    SELECT d.date, w.temp_mean_c, w.wind_mean_ms FROM days d LEFT JOIN weather w ON d.date = w.date""",
)
def calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps made visible."""
    days = calendar.spine(calendar.day_range(daily_fact(spark, sf_dir)))
    weather = proxies.weather(spark, sf_dir).select("date", "temp_mean_c", "wind_mean_ms")
    return calendar.on_spine(weather, days)


@register(
    "monthly_resample",
    f"""
    WITH {DAILY_FACT}, a AS (SELECT date, mean FROM daily_fact WHERE flag = 'A'),
    months AS (
        SELECT CAST(UNNEST(GENERATE_SERIES((SELECT DATE_TRUNC('month', MIN(date)) FROM a),
                                           (SELECT DATE_TRUNC('month', MAX(date)) FROM a), INTERVAL 1 MONTH)) AS DATE) AS m
    )
    SELECT m AS month_start, {half_up(exact_mean("a.mean"), 4)} AS mean
    FROM months LEFT JOIN a ON CAST(DATE_TRUNC('month', a.date) AS DATE) = m GROUP BY 1""",
)
def monthly_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the mean of every month of a series."""
    series = daily_fact(spark, sf_dir).filter(F.col("flag") == "A")
    return timeseries.monthly_mean(series.select("date", "mean"), "mean", 4)


@register(
    "gap_report",
    f"""
    WITH {DAILY_FACT}
    SELECT flag, MIN(date) AS first_day, MAX(date) AS last_day, COUNT(DISTINCT date) AS days,
           DATE_DIFF('day', MIN(date), MAX(date)) + 1 - COUNT(DISTINCT date) AS missing_days
    FROM daily_fact GROUP BY 1""",
)
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8."""
    return timeseries.gap_report(daily_fact(spark, sf_dir), ["flag"])


@register(
    "empty_years",
    f"""
    WITH {STAR}
    SELECT station_code, pollutant_code, CAST(YEAR(date) AS INTEGER) AS year FROM fact
    GROUP BY 1, 2, 3 HAVING COUNT(CASE WHEN n_hours >= 2 THEN mean END) = 0""",
)
def empty_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """years of each station and pollutant without a day of two values or more, on all facts."""
    tables = star_tables(spark, sf_dir)
    facts = tables["daily_measurement"].join(tables["station"], "station_id").join(tables["pollutant"], "pollutant_id")
    complete = facts.withColumn("value", F.when(F.col("n_hours") >= 2, F.col("mean")))
    return timeseries.empty_years(complete, "value", series=["station_code", "pollutant_code"])


# --- statistics -----------------------------------------------------------------------------------


@register(
    "freshness_profile",
    """
    SELECT event_type, COUNT(*) AS n_rows, MIN(ts) AS first_value, MAX(ts) AS latest_value
    FROM events WHERE CONTAINS(LOWER(props), '"k"') GROUP BY 1""",
)
def freshness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and time range per group."""
    events = table(spark, sf_dir, "events").filter(contains_ignoring_case(F.col("props"), '"K"'))
    return statistics.profile(events, ["event_type"], "ts")


@register("value_counts", "SELECT o_orderpriority, COUNT(*) AS n_rows FROM orders GROUP BY 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E22."""
    return statistics.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@register(
    "crosstab",
    """
    SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS year, COUNT(*) FILTER (o_orderstatus = 'F') AS "F",
           COUNT(*) FILTER (o_orderstatus = 'O') AS "O", COUNT(*) FILTER (o_orderstatus = 'X') AS "X"
    FROM orders GROUP BY 1""",
)
def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code that never occurs gives zeros."""
    year = F.year("o_orderdate")
    return statistics.crosstab(table(spark, sf_dir, "orders"), year, "year", "o_orderstatus", ["F", "O", "X"])


@register(
    "correlations",
    f"""
    WITH c AS (
        SELECT CORR(l_extendedprice, l_quantity) AS l_extendedprice, CORR(l_discount, l_quantity) AS l_discount,
               CORR(l_tax, l_quantity) AS l_tax, CORR(l_linenumber, l_quantity) AS l_linenumber,
               CORR(CASE WHEN l_returnflag = 'A' THEN l_tax END, l_quantity) AS tax_a
        FROM lineitem
    )
    SELECT 'l_extendedprice' AS variable, {half_up("l_extendedprice", 6)} AS correlation FROM c
    UNION ALL SELECT 'l_discount', {half_up("l_discount", 6)} FROM c
    UNION ALL SELECT 'l_tax', {half_up("l_tax", 6)} FROM c
    UNION ALL SELECT 'l_linenumber', {half_up("l_linenumber", 6)} FROM c
    UNION ALL SELECT 'tax_a', {half_up("tax_a", 6)} FROM c""",
)
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise complete, one pass."""
    items = table(spark, sf_dir, "lineitem").withColumn(
        "tax_a", F.when(F.col("l_returnflag") == "A", F.col("l_tax"))
    )
    names = ["l_extendedprice", "l_discount", "l_tax", "l_linenumber", "tax_a"]
    return statistics.correlations(items, names, "l_quantity")


@register(
    "group_compare",
    f"""
    SELECT l_returnflag, COUNT(l_extendedprice) AS n, {half_up(exact_mean("l_extendedprice"), 4)} AS mean,
           {half_up("COUNT(*) FILTER (l_extendedprice > 50000)::DOUBLE / COUNT(l_extendedprice)", 4)} AS share_above,
           {half_up("QUANTILE_CONT(l_extendedprice, 0.25)", 4)} AS q1,
           {half_up("QUANTILE_CONT(l_extendedprice, 0.5)", 4)} AS median,
           {half_up("QUANTILE_CONT(l_extendedprice, 0.75)", 4)} AS q3
    FROM lineitem GROUP BY 1""",
)
def group_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of all line items per flag, no group gathered anywhere."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return statistics.compare_groups(items, "l_returnflag", "l_extendedprice", 50000.0, decimals=2)


@register(
    "group_compare_discount",
    f"""
    SELECT l_returnflag, COUNT(l_discount) AS n, {half_up(exact_mean("l_discount"), 4)} AS mean,
           {half_up("COUNT(*) FILTER (l_discount > 0.05)::DOUBLE / COUNT(l_discount)", 4)} AS share_above,
           {half_up("QUANTILE_CONT(l_discount, 0.25)", 4)} AS q1, {half_up("QUANTILE_CONT(l_discount, 0.5)", 4)} AS median,
           {half_up("QUANTILE_CONT(l_discount, 0.75)", 4)} AS q3
    FROM lineitem GROUP BY 1""",
)
def group_compare_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E26 on values of another scale, with many ties."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_discount")
    return statistics.compare_groups(items, "l_returnflag", "l_discount", 0.05, decimals=2)


@register(
    "episode_compare",
    f"""
    WITH {DAILY_FACT}, {proxies.EPISODES.strip()},
    marked AS (
        SELECT mean, CAST(date IN (SELECT date FROM episodes WHERE pollutant = 'A') AS INTEGER) AS episode
        FROM daily_fact WHERE flag = 'A'
    )
    SELECT episode, COUNT(mean) AS n, {half_up(exact_mean("mean"), 4)} AS mean,
           {half_up(f"COUNT(*) FILTER (mean > {GUIDELINE})::DOUBLE / COUNT(mean)", 4)} AS share_above,
           {half_up("QUANTILE_CONT(mean, 0.25)", 4)} AS q1, {half_up("QUANTILE_CONT(mean, 0.5)", 4)} AS median,
           {half_up("QUANTILE_CONT(mean, 0.75)", 4)} AS q3
    FROM marked GROUP BY 1""",
)
def episode_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with an episode against the others."""
    days = daily_fact(spark, sf_dir).filter(F.col("flag") == "A")
    found = proxies.episodes(spark, sf_dir).filter(F.col("pollutant") == "A")
    marked = flag_matching(days, found, "date", "episode")
    return statistics.compare_groups(marked, "episode", "mean", GUIDELINE, decimals=2)


# --- quality --------------------------------------------------------------------------------------


@register(
    "coverage_rate",
    """
    WITH h AS (SELECT DISTINCT DATE_TRUNC('hour', ts) AS t, user_id, CAST(YEAR(ts) AS INTEGER) AS year FROM events),
    possible AS (SELECT year, COUNT(DISTINCT t) AS p FROM h GROUP BY 1)
    SELECT s.user_id, p.year, round_even(100.0::DOUBLE * COALESCE(COUNT(h.t), 0) / p.p, 0) AS coverage_pct
    FROM (SELECT DISTINCT user_id FROM h) s, possible p
    LEFT JOIN h ON h.user_id = s.user_id AND h.year = p.year GROUP BY s.user_id, p.year, p.p""",
)
def coverage_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: percentage of the known hours each user was active in."""
    hours = table(spark, sf_dir, "events").select(
        "user_id", dates.floor_hour(F.col("ts")).alias("timestamp"), "event_id"
    )
    return quality.coverage(keep_first(hours, ["user_id", "timestamp"], [F.col("event_id")]), "user_id", "timestamp")


@register(
    "missing_share",
    f"""
    WITH {DENSE}, wide AS (
        SELECT date, MAX(mean) FILTER (flag = 'A') AS a, MAX(mean) FILTER (flag = 'N') AS n,
               MAX(max) FILTER (flag = 'R') AS r FROM dense GROUP BY 1
    ), c AS (SELECT COUNT(*) AS t, COUNT(date) AS d, COUNT(a) AS a, COUNT(n) AS n, COUNT(r) AS r FROM wide)
    SELECT * FROM (
        SELECT 'date' AS "column", t - d AS n_missing, (t - d)::DOUBLE / t AS share FROM c
        UNION ALL SELECT 'a', t - a, (t - a)::DOUBLE / t FROM c
        UNION ALL SELECT 'n', t - n, (t - n)::DOUBLE / t FROM c
        UNION ALL SELECT 'r', t - r, (t - r)::DOUBLE / t FROM c
    ) WHERE n_missing > 0""",
)
def missing_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: columns with missing days and their share."""
    wide = reshape.long_to_wide(
        dense_facts(spark, sf_dir),
        ["date"],
        "flag",
        {"a": ("A", F.col("mean")), "n": ("N", F.col("mean")), "r": ("R", F.col("max"))},
    )
    return quality.missing_share(wide, ["date", "a", "n", "r"])


@register(
    "collated_search",
    """
    SELECT doc_id, lang FROM documents WHERE contains(strip_accents(lower(text)), 'etionle')""",
)
def collated_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts that hold a word, whatever its case and accents."""
    found = table(spark, sf_dir, "documents").filter(contains_text(F.col("text"), "ÉTIONLE"))
    return found.select("doc_id", "lang")


def spelt_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand of each part, spelt in three ways."""
    way = F.col("p_partkey") % 3
    code = F.when(way == 0, F.lower("p_brand")).when(way == 1, F.replace("p_brand", F.lit("a"), F.lit("á"))).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("code"))


SPELT = """
spelt AS (
    SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN lower(p_brand) WHEN 1 THEN replace(p_brand, 'a', 'á') ELSE p_brand END AS code
    FROM part
)"""


@register(
    "duplicate_spellings",
    f"""
    WITH {SPELT}
    SELECT MIN(code) AS code, COUNT(DISTINCT code) AS n_spellings, COUNT(*) AS n_rows
    FROM spelt GROUP BY strip_accents(lower(code)) HAVING COUNT(*) > 1""",
)
def duplicate_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that the database would take for one."""
    return quality.duplicate_spellings(spelt_brands(spark, sf_dir), "code")


@register(
    "collated_lookup",
    f"""
    WITH {SPELT}, ids AS (SELECT code, ROW_NUMBER() OVER (ORDER BY code) AS id FROM (SELECT DISTINCT p_brand AS code FROM part))
    SELECT id AS brand_id, COUNT(*) AS n_parts FROM spelt s JOIN ids i ON strip_accents(lower(s.code)) = strip_accents(lower(i.code))
    GROUP BY 1""",
)
def collated_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers of codes however they are spelt."""
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("code")).distinct()
    ids = keys.dense_ids(brands, ["code"], "brand_id")
    found = joins.lookup_id(spelt_brands(spark, sf_dir), ids, "code", "brand_id", collation=settings.COLLATION)
    return found.groupBy("brand_id").agg(F.count("*").alias("n_parts"))


@register(
    "duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: keys that are not unique."""
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


KEY_TABLES = {
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
    "embeddings": ["vec_id"],
}


@register(
    "key_checks",
    " UNION ALL ".join(
        f"""SELECT '{name}({", ".join(key)})' AS "check", CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, COUNT(*) AS n_keys,
            CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS n_bad
            FROM (SELECT COUNT(*) AS n FROM {name} GROUP BY {", ".join(key)})"""
        for name, key in KEY_TABLES.items()
    ),
)
def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on all keyed tables."""
    return reshape.concatenate(
        *[quality.key_check(table(spark, sf_dir, name), name, key) for name, key in KEY_TABLES.items()]
    )


REFERENCES = [
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("documents", "doc_id", "labels", "doc_id"),
]


@register(
    "fk_checks",
    " UNION ALL ".join(
        f"""SELECT '{child}.{key} -> {parent}' AS "check", COUNT(*) AS n_rows, COUNT(DISTINCT c.{key}) AS n_keys,
            COUNT(*) FILTER (p.k IS NULL) AS n_bad
            FROM {child} c LEFT JOIN (SELECT DISTINCT {parent_key} AS k FROM {parent}) p ON c.{key} = p.k
            WHERE c.{key} IS NOT NULL"""
        for child, key, parent, parent_key in REFERENCES
    ),
)
def fk_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 on all references, one of which does not hold."""
    return reshape.concatenate(
        *[
            quality.reference_check(
                table(spark, sf_dir, child), table(spark, sf_dir, parent), f"{child}.{key} -> {parent}", key, parent_key
            )
            for child, key, parent, parent_key in REFERENCES
        ]
    )


@register(
    "domain_checks",
    """
    WITH c AS (
        SELECT COUNT(*) AS n, COUNT(*) FILTER (l_shipdate IS NULL) AS a, COUNT(*) FILTER (NOT l_quantity >= 0) AS b,
               COUNT(*) FILTER (NOT l_extendedprice >= 1000) AS c, COUNT(*) FILTER (LENGTH(l_returnflag) > 1) AS d
        FROM lineitem
    )
    SELECT 'l_shipdate is not null' AS "check", n AS n_rows, a AS n_bad FROM c
    UNION ALL SELECT 'l_quantity >= 0', n, b FROM c UNION ALL SELECT 'l_extendedprice >= 1000', n, c FROM c
    UNION ALL SELECT 'length(l_returnflag) <= 1', n, d FROM c""",
)
def domain_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4: all predicates in one pass."""
    return quality.predicate_checks(
        table(spark, sf_dir, "lineitem"),
        {
            **quality.not_null(["l_shipdate"]),
            "l_quantity >= 0": F.col("l_quantity") >= 0,
            "l_extendedprice >= 1000": F.col("l_extendedprice") >= 1000,
            **quality.max_length({"l_returnflag": 1}),
        },
    )


@register(
    "run_report",
    f"""
    WITH {STAR}
    SELECT 'calendar' AS "table", COUNT(*) AS n_rows, MIN(date) AS first_day, MAX(date) AS last_day FROM calendar
    UNION ALL SELECT 'daily_measurement', COUNT(*), MIN(date), MAX(date) FROM fact
    UNION ALL SELECT 'episode', COUNT(*), MIN(date), MAX(date) FROM episode
    UNION ALL SELECT 'weather_day', COUNT(*), MIN(date), MAX(date) FROM weather_day""",
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and period of each dated table."""
    tables = star_tables(spark, sf_dir)
    return quality.table_periods({name: df for name, df in tables.items() if "date" in df.columns})


@register(
    "row_reconciliation",
    f"""
    WITH {STAR}, counts AS (
        SELECT 'station' AS "table", COUNT(*) AS n FROM stations UNION ALL SELECT 'pollutant', COUNT(*) FROM pollutants
        UNION ALL SELECT 'calendar', COUNT(*) FROM calendar UNION ALL SELECT 'weather_day', COUNT(*) FROM weather_day
        UNION ALL SELECT 'daily_measurement', COUNT(*) FROM fact UNION ALL SELECT 'episode', COUNT(*) FROM episode
    )
    SELECT "table", n AS n_source, n AS n_stored, TRUE AS ok FROM counts""",
)
def row_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that were built and of those that were stored."""
    return sinks.reconcile(proxies.built_star(spark, sf_dir), star_tables(spark, sf_dir))


@register(
    "weather_report",
    f"""
    WITH {WEATHER}
    SELECT MIN(date) AS first_day, MAX(date) AS last_day, COUNT(*) AS days,
           DATE_DIFF('day', MIN(date), MAX(date)) + 1 - COUNT(*) AS missing_days
    FROM weather""",
)
def weather_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 on the weather: days missing in its period."""
    return context.weather_report(proxies.weather(spark, sf_dir))[0]
