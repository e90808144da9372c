"""Cleaning, de-duplication and daily aggregates (A, B, C, E1-E10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas, settings
from sensorloom.catalog import proxies
from sensorloom.catalog.proxies import DAILY_FACT, table
from sensorloom.catalog.registry import exact_mean, half_even, register
from sensorloom.functions import dates, numeric, text
from sensorloom.operators import dedup, filters, joins, reshape
from sensorloom.operators.completeness import aggregate_daily
from sensorloom.plans import context, measurements


@register(
    "daily_completeness",
    f"""
    WITH hourly AS (
        SELECT DATE_TRUNC('hour', ts) AS hour, event_type, value,
               ROW_NUMBER() OVER (PARTITION BY DATE_TRUNC('hour', ts), event_type ORDER BY event_id) AS rn
        FROM events
    )
    SELECT CAST(hour AS DATE) AS date, event_type, {half_even(exact_mean("value"), 2)} AS mean,
           {half_even("MAX(value)", 2)} AS max, COUNT(value) AS n_hours
    FROM hourly WHERE rn = 1 GROUP BY 1, 2 HAVING COUNT(value) >= 22""",
)
def daily_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reading of each hour, then the days with enough hours."""
    return hourly_then_daily(spark, sf_dir, ["event_type"], min_hours=22)


def hourly_then_daily(spark: SparkSession, sf_dir: str, keys: list[str], min_hours: int) -> DataFrame:
    readings = table(spark, sf_dir, "events").select(
        dates.floor_hour(F.col("ts")).alias("timestamp"), *keys, "value", "event_id"
    )
    hourly = dedup.keep_first(readings, ["timestamp", *keys], [F.col("event_id")], unique_order=True)
    return aggregate_daily(
        hourly, dates.day_of(F.col("timestamp")), keys, "value", min_hours, decimals=2
    )


@register(
    "daily_fact",
    f"""
    SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS flag,
           {half_even(exact_mean("l_quantity"), 2)} AS mean, {half_even("MAX(l_quantity)", 2)} AS max,
           COUNT(l_quantity) AS n_hours
    FROM lineitem GROUP BY 1, 2 HAVING COUNT(l_quantity) >= 5""",
)
def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 over line items: a day needs five of them."""
    return aggregate_daily(
        table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_returnflag": "flag", "l_quantity": "value"}),
        proxies.ship_day(),
        ["flag"],
        "value",
        min_hours=5,
        decimals=2,
    )


@register(
    "segment_daily",
    f"""
    SELECT CAST(ts AS DATE) AS date, user_id AS segment, event_type AS pollutant_code,
           {half_even(exact_mean("value"), 2)} AS mean, COUNT(value) AS n_hours
    FROM events GROUP BY 1, 2, 3 HAVING COUNT(value) >= 2""",
)
def segment_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mean and a count per segment, with no zone shift, clamp or de-duplication."""
    segments = table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"),
        F.col("user_id").alias("segment"),
        F.col("event_type").alias("pollutant_code"),
        "value",
    )
    return measurements.segment_daily(segments, min_hours=2, decimals=2)


WIDE = f"""
    {DAILY_FACT},
    wide AS (
        SELECT date, MAX(mean) FILTER (flag = 'A') AS a, MAX(mean) FILTER (flag = 'N') AS n,
               MAX(mean) FILTER (flag = 'R') AS r, MAX(max) FILTER (flag = 'A') AS a_max
        FROM daily_fact GROUP BY date
    )"""


def wide_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean, peak = F.col("mean"), F.col("max")
    return reshape.long_to_wide(
        proxies.daily_fact(spark, sf_dir),
        ["date"],
        "flag",
        {"a": ("A", mean), "n": ("N", mean), "r": ("R", mean), "a_max": ("A", peak)},
    )


@register("long_to_wide", f"WITH {WIDE} SELECT * FROM wide")
def long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column per flag, and the maximum of one of them."""
    return wide_facts(spark, sf_dir)


@register(
    "wide_to_long",
    f"""
    WITH {WIDE}
    SELECT date, 'a' AS series, a AS value FROM wide WHERE a IS NOT NULL
    UNION ALL SELECT date, 'n', n FROM wide WHERE n IS NOT NULL
    UNION ALL SELECT date, 'r', r FROM wide WHERE r IS NOT NULL""",
)
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: a row per filled cell."""
    return reshape.wide_to_long(wide_facts(spark, sf_dir), ["date"], ["a", "n", "r"], "series", "value")


@register(
    "clamp_and_coerce",
    """
    SELECT event_id, CASE WHEN number < 0 THEN 0.0 ELSE number END AS value
    FROM (
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN TRY_CAST(props AS DOUBLE) ELSE value - 50 END AS number
        FROM events
    ) WHERE number IS NOT NULL""",
)
def clamp_and_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to numbers, what is no number is dropped, negatives become 0."""
    raw = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.concat(F.lit(" "), (F.col("value") - 50).cast("string"))
    )
    numbers = table(spark, sf_dir, "events").select("event_id", numeric.to_double(raw).alias("number"))
    return filters.complete_rows(numbers, ["number"]).select(
        "event_id", numeric.clamp_floor(F.col("number")).alias("value")
    )


@register(
    "audit_cleaning",
    """
    WITH cells AS (SELECT DATE_TRUNC('hour', ts) AS hour, event_type, value - 50 AS v FROM events),
    hours AS (SELECT DISTINCT hour, event_type FROM cells),
    days AS (SELECT CAST(hour AS DATE) AS d, event_type, COUNT(*) AS n FROM hours GROUP BY 1, 2)
    SELECT COUNT(*) AS n_values, COUNT(*) FILTER (v < 0) AS n_negative, MIN(v) AS lowest_value,
           COUNT(*) - (SELECT COUNT(*) FROM hours) AS n_duplicates,
           (SELECT COUNT(*) FROM days) AS n_days,
           (SELECT COUNT(*) FROM days WHERE n < 22) AS n_days_rejected
    FROM cells""",
)
def audit_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: what the cleaning of hourly readings changed."""
    cells = table(spark, sf_dir, "events").select(
        dates.floor_hour(F.col("ts")).alias("timestamp"),
        F.lit("all").alias("station_code"),
        F.col("event_type").alias("pollutant_code"),
        (F.col("value") - 50).alias("raw_value"),
        "event_id",
    )
    hourly = dedup.keep_first(
        cells.withColumn("value", numeric.clamp_floor(F.col("raw_value"))),
        measurements.HOURLY_KEY,
        [F.col("event_id")],
        unique_order=False,
    )
    return measurements.cleaning_audit(measurements.count_values(cells), hourly, min_hours=22)


@register(
    "utc_to_local_day",
    """
    SELECT local_day, local_hour, COUNT(*) AS n FROM (
        SELECT CAST(t AS DATE) AS local_day, CAST(HOUR(t) AS INTEGER) AS local_hour FROM (
            SELECT ((l_shipdate + TO_HOURS(l_linenumber) - INTERVAL 1 HOUR) AT TIME ZONE 'UTC')
                   AT TIME ZONE 'Europe/Paris' AS t
            FROM lineitem
        )
    ) GROUP BY 1, 2""",
)
def utc_to_local_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of hours in UTC as local days and hours, through both clock changes."""
    end = F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate"))
    local = table(spark, sf_dir, "lineitem").select(dates.hour_start_local(end).alias("t"))
    return local.groupBy(
        dates.day_of(F.col("t")).alias("local_day"), F.hour("t").alias("local_hour")
    ).agg(F.count("*").alias("n"))


@register(
    "keep_first",
    """
    SELECT date, status, o_orderkey, o_totalprice, o_orderpriority FROM (
        SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS status, o_orderkey, o_totalprice,
               o_orderpriority,
               ROW_NUMBER() OVER (PARTITION BY CAST(o_orderdate AS DATE), o_orderstatus ORDER BY o_orderkey) AS rn
        FROM orders
    ) WHERE rn = 1""",
)
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of each day and status."""
    return dedup.keep_first(daily_orders(spark, sf_dir), ["date", "status"], [F.col("o_orderkey")])


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        proxies.order_day().alias("date"),
        F.col("o_orderstatus").alias("status"),
        "o_orderkey",
        "o_totalprice",
        "o_orderpriority",
    )


@register(
    "priority_dedup",
    """
    SELECT date, status, o_orderkey, o_totalprice, o_orderpriority FROM (
        SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS status, o_orderkey, o_totalprice,
               o_orderpriority,
               ROW_NUMBER() OVER (
                   PARTITION BY CAST(o_orderdate AS DATE), o_orderstatus
                   ORDER BY CASE o_orderpriority WHEN '2-HIGH' THEN 0 WHEN '1-URGENT' THEN 1
                                                 WHEN '5-LOW' THEN 2 ELSE 9 END, o_orderkey) AS rn
        FROM orders
    ) WHERE rn = 1""",
)
def priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order whose priority ranks best; unlisted ones come last."""
    ranks = {"2-HIGH": 0, "1-URGENT": 1, "5-LOW": 2}
    return dedup.keep_preferred(
        daily_orders(spark, sf_dir),
        ["date", "status"],
        "o_orderpriority",
        ranks,
        settings.UNKNOWN_SOURCE_RANK,
        [F.col("o_orderkey")],
    )


@register(
    "first_seen_dimension",
    """
    SELECT l_suppkey AS station, l_returnflag AS name, l_linestatus AS unit FROM (
        SELECT l_suppkey, l_returnflag, l_linestatus,
               ROW_NUMBER() OVER (PARTITION BY l_suppkey
                                  ORDER BY l_shipdate, l_orderkey, l_returnflag, l_linestatus) AS rn
        FROM lineitem
    ) WHERE rn = 1""",
)
def first_seen_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier with the flags it was first seen with."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station"),
        F.col("l_returnflag").alias("name"),
        F.col("l_linestatus").alias("unit"),
        "l_shipdate",
        "l_orderkey",
    )
    return dedup.first_seen(items, "station", ["name", "unit"], [F.col("l_shipdate"), F.col("l_orderkey")])


@register(
    "spliced_series",
    f"""
    WITH {proxies.STAR}
    SELECT date, pollutant_code, mean, max, n_hours, station_code AS source_station FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY date, pollutant_code
                                     ORDER BY CASE station_code WHEN '{proxies.STATIONS[0]}' THEN 0 ELSE 1 END) AS rn
        FROM daily WHERE station_code IN ('{proxies.STATIONS[0]}', '{proxies.STATIONS[1]}')
    ) WHERE rn = 1""",
)
def spliced_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stations as one series, with the station each day came from."""
    daily = proxies.station_daily(spark, sf_dir)
    return dedup.splice(
        daily, ["date", "pollutant_code"], "station_code", proxies.STATIONS, "source_station"
    )


@register(
    "classify_text",
    r"""
    WITH named AS (
        SELECT p_partkey, p_size, CASE WHEN p_size <= 10 THEN p_type || ' route ' || p_name
                    WHEN p_size <= 20 THEN 'Champigny-sur-Marne ' || p_name
                    WHEN p_size <= 30 THEN 'RN' || p_size || ' ' || p_name
                    WHEN p_size <= 40 THEN 'Zone RURALE ' || p_name
                    ELSE 'Tour Eiffel ' || p_brand END AS name
        FROM part
    )
    SELECT p_partkey,
           CASE WHEN LOWER(name) LIKE '%rural%' OR LOWER(name) LIKE '%rambouillet%' THEN 'rural'
                WHEN LOWER(name) LIKE '%tour eiffel%' THEN 'observation'
                WHEN regexp_matches(LOWER(name), '\b(boulevard|avenue|place|rue|quai|autoroute|route|rn\s?\d|rd\s?\d)')
                THEN 'traffic' ELSE 'urban_background' END AS station_type,
           CASE p_size WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE NULL END AS known,
           CASE WHEN p_partkey = 0 THEN 'region' WHEN LENGTH(CAST(p_partkey AS VARCHAR)) <= 2 THEN 'department'
                ELSE 'municipality' END AS geo_level,
           CAST(regexp_matches(name, 'RN2|RN3') AND p_type = 'PROMO' AS INTEGER) AS promo_road
    FROM named JOIN part USING (p_partkey, p_size)""",
)
def classify_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of names and codes, first rule wins."""
    size, kind, plain = F.col("p_size"), F.col("p_type"), F.col("p_name")
    name = (
        F.when(size <= 10, F.concat(kind, F.lit(" route "), plain))
        .when(size <= 20, F.concat(F.lit("Champigny-sur-Marne "), plain))
        .when(size <= 30, F.concat(F.lit("RN"), size.cast("string"), F.lit(" "), plain))
        .when(size <= 40, F.concat(F.lit("Zone RURALE "), plain))
        .otherwise(F.concat(F.lit("Tour Eiffel "), F.col("p_brand")))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.station_type(name).alias("station_type"),
        text.harmonise(size.cast("string"), {"1": "one", "2": "two"}).alias("known"),
        text.geo_level(F.col("p_partkey")).alias("geo_level"),
        filters.matches_and_type(name, "RN2|RN3", kind, "PROMO").cast("int").alias("promo_road"),
    )


@register(
    "parse_dates",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS french, CAST(o_orderdate AS DATE) AS compact,
           CAST(((o_orderdate + INTERVAL 23 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS DATE) AS slashed,
           CAST(((o_orderdate + INTERVAL 22 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS DATE) AS iso,
           STRFTIME(o_orderdate, '%Y-%m-%d') AS day_text,
           CAST(ISODOW(o_orderdate) AS INTEGER) AS weekday_1, CAST(ISODOW(o_orderdate) - 1 AS INTEGER) AS weekday_0,
           CAST(ISODOW(o_orderdate) >= 6 AS INTEGER) AS is_weekend
    FROM orders""",
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four spellings of a day, its weekday and its text."""
    clock, day = F.col("o_orderdate"), proxies.order_day()

    def at(hours, form):
        return F.date_format(F.timestamp_add("HOUR", F.lit(hours), clock), form)

    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.french_day(F.date_format(clock, "dd/MM/yyyy")).alias("french"),
        dates.compact_day(F.date_format(clock, "yyyyMMdd")).alias("compact"),
        dates.slashed_utc_to_local_day(F.concat(at(23, "yyyy/MM/dd HH:mm:ss"), F.lit("+00"))).alias("slashed"),
        dates.iso_to_local_day(F.concat(at(22, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))).alias("iso"),
        dates.iso_day_text(day).alias("day_text"),
        dates.weekday_from_1(day).alias("weekday_1"),
        dates.weekday_from_0(day).alias("weekday_0"),
        dates.is_weekend(day).alias("is_weekend"),
    )


@register(
    "normalise_names",
    """
    SELECT doc_id, MD5(TRANSLATE(TRIM(TRANSLATE(LOWER(text), 'éèêàâôûîç', 'eeeaaouic'), ' '), ''' ', '__')) AS digest,
           LENGTH(text) AS n
    FROM documents""",
)
def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B12 on whole texts."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text.normalise(F.col("text"))).alias("digest"),
        F.length("text").cast("bigint").alias("n"),
    )


@register(
    "existence_flags",
    """
    SELECT c_custkey,
           CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS INTEGER) AS has_urgent
    FROM customer""",
)
def existence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does a customer have an urgent order?"""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return joins.flag_matching(
        table(spark, sf_dir, "customer").select("c_custkey"),
        urgent.select(F.col("o_custkey").alias("c_custkey")),
        "c_custkey",
        "has_urgent",
    )


@register(
    "semi_keep",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
    WHERE CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity = 50)""",
)
def semi_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on days that have a full-quantity line item."""
    full = table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") == 50)
    return joins.keep_matching(
        table(spark, sf_dir, "orders").select("o_orderkey", proxies.order_day().alias("date")),
        full.select(proxies.ship_day().alias("date")),
        "date",
    )


@register(
    "anti_missing",
    """
    SELECT date, s_suppkey FROM (
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, s_suppkey
        FROM (SELECT o_orderdate, l_suppkey AS s_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
    ) t WHERE NOT EXISTS (
        SELECT 1 FROM lineitem l WHERE CAST(l.l_shipdate AS DATE) = t.date AND l.l_suppkey = t.s_suppkey)""",
)
def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected (day, station) pairs without any measurement."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    expected = (
        table(spark, sf_dir, "orders")
        .join(items, "o_orderkey")
        .select(proxies.order_day().alias("date"), F.col("l_suppkey").alias("s_suppkey"))
        .distinct()
    )
    found = table(spark, sf_dir, "lineitem").select(
        proxies.ship_day().alias("date"), F.col("l_suppkey").alias("s_suppkey")
    )
    return joins.keep_missing(expected, found, ["date", "s_suppkey"])


@register(
    "known_values",
    """
    SELECT o_orderkey, o_orderpriority, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS kept
    FROM orders""",
)
def known_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of known values, and the rest reported."""
    kept, rejected = filters.split_known(
        table(spark, sf_dir, "orders"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    )
    both = [rows.select("o_orderkey", "o_orderpriority", F.lit(flag).alias("kept")) for flag, rows in ((1, kept), (0, rejected))]
    return reshape.concatenate(*both)


@register(
    "interval_to_days",
    """
    SELECT date, o_orderstatus AS holiday_name FROM (
        SELECT CAST(o_orderdate AS DATE) + CAST(k AS INTEGER) AS date, o_orderstatus,
               ROW_NUMBER() OVER (PARTITION BY CAST(o_orderdate AS DATE) + CAST(k AS INTEGER) ORDER BY o_orderkey) AS rn
        FROM (SELECT *, UNNEST(GENERATE_SERIES(0, LENGTH(o_orderpriority) - 6 - 1)) AS k
              FROM orders WHERE LENGTH(o_orderpriority) > 6)
    ) WHERE rn = 1""",
)
def interval_to_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods as days, the end excluded, the first period wins; empty ones give nothing."""
    periods = table(spark, sf_dir, "orders").select(
        proxies.order_day().alias("start"),
        F.date_add(proxies.order_day(), F.length("o_orderpriority") - 6).alias("end"),
        F.col("o_orderstatus").alias("holiday_name"),
        "o_orderkey",
    )
    days = joins.expand_intervals(
        periods, F.col("start"), F.col("end"), "date", ["holiday_name", "o_orderkey"]
    )
    return dedup.keep_first(days, ["date"], [F.col("o_orderkey")]).drop("o_orderkey")


@register(
    "conformed_columns",
    """
    SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS temp_mean_c,
           CAST(NULL AS DOUBLE) AS temp_min_c, CAST(NULL AS DOUBLE) AS temp_max_c,
           CAST(NULL AS DOUBLE) AS humidity_mean_pct, CAST(NULL AS DOUBLE) AS pressure_mean_hpa,
           CAST(NULL AS DOUBLE) AS rain_mm, CAST(NULL AS DOUBLE) AS wind_mean_ms,
           CAST(NULL AS DOUBLE) AS wind_max_ms, CAST(o_custkey AS DOUBLE) AS wind_dir_deg
    FROM orders""",
)
def conformed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns in order; the missing ones are NULL."""
    return reshape.conform(
        table(spark, sf_dir, "orders"),
        schemas.WEATHER_DAY,
        {"date": "o_orderdate", "temp_mean_c": "o_totalprice", "wind_dir_deg": "o_custkey"},
    )


@register(
    "study_period",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
    WHERE o_orderdate >= DATE '1996-02-01' AND o_orderdate <= DATE '1999-09-21'""",
)
def study_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an inclusive period."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", proxies.order_day().alias("date"))
    return context.in_study_period(orders, "1996-02-01", "1999-09-21")
