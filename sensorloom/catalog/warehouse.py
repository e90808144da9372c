"""Star schema, denormalised table, query library and reads (D, E, G, H, M9-M13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.catalog import proxies
from sensorloom.catalog.proxies import (
    BACKGROUND,
    DAILY_FACT,
    FLAG,
    GUIDELINE,
    STAR,
    STATION_TYPES,
    STATIONS,
    TRAFFIC,
    built_star,
    denormalised,
    star_tables,
    table,
)
from sensorloom.catalog.registry import exact_mean, half_up, register
from sensorloom.functions.numeric import classes_right_closed
from sensorloom.operators import filters, keys, nested, paging, quality
from sensorloom.plans import analysis, dataset, reads, star
from sensorloom.session import scratch_path
from sensorloom.sources import sinks

STATION_LIST = ", ".join(f"'{code}'" for code in STATIONS)


# --- query library on the star schema ---------------------------------------------------------


@register(
    "star_yearly_mean",
    f"""
    WITH {STAR}
    SELECT CAST(YEAR(f.date) AS INTEGER) AS year, f.station_type,
           {half_up(exact_mean("f.mean"), 1)} AS pm25_mean_ug_m3, COUNT(DISTINCT f.station_id) AS n_stations
    FROM fact f JOIN calendar c ON f.date = c.date
    WHERE f.pollutant_code = '{FLAG}' AND f.station_type IN ('{BACKGROUND}', '{TRAFFIC}')
    GROUP BY 1, 2""",
)
def star_yearly_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: D1, E3."""
    return analysis.yearly_mean_by_type(star_tables(spark, sf_dir), FLAG, (BACKGROUND, TRAFFIC))


@register(
    "monthly_share_above",
    f"""
    WITH {STAR}
    SELECT c.month, COUNT(*) AS days_measured, COUNT(*) FILTER (f.mean > {GUIDELINE}) AS days_above_who,
           {half_up(f"100.0::DOUBLE * COUNT(*) FILTER (f.mean > {GUIDELINE}) / COUNT(*)", 1)} AS pct_days_above_who,
           {half_up(exact_mean("f.mean"), 1)} AS pm25_mean_ug_m3
    FROM fact f JOIN calendar c ON f.date = c.date
    WHERE f.pollutant_code = '{FLAG}' AND f.station_code IN ({STATION_LIST})
    GROUP BY 1""",
)
def monthly_share_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: E4."""
    return analysis.monthly_risk(star_tables(spark, sf_dir), FLAG, STATIONS, GUIDELINE)


@register(
    "category_side_by_side",
    f"""
    WITH {STAR},
    by_type AS (
        SELECT c.year, f.station_type, {exact_mean("f.mean")} AS m
        FROM fact f JOIN calendar c ON f.date = c.date
        WHERE f.pollutant_code = '{FLAG}' AND f.station_type IN ('{BACKGROUND}', '{TRAFFIC}') GROUP BY 1, 2
    ),
    wide AS (
        SELECT year, MAX(CASE WHEN station_type = '{BACKGROUND}' THEN m END) AS b,
               MAX(CASE WHEN station_type = '{TRAFFIC}' THEN m END) AS t
        FROM by_type GROUP BY year
    )
    SELECT year, {half_up("b", 1)} AS no2_background_ug_m3, {half_up("t", 1)} AS no2_traffic_ug_m3,
           {half_up("t - b", 1)} AS traffic_excess_ug_m3, {half_up("t / NULLIF(b, 0)", 2)} AS traffic_background_ratio
    FROM wide""",
)
def category_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: E11, B21."""
    return analysis.traffic_excess(star_tables(spark, sf_dir), FLAG, BACKGROUND, TRAFFIC)


@register(
    "worst_days_context",
    f"""
    WITH {STAR},
    worst AS (
        SELECT * FROM fact WHERE pollutant_code = '{FLAG}' AND station_code IN ({STATION_LIST})
        ORDER BY mean DESC, date, station_code LIMIT 10
    )
    SELECT x.date, x.station_code, {half_up("x.mean", 1)} AS pm25_ug_m3, w.temp_mean_c, w.wind_mean_ms, w.rain_mm,
           w.pressure_mean_hpa
    FROM worst x LEFT JOIN weather_day w ON x.date = w.date""",
)
def worst_days_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: G1, D2."""
    return analysis.worst_days(star_tables(spark, sf_dir), FLAG, STATIONS)


@register(
    "episode_day_before",
    f"""
    WITH {STAR},
    centre AS (
        SELECT date, mean AS v, LAG(mean) OVER (ORDER BY date) AS before
        FROM fact WHERE pollutant_code = '{FLAG}' AND station_code IN ('{STATIONS[0]}')
    )
    SELECT e.date, p.pollutant_code AS episode_pollutant, e.level, e.forecast_result,
           {half_up("x.before", 1)} AS pm25_day_before_ug_m3, {half_up("x.v", 1)} AS pm25_day_ug_m3,
           CAST(x.v > {GUIDELINE} AS INTEGER) AS above_who
    FROM episode e JOIN pollutants p USING (pollutant_id) LEFT JOIN centre x ON x.date = e.date""",
)
def episode_day_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: F1, D10, B16."""
    return analysis.episodes_and_measurements(star_tables(spark, sf_dir), FLAG, STATIONS[:1], GUIDELINE)


@register(
    "yearly_by_type",
    f"""
    WITH {STAR}
    SELECT CAST(YEAR(date) AS INTEGER) AS year,
           {half_up(exact_mean(f"CASE WHEN station_type = '{BACKGROUND}' THEN mean END"), 1)} AS "{BACKGROUND}",
           {half_up(exact_mean(f"CASE WHEN station_type = '{TRAFFIC}' THEN mean END"), 1)} AS "{TRAFFIC}"
    FROM fact WHERE pollutant_code = '{FLAG}' GROUP BY 1""",
)
def yearly_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same question on the daily table by code."""
    return dataset.yearly_by_type(
        proxies.station_daily(spark, sf_dir), proxies.stations(spark, sf_dir), FLAG, [BACKGROUND, TRAFFIC]
    )


# --- denormalised table -------------------------------------------------------------------------

DENORMALISED = f"""
{STAR},
denormalised AS (
    SELECT f.date, c.year, c.month, c.day_of_week, c.is_weekend, c.is_public_holiday, c.is_school_holiday,
           f.station_code, f.station_name, f.station_type, f.pollutant_code, f.pollutant_name, f.unit,
           f.mean AS daily_mean, f.max AS hourly_max, f.n_hours,
           CASE WHEN f.pollutant_code = '{FLAG}' THEN CAST(f.mean > {GUIDELINE} AS INTEGER) END AS above_who_pm25,
           w.temp_mean_c, w.temp_min_c, w.temp_max_c, w.humidity_mean_pct, w.pressure_mean_hpa, w.rain_mm,
           w.wind_mean_ms, w.wind_max_ms, w.wind_dir_deg, e.level AS episode_level
    FROM fact f LEFT JOIN calendar c ON f.date = c.date LEFT JOIN weather_day w ON f.date = w.date
    LEFT JOIN episode e ON f.date = e.date AND f.pollutant_id = e.pollutant_id
)"""


@register("denormalised_daily", f"WITH {DENORMALISED} SELECT * FROM denormalised")
def denormalised_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3, B13, B17."""
    return star.denormalise(star_tables(spark, sf_dir), FLAG, GUIDELINE)


MONTHS_1998 = f"""
    WITH {DENORMALISED}
    SELECT month, {half_up(exact_mean("daily_mean"), 1)} AS pm25_mean_ug_m3,
           CAST(SUM(above_who_pm25) AS BIGINT) AS days_above_who
    FROM denormalised WHERE year = 1998 AND pollutant_code = '{FLAG}' AND station_code = '{STATIONS[0]}'
    GROUP BY month"""


@register("pruned_month", MONTHS_1998)
def pruned_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned table, read with its partition filter."""
    stored = denormalised(spark, sf_dir).filter(F.col("year") == 1998)
    return analysis.month_of_year(stored, FLAG, STATIONS[0])


@register("date_range_month", MONTHS_1998)
def date_range_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day range on the partitioned table, with the year range that prunes beside it."""
    stored = filters.with_date_range(denormalised(spark, sf_dir), "1998-01-01", "1998-12-31")
    return analysis.month_of_year(stored, FLAG, STATIONS[0])


@register(
    "type_means",
    f"""
    WITH {DENORMALISED}
    SELECT year,
           {half_up(exact_mean(f"CASE WHEN station_type = '{BACKGROUND}' THEN daily_mean END"), 1)} AS no2_background,
           {half_up(exact_mean(f"CASE WHEN station_type = '{TRAFFIC}' THEN daily_mean END"), 1)} AS no2_traffic
    FROM denormalised WHERE pollutant_code = '{FLAG}' GROUP BY year""",
)
def type_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: conditional means without a join."""
    return analysis.type_means(denormalised(spark, sf_dir), FLAG, BACKGROUND, TRAFFIC)


@register(
    "class_left_closed",
    f"""
    WITH {DENORMALISED}
    SELECT CASE WHEN wind_mean_ms < 2 THEN '1. calm (< 2 m/s)' WHEN wind_mean_ms < 4 THEN '2. light (2-4 m/s)'
                WHEN wind_mean_ms < 6 THEN '3. moderate (4-6 m/s)' ELSE '4. strong (>= 6 m/s)' END AS wind_class,
           COUNT(*) AS days, {half_up(exact_mean("daily_mean"), 1)} AS pm25_mean_ug_m3,
           {half_up("100.0::DOUBLE * SUM(above_who_pm25) / COUNT(above_who_pm25)", 1)} AS pct_days_above_who
    FROM denormalised
    WHERE pollutant_code = '{FLAG}' AND station_code IN ({STATION_LIST}) AND wind_mean_ms IS NOT NULL
    GROUP BY 1""",
)
def class_left_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B19, C11."""
    return analysis.wind_classes(denormalised(spark, sf_dir), FLAG, STATIONS)


@register("rows_per_year", f"WITH {DENORMALISED} SELECT year, COUNT(*) AS n_rows FROM denormalised GROUP BY 1")
def rows_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E18."""
    return analysis.rows_per_year(denormalised(spark, sf_dir))


@register(
    "class_right_closed",
    """
    SELECT class, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM (
        SELECT l_quantity, CASE WHEN l_quantity <= 1 THEN NULL WHEN l_quantity <= 10 THEN '(1, 10]'
                    WHEN l_quantity <= 20 THEN '(10, 20]' WHEN l_quantity <= 45 THEN '(20, 45]' END AS class
        FROM lineitem
    ) WHERE class IS NOT NULL GROUP BY 1""",
)
def class_right_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies outside all classes is left out."""
    label = classes_right_closed(
        F.col("l_quantity"), [1.0, 10.0, 20.0, 45.0], ["(1, 10]", "(10, 20]", "(20, 45]"]
    )
    classed = table(spark, sf_dir, "lineitem").select("l_quantity", label.alias("class"))
    return (
        classed.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )


# --- surrogate keys -------------------------------------------------------------------------------


@register(
    "dense_ids",
    f"WITH {DAILY_FACT} SELECT ROW_NUMBER() OVER (ORDER BY date, flag) AS measurement_id, * FROM daily_fact",
)
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts numbered in day and code order."""
    return keys.dense_ids(proxies.daily_fact(spark, sf_dir), ["date", "flag"], "measurement_id")


@register(
    "star_facts",
    f"""
    WITH {STAR}
    SELECT measurement_id, date, station_id, pollutant_id, mean, max, n_hours FROM fact""",
)
def star_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table with all its keys."""
    return star.fact_rows(
        proxies.station_daily(spark, sf_dir),
        star.station_ids(proxies.stations(spark, sf_dir)),
        star.pollutant_ids(proxies.pollutants(spark, sf_dir)),
    )


@register("star_calendar", f"WITH {STAR} SELECT * FROM calendar")
def star_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar dimension."""
    return star.calendar_dimension(
        proxies.station_daily(spark, sf_dir),
        proxies.public_holidays(spark, sf_dir),
        proxies.school_days(spark, sf_dir),
    )


@register(
    "star_episodes",
    f"""
    WITH {STAR}
    SELECT ROW_NUMBER() OVER (ORDER BY date, pollutant_id) AS episode_id, date, pollutant_id, level, source,
           forecast, observed, forecast_result, CAST(NULL AS INTEGER) AS criterion_population,
           CAST(NULL AS INTEGER) AS criterion_area
    FROM episode""",
)
def star_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of known pollutants within the calendar."""
    return built_star(spark, sf_dir)["episode"]


# --- reads ----------------------------------------------------------------------------------------

WANTED = reads.MeasurementFilter(pollutant=FLAG.lower(), start="1997-01-01", end="1999-12-31", min_value=20.0)
MATCHING = f"""
    {STAR},
    matching AS (
        SELECT date, station_code, pollutant_code, {half_up("mean", 2)} AS mean, {half_up("max", 2)} AS max,
               n_hours, unit
        FROM fact WHERE pollutant_code = '{FLAG}' AND date >= DATE '1997-01-01' AND date <= DATE '1999-12-31'
                    AND mean >= 20.0
    )"""


@register("optional_filters", f"WITH {MATCHING} SELECT * FROM matching")
def optional_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the filters that were given apply."""
    return reads.measurements_matching(star_tables(spark, sf_dir), WANTED).drop("measurement_id")


@register(
    "page_of_rows",
    f"WITH {MATCHING} SELECT * FROM matching ORDER BY date DESC, station_code, pollutant_code LIMIT 100 OFFSET 200",
)
def page_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page; a larger page size is capped at 100."""
    rows, _ = reads.list_measurements(star_tables(spark, sf_dir), WANTED, page=3, per_page=500)
    return rows.drop("measurement_id")


DEEP_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"


@register(
    "deep_page",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY {DEEP_ORDER} LIMIT 100 OFFSET 15000""",
)
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 far down: rows are numbered in parallel, nothing is skipped in one task, one or two files are read."""
    page = paging.page_of_numbered(numbered_items(spark, sf_dir), page=151, per_page=100)
    return page.select("l_orderkey", "l_linenumber", "l_partkey")


def numbered_items(spark: SparkSession, sf_dir: str) -> paging.Numbered:
    """All line items in the order of the deep pages."""
    order = [F.col(name) for name in DEEP_ORDER.split(", ")]
    return paging.numbered(table(spark, sf_dir, "lineitem"), order)


@register(
    "deep_page_info",
    """
    SELECT 151 AS page, 100 AS per_page, COUNT(*) AS total_items, CAST(CEIL(COUNT(*) / 100.0) AS INTEGER) AS total_pages,
           CASE WHEN 151 < CEIL(COUNT(*) / 100.0) THEN 152 END AS next_page, 150 AS previous_page
    FROM lineitem""",
)
def deep_page_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the numbered rows, from their index."""
    return paging.page_info(numbered_items(spark, sf_dir), 151, 100)


@register(
    "page_after",
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 20""",
)
def page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 by key: the page after a known row."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return paging.page_after(rows, F.col("o_orderkey") > 5000, [F.col("o_orderkey")])


@register(
    "page_info",
    f"""
    WITH {MATCHING}
    SELECT 3 AS page, 100 AS per_page, COUNT(*) AS total_items,
           CAST(GREATEST(1, CEIL(COUNT(*) / 100.0)) AS INTEGER) AS total_pages,
           CASE WHEN 3 < CEIL(COUNT(*) / 100.0) THEN 4 END AS next_page, 2 AS previous_page
    FROM matching""",
)
def page_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E21, G3."""
    _, info = reads.list_measurements(star_tables(spark, sf_dir), WANTED, page=3, per_page=500)
    return info


@register(
    "station_page",
    f"""
    WITH {STAR}
    SELECT station_code, station_name, station_type FROM stations
    WHERE station_type = 'EUROPE' AND CONTAINS(LOWER(station_name), 'nation_1')
    ORDER BY station_code LIMIT 20""",
)
def station_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations by type and part of a name."""
    wanted = reads.StationFilter("EUROPE", "Nation_1", STATION_TYPES)
    return reads.list_stations(star_tables(spark, sf_dir), wanted)[0]


SUMMARY = f"""
    SELECT f.station_code, f.station_name, f.station_type, f.pollutant_code, f.unit, COUNT(*) AS days_measured,
           MIN(f.date) AS first_day, MAX(f.date) AS last_day, {exact_mean("f.mean")} AS overall_mean,
           CASE WHEN f.pollutant_code = '{FLAG}' THEN COUNT(*) FILTER (f.mean > {GUIDELINE}) END AS days_above_who_pm25
    FROM fact f GROUP BY 1, 2, 3, 4, 5"""


@register("station_document", f"WITH {STAR} {SUMMARY}")
def station_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents of all stations, unfolded again for the comparison."""
    documents = reads.station_documents(star_tables(spark, sf_dir), FLAG, GUIDELINE)
    unfolded = documents.select("station_code", "station_name", "station_type", F.explode("pollutants").alias("p"))
    return unfolded.select("station_code", "station_name", "station_type", "p.*")


@register("one_station", f"WITH {STAR} SELECT * FROM ({SUMMARY}) WHERE station_code = UPPER('{STATIONS[0]}')")
def one_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point lookup, the code in any case."""
    document = reads.get_station(star_tables(spark, sf_dir), STATIONS[0].lower(), flagged=FLAG, threshold=GUIDELINE)
    unfolded = document.select("station_code", "station_name", "station_type", F.explode("pollutants").alias("p"))
    return unfolded.select("station_code", "station_name", "station_type", "p.*")


@register(
    "measurement_document",
    f"""
    WITH {STAR}, by_day AS (
        SELECT e.date, STRING_AGG(p.pollutant_code || ':' || e.level || ':' || e.source, '|' ORDER BY p.pollutant_code) AS listed
        FROM episode e JOIN pollutants p USING (pollutant_id) GROUP BY 1
    )
    SELECT f.measurement_id, f.date, f.mean AS daily_mean, f.max AS hourly_max, f.n_hours AS hours_measured,
           f.station_code AS code, f.station_type AS type, f.pollutant_code, f.unit,
           w.temp_mean_c, w.rain_mm, w.wind_mean_ms, w.pressure_mean_hpa,
           COALESCE(b.listed, '') AS episodes,
           CASE WHEN f.pollutant_code = '{FLAG}' THEN CAST(f.mean > {GUIDELINE} AS INTEGER) END AS above
    FROM fact f LEFT JOIN weather_day w ON f.date = w.date LEFT JOIN by_day b ON f.date = b.date""",
)
def measurement_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: nested documents of all measurements, flattened for the comparison."""
    documents = reads.measurement_documents(star_tables(spark, sf_dir), FLAG, GUIDELINE)
    listed = F.array_join(
        F.transform("episodes_of_the_day", lambda e: F.concat_ws(":", e["pollutant_code"], e["level"], e["source"])), "|"
    )
    return documents.select(
        "measurement_id",
        "date",
        "daily_mean",
        "hourly_max",
        "hours_measured",
        "station.code",
        "station.type",
        F.col("pollutant.code").alias("pollutant_code"),
        "pollutant.unit",
        "weather_of_the_day.*",
        listed.alias("episodes"),
        F.col("above_who_guideline").cast("int").alias("above"),
    )


@register("document_json", f"WITH {STAR} {SUMMARY}")
def document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 as JSON text, every field of every document read back from it."""
    documents = reads.station_documents(star_tables(spark, sf_dir), FLAG, GUIDELINE)
    again = nested.as_json(documents).select(F.from_json("document", documents.schema).alias("d"))
    unfolded = again.select("d.*").select("station_code", "station_name", "station_type", F.explode("pollutants").alias("p"))
    return unfolded.select("station_code", "station_name", "station_type", "p.*")


@register("sorted_export", f"WITH {DENORMALISED} SELECT date, station_code, pollutant_code, daily_mean, n_hours FROM denormalised")
def sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV export in order, read back by header; every file begins where the one before ends, or the run stops."""
    keys = ["date", "station_code", "pollutant_code"]
    path = scratch_path(spark, "export")
    rows = proxies.denormalised(spark, sf_dir).select(*keys, "daily_mean", "n_hours")
    sinks.write_table(rows, path, "csv", order=keys)
    back = spark.read.schema(rows.schema).option("header", "true").csv(path)
    file = F.col("_metadata.file_name").alias("file")
    ends = back.select(file, F.struct(*keys).alias("key")).groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # One row per file.
    before = F.lag("high").over(Window.orderBy("file"))
    disorder = ends.withColumn("before", before).filter(F.col("before") > F.col("low")).count()
    if disorder:
        raise ValueError(f"{disorder} files out of order")
    return back


# --- the daily dataset ----------------------------------------------------------------------------

DATASET = f"""
{STAR},
series AS (
    SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY date, pollutant_code
                                     ORDER BY CASE station_code WHEN '{STATIONS[0]}' THEN 0 ELSE 1 END) AS rn
        FROM daily WHERE station_code IN ({STATION_LIST})
    ) WHERE rn = 1
),
wide AS (
    SELECT date, MAX(mean) FILTER (pollutant_code = 'A') AS a, MAX(mean) FILTER (pollutant_code = 'N') AS n,
           MAX(mean) FILTER (pollutant_code = 'R') AS r, MAX(max) FILTER (pollutant_code = 'N') AS n_max,
           MAX(station_code) FILTER (pollutant_code = 'A') AS source_station
    FROM series GROUP BY date
),
dataset AS (
    SELECT d.date, x.a, x.n, x.r, x.n_max, x.source_station, w.* EXCLUDE (date),
           CAST(ISODOW(d.date) - 1 AS INTEGER) AS day_of_week, CAST(MONTH(d.date) AS INTEGER) AS month,
           CAST(ISODOW(d.date) >= 6 AS INTEGER) AS is_weekend,
           CAST(h.date IS NOT NULL AS INTEGER) AS is_public_holiday, s.is_school_holiday,
           CAST(d.date IN (SELECT date FROM episodes WHERE pollutant = 'A') AS INTEGER) AS episode_a,
           CAST(d.date IN (SELECT date FROM episodes WHERE pollutant = 'N') AS INTEGER) AS episode_n,
           CAST(x.a > {GUIDELINE} AS INTEGER) AS above_who
    FROM days d LEFT JOIN wide x ON d.date = x.date LEFT JOIN weather w ON d.date = w.date
    LEFT JOIN public_holidays h ON d.date = h.date LEFT JOIN school_days s ON d.date = s.date
)"""


def built_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.build_dataset(
        proxies.stored_daily(spark, sf_dir),
        ["A", "N", "R"],
        proxies.weather(spark, sf_dir),
        proxies.public_holidays(spark, sf_dir),
        proxies.school_days(spark, sf_dir),
        proxies.episodes(spark, sf_dir),
        STATIONS,
        target="A",
        peak="N",
        episode_pollutants=["A", "N"],
        threshold=GUIDELINE,
    )


def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored dataset, which the exploration works on."""
    return proxies.stored_table(spark, sf_dir, "dataset", built_dataset)


@register("daily_dataset", f"WITH {DATASET} SELECT * FROM dataset")
def daily_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10, E9, E10, D5, D7, B7, B16."""
    return built_dataset(spark, sf_dir)


@register(
    "dataset_report",
    f"""
    WITH {DATASET}
    SELECT COUNT(*) AS n_days, MIN(date) AS first_day, MAX(date) AS last_day, COUNT(*) - COUNT(a) AS n_missing,
           (COUNT(*) - COUNT(a))::DOUBLE / COUNT(*) AS share_missing, CAST(SUM(above_who) AS BIGINT) AS days_above,
           SUM(above_who)::DOUBLE / COUNT(above_who) AS share_above
    FROM dataset""",
)
def dataset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10."""
    return dataset.report(dataset_rows(spark, sf_dir), "a")


@register(
    "yearly_summary",
    f"""
    WITH {DATASET}
    SELECT CAST(YEAR(date) AS INTEGER) AS year, COUNT(a) AS days_measured, {half_up(exact_mean("a"), 1)} AS mean_pm25,
           CAST(SUM(above_who) AS BIGINT) AS days_above_who,
           {half_up("100.0::DOUBLE * SUM(above_who) / COUNT(a)", 1)} AS pct_days_above_who
    FROM dataset GROUP BY 1""",
)
def yearly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E13."""
    return dataset.yearly_summary(dataset_rows(spark, sf_dir), "a")


@register(
    "monthly_profile",
    f"""
    WITH {DATASET}
    SELECT month, {half_up(exact_mean("a"), 2)} AS mean_pm25,
           {half_up("100.0::DOUBLE * (SUM(above_who)::DOUBLE / COUNT(above_who))", 2)} AS pct_above_who
    FROM dataset GROUP BY 1""",
)
def monthly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E14."""
    return dataset.monthly_profile(dataset_rows(spark, sf_dir), "a")


@register(
    "weekday_profile",
    f"WITH {DATASET} SELECT day_of_week, {half_up(exact_mean('a'), 2)} AS mean_pm25 FROM dataset GROUP BY 1",
)
def weekday_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E14 by day of the week."""
    return dataset.weekday_profile(dataset_rows(spark, sf_dir), "a")


@register(
    "wind_profile",
    f"""
    WITH {DATASET}
    SELECT * FROM (
        SELECT CASE WHEN wind_mean_ms <= 0 THEN NULL WHEN wind_mean_ms <= 2 THEN '(0, 2]'
                    WHEN wind_mean_ms <= 3 THEN '(2, 3]' WHEN wind_mean_ms <= 4 THEN '(3, 4]'
                    WHEN wind_mean_ms <= 5 THEN '(4, 5]' WHEN wind_mean_ms <= 20 THEN '(5, 20]' END AS wind_class,
               COUNT(a) AS days,
               {half_up("100.0::DOUBLE * (SUM(above_who)::DOUBLE / COUNT(above_who))", 2)} AS pct_above_who
        FROM dataset GROUP BY 1
    ) WHERE wind_class IS NOT NULL""",
)
def wind_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E16."""
    return dataset.wind_profile(dataset_rows(spark, sf_dir), "a")


@register(
    "conditional_prob",
    f"""
    WITH {DATASET}, pairs AS (SELECT a AS today, LEAD(a) OVER (ORDER BY date) AS tomorrow FROM dataset)
    SELECT COUNT(*) AS pairs,
           COUNT(*) FILTER (today > {GUIDELINE} AND tomorrow > {GUIDELINE})::DOUBLE
               / COUNT(*) FILTER (today > {GUIDELINE}) AS p_above_after_above,
           COUNT(*) FILTER (today <= {GUIDELINE} AND tomorrow > {GUIDELINE})::DOUBLE
               / COUNT(*) FILTER (today <= {GUIDELINE}) AS p_above_after_below,
           {half_up("CORR(tomorrow, today)", 6)} AS r
    FROM pairs WHERE today IS NOT NULL AND tomorrow IS NOT NULL""",
)
def conditional_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does an exceedance last until the next day?"""
    return dataset.persistence(dataset_rows(spark, sf_dir), "a", GUIDELINE)


@register(
    "schema_fields",
    f"WITH {DENORMALISED} "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS name,
            CASE typeof(ANY_VALUE({name})) WHEN 'DATE' THEN 'DATE' WHEN 'VARCHAR' THEN 'STRING'
                                           WHEN 'DOUBLE' THEN 'FLOAT' ELSE 'INTEGER' END AS type,
            'NULLABLE' AS mode, COUNT({name}) AS n_filled FROM denormalised"""
        for name in schemas.DENORMALISED.names
    ),
)
def schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: name, type and mode of each column of the denormalised table, with its values."""
    rows = denormalised(spark, sf_dir)
    fields = nested.schema_fields(rows.schema)
    layout = "name string, type string, mode string"
    listed = spark.createDataFrame([(f["name"], f["type"], f["mode"]) for f in fields], layout)
    filled = quality.filled_values({"denormalised": rows})
    return listed.join(filled.select(F.col("column").alias("name"), "n_filled"), "name")


# The star's tables in the SQL twins.
STORED_SQL = {
    "station": "stations",
    "pollutant": "pollutants",
    "calendar": "calendar",
    "weather_day": "weather_day",
    "daily_measurement": "fact",
    "episode": """(SELECT ROW_NUMBER() OVER (ORDER BY date, pollutant_id) AS episode_id, *,
                   NULL AS criterion_population, NULL AS criterion_area FROM episode)""",
}


@register(
    "column_audit",
    f"WITH {STAR} "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{field.name}' AS "column", '{field.dataType.simpleString()}' AS type,
            FALSE AS refused, COUNT({field.name}) AS n_filled FROM {STORED_SQL[name]}"""
        for name, schema in schemas.STAR.items()
        for field in schema.fields
    )
    + "".join(
        f""" UNION ALL SELECT 'customer', '{column}', '{kind}', TRUE, COUNT({column}) FROM customer"""
        for column, kind in (
            ("c_custkey", "bigint"),
            ("c_name", "string"),
            ("c_nationkey", "int"),
            ("c_acctbal", "double"),
            ("c_mktsegment", "string"),
        )
    ),
)
def column_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: all columns of the stored tables, and of one raw table the dictionary does not know."""
    tables = {**star_tables(spark, sf_dir), "customer": table(spark, sf_dir, "customer")}
    audit = quality.column_audit(spark, {name: df.schema for name, df in tables.items()}, schemas.STAR)
    return audit.join(quality.filled_values(tables), ["table", "column"])


def _check_sql() -> str:
    """Every declaration of the star schema as a count of the rows that break it."""
    parts = []
    for name, declared in schemas.KEYS.items():
        for key in declared:
            listed = ", ".join(key)
            parts.append(
                f"""SELECT '{name}({listed})' AS "check", COUNT(*) AS n_rows,
                    COUNT(*) - COUNT(DISTINCT ({listed})) AS n_bad FROM {STORED_SQL[name]}"""
            )
    for child, column, parent in schemas.REFERENCES:
        parts.append(
            f"""SELECT '{child}.{column} -> {parent}', COUNT({column}),
                COUNT(*) FILTER ({column} NOT IN (SELECT {column} FROM {STORED_SQL[parent]})) FROM {STORED_SQL[child]}"""
        )
    for name in schemas.TABLE_ORDER:
        for column in schemas.NOT_NULL[name]:
            parts.append(
                f"""SELECT '{name}: {column} is not null', COUNT(*), COUNT(*) FILTER ({column} IS NULL)
                    FROM {STORED_SQL[name]}"""
            )
        for column, limit in schemas.MAX_LENGTH.get(name, {}).items():
            parts.append(
                f"""SELECT '{name}: length({column}) <= {limit}', COUNT(*),
                    COUNT(*) FILTER (LENGTH({column}) > {limit}) FROM {STORED_SQL[name]}"""
            )
    return f"WITH {STAR} " + " UNION ALL ".join(parts)


@register("star_checks", _check_sql())
def star_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K4 on the stored star schema; the supplier codes are longer than a station code may be."""
    return star.check_star(star_tables(spark, sf_dir))
