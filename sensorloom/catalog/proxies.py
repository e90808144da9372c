"""The given tables in the roles of sensor data, each with its SQL twin.

No sensor data is supplied, so orders, line items and events stand in: a ship day and return flag
for a day and pollutant, a supplier for a station, the orders of a day for its weather.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.catalog.registry import exact_mean, half_even
from sensorloom.functions.numeric import exact_mean as mean_of
from sensorloom.functions.numeric import portable_round
from sensorloom.operators.dedup import keep_first
from sensorloom.operators.joins import dimension
from sensorloom.plans import star
from sensorloom.session import scratch_path
from sensorloom.sources import sinks

STATION_TYPES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
BACKGROUND, TRAFFIC = "EUROPE", "ASIA"
STATIONS = ["SUPPLIER#000000001", "SUPPLIER#000000002"]
FLAG = "A"
GUIDELINE = 25.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_day():
    return F.col("l_shipdate").cast("date")


def order_day():
    return F.col("o_orderdate").cast("date")


# One row per ship day and flag with at least five line items: a complete day of one series.
DAILY_FACT = f"""
daily_fact AS (
    SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS flag,
           {half_even(exact_mean("l_quantity"), 2)} AS mean,
           {half_even("MAX(l_extendedprice)", 2)} AS max,
           COUNT(l_quantity) AS n_hours
    FROM lineitem GROUP BY 1, 2 HAVING COUNT(l_quantity) >= 5
)"""


def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    measured = items.groupBy(ship_day().alias("date"), F.col("l_returnflag").alias("flag")).agg(
        portable_round(mean_of(F.col("l_quantity"), 2), 2, "half_even").alias("mean"),
        portable_round(F.max("l_extendedprice"), 2, "half_even").alias("max"),
        F.count("l_quantity").alias("n_hours"),
    )
    return measured.filter(F.col("n_hours") >= 5)


# One row per order day: the weather of that day.
WEATHER = f"""
weather AS (
    SELECT CAST(o_orderdate AS DATE) AS date,
           {half_even(exact_mean("o_totalprice") + " / 10000.0", 2)} AS temp_mean_c,
           MIN(o_totalprice) AS temp_min_c, MAX(o_totalprice) AS temp_max_c,
           CAST(COUNT(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS humidity_mean_pct,
           {half_even(exact_mean("CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END"), 2)} AS pressure_mean_hpa,
           CAST(COUNT(*) FILTER (o_orderstatus = 'P') AS DOUBLE) AS rain_mm,
           COUNT(*) / 2.0::DOUBLE AS wind_mean_ms,
           CAST(COUNT(DISTINCT o_orderpriority) AS DOUBLE) AS wind_max_ms,
           CAST(MIN(o_orderkey) AS DOUBLE) AS wind_dir_deg
    FROM orders GROUP BY 1
)"""


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").groupBy(order_day().alias("date")).agg(
        portable_round(mean_of(price, 2) / 10000.0, 2, "half_even").alias("temp_mean_c"),
        F.min(price).alias("temp_min_c"),
        F.max(price).alias("temp_max_c"),
        F.count_if(status == "O").cast("double").alias("humidity_mean_pct"),
        portable_round(mean_of(F.when(status != "P", price), 2), 2, "half_even").alias("pressure_mean_hpa"),
        F.count_if(status == "P").cast("double").alias("rain_mm"),
        (F.count("*") / 2.0).alias("wind_mean_ms"),
        F.count_distinct("o_orderpriority").cast("double").alias("wind_max_ms"),
        F.min("o_orderkey").cast("double").alias("wind_dir_deg"),
    )


# Days with a very large order are public holidays, named by the status of the first such order.
HOLIDAYS = """
public_holidays AS (
    SELECT CAST(o_orderdate AS DATE) AS date, MIN_BY(o_orderstatus, o_orderkey) AS holiday_name
    FROM orders WHERE o_totalprice > 480000 GROUP BY 1
)"""


def public_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 480000)
    return large.groupBy(order_day().alias("date")).agg(
        F.min_by("o_orderstatus", "o_orderkey").alias("holiday_name")
    )


# A large order in process starts three days of school holidays; the first order names a day.
SCHOOL = """
school_days AS (
    SELECT date, MIN_BY(o_orderpriority, o_orderkey) AS holiday_name, 1 AS is_school_holiday
    FROM (
        SELECT CAST(o_orderdate AS DATE) + CAST(k AS INTEGER) AS date, o_orderkey, o_orderpriority
        FROM orders, (SELECT UNNEST([0, 1, 2]) AS k)
        WHERE o_orderstatus = 'P' AND o_totalprice > 400000
    ) GROUP BY 1
)"""


def school_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    )
    days = started.select(
        F.explode(F.sequence(order_day(), F.date_add(order_day(), 2))).alias("date"),
        "o_orderkey",
        F.col("o_orderpriority").alias("holiday_name"),
    )
    first = keep_first(days, ["date"], [F.col("o_orderkey")])
    return first.select("date", "holiday_name", F.lit(1).alias("is_school_holiday"))


# Urgent orders are episodes; a status is a pollutant and a priority a source.
EPISODES = """
episodes AS (
    SELECT date, pollutant, level, source, forecast, observed FROM (
        SELECT CAST(o_orderdate AS DATE) AS date,
               CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'X' END AS pollutant,
               CASE WHEN o_totalprice > 250000 THEN 'alert' ELSE 'information' END AS level,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'pdf_report' ELSE 'html_page' END AS source,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'True' ELSE 'False' END AS forecast,
               CASE WHEN o_totalprice > 100000 THEN 'True' END AS observed,
               ROW_NUMBER() OVER (
                   PARTITION BY CAST(o_orderdate AS DATE), o_orderstatus
                   ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 ELSE 1 END, o_orderkey
               ) AS rn
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    ) WHERE rn = 1
)"""


def episode_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .select(
            order_day().alias("date"),
            F.when(status == "F", "A").when(status == "O", "N").otherwise("X").alias("pollutant"),
            F.when(price > 250000, "alert").otherwise("information").alias("level"),
            F.when(urgent, "pdf_report").otherwise("html_page").alias("source"),
            F.when(urgent, "True").otherwise("False").alias("forecast"),
            F.when(price > 100000, "True").alias("observed"),
            "o_orderkey",
        )
    )


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.when(F.col("source") == "pdf_report", 0).otherwise(1), F.col("o_orderkey")]
    unique = keep_first(episode_candidates(spark, sf_dir), ["date", "pollutant"], order)
    empty = F.lit(None).cast("string")
    return unique.drop("o_orderkey").withColumns(
        {name: empty for name in ("forecast_result", "criterion_population", "criterion_area")}
    )


# Suppliers are stations; line items per day, supplier and flag are the daily facts.
STAR = f"""
stations AS (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY s_name) AS INTEGER) AS station_id, UPPER(s_name) AS station_code,
           n_name AS station_name, r_name AS station_type
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
pollutants AS (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY l_returnflag) AS INTEGER) AS pollutant_id,
           l_returnflag AS pollutant_code, 'flag ' || l_returnflag AS pollutant_name, 'units' AS unit
    FROM (SELECT DISTINCT l_returnflag FROM lineitem)
),
daily AS (
    SELECT CAST(l_shipdate AS DATE) AS date, UPPER(s_name) AS station_code, l_returnflag AS pollutant_code,
           {half_even(exact_mean("l_quantity"), 2)} AS mean,
           {half_even("MAX(l_extendedprice)", 2)} AS max,
           COUNT(l_quantity) AS n_hours
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3
),
days AS (
    SELECT CAST(UNNEST(GENERATE_SERIES((SELECT MIN(date) FROM daily), (SELECT MAX(date) FROM daily),
                                       INTERVAL 1 DAY)) AS DATE) AS date
),
{WEATHER.strip()},
{HOLIDAYS.strip()},
{SCHOOL.strip()},
{EPISODES.strip()},
calendar AS (
    SELECT d.date, CAST(YEAR(d.date) AS INTEGER) AS year, CAST(MONTH(d.date) AS INTEGER) AS month,
           CAST(ISODOW(d.date) AS INTEGER) AS day_of_week,
           CAST(ISODOW(d.date) >= 6 AS INTEGER) AS is_weekend,
           CAST(h.holiday_name IS NOT NULL AS INTEGER) AS is_public_holiday, h.holiday_name,
           s.is_school_holiday, s.holiday_name AS school_holiday_name
    FROM days d LEFT JOIN public_holidays h ON d.date = h.date LEFT JOIN school_days s ON d.date = s.date
),
weather_day AS (SELECT w.* FROM weather w WHERE w.date IN (SELECT date FROM days)),
episode AS (
    SELECT e.date, p.pollutant_id, e.level, e.source,
           CAST(CASE e.forecast WHEN 'True' THEN 1 WHEN 'False' THEN 0 END AS INTEGER) AS forecast,
           CAST(CASE e.observed WHEN 'True' THEN 1 WHEN 'False' THEN 0 END AS INTEGER) AS observed,
           CAST(NULL AS VARCHAR) AS forecast_result
    FROM episodes e JOIN pollutants p ON e.pollutant = p.pollutant_code
    WHERE e.date IN (SELECT date FROM days)
),
fact AS (
    SELECT ROW_NUMBER() OVER (ORDER BY d.date, d.station_code, d.pollutant_code) AS measurement_id,
           d.date, s.station_id, p.pollutant_id, d.mean, d.max, CAST(d.n_hours AS INTEGER) AS n_hours,
           d.station_code, d.pollutant_code, s.station_name, s.station_type, p.pollutant_name, p.unit
    FROM daily d JOIN stations s USING (station_code) JOIN pollutants p USING (pollutant_code)
)"""


def station_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily facts by station code and pollutant code."""
    items = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.upper("s_name").alias("station_code")
    )
    by_supplier = items.groupBy(
        ship_day().alias("date"), "l_suppkey", F.col("l_returnflag").alias("pollutant_code")
    ).agg(
        portable_round(mean_of(F.col("l_quantity"), 2), 2, "half_even").alias("mean"),
        portable_round(F.max("l_extendedprice"), 2, "half_even").alias("max"),
        F.count("l_quantity").alias("n_hours"),
    )
    return by_supplier.join(dimension(suppliers), "l_suppkey").select(
        "date", "station_code", "pollutant_code", "mean", "max", "n_hours"
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey")
        .join(region, "n_regionkey")
        .select(
            F.upper("s_name").alias("station_code"),
            F.col("n_name").alias("station_name"),
            F.col("r_name").alias("station_type"),
        )
    )


def pollutants(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("pollutant_code")).distinct()
    return flags.select(
        "pollutant_code",
        F.concat(F.lit("flag "), "pollutant_code").alias("pollutant_name"),
        F.lit("units").alias("unit"),
    )


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """The folder of a derived table, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _STORED:
        path = scratch_path(spark, label)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def stored_folder(spark: SparkSession, sf_dir: str, label: str, write: Callable[[], str]) -> str:
    """The folder that `write` fills and names, filled once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _STORED:
        _STORED[key] = write()
    return _STORED[key]


def stored_table(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    """A derived table, written once per session and read by the queries that follow from it."""
    path = _stored(spark, sf_dir, label, lambda path: sinks.write_table(build(spark, sf_dir), path))
    return spark.read.parquet(path)


def stored_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored daily facts, which the star schema and the dataset start from."""
    return stored_table(spark, sf_dir, "daily", station_daily)


def built_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema from its sources."""
    return star.build_star(
        stations(spark, sf_dir),
        pollutants(spark, sf_dir),
        stored_daily(spark, sf_dir),
        public_holidays(spark, sf_dir),
        school_days(spark, sf_dir),
        weather(spark, sf_dir),
        episodes(spark, sf_dir),
    )


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stored star schema, which the queries and reads work on."""
    path = _stored(spark, sf_dir, "star", lambda path: sinks.write_star(built_star(spark, sf_dir), path))
    return sinks.read_star(spark, path)


def denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored denormalised table, a folder per year."""

    def write(path):
        sinks.write_partitioned(star.denormalise(star_tables(spark, sf_dir), FLAG, GUIDELINE), path)

    return spark.read.schema(schemas.DENORMALISED).parquet(_stored(spark, sf_dir, "denormalised", write))
