"""The next-day forecast on the daily facts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.catalog import proxies
from sensorloom.catalog.proxies import DAILY_FACT, GUIDELINE
from sensorloom.catalog.registry import half_even, half_up, register
from sensorloom.functions.numeric import portable_round
from sensorloom.operators import scoring
from sensorloom.plans import dataset, forecast
from sensorloom.session import scratch_path

YEARS = {"train_until": 1998, "valid": 1999, "test": 2000, "demo": 2001}
THRESHOLDS = [20 + step / 2 for step in range(17)]

SERIES = f"""
{DAILY_FACT},
{proxies.WEATHER.strip()},
{proxies.HOLIDAYS.strip()},
{proxies.SCHOOL.strip()},
days AS (
    SELECT CAST(UNNEST(GENERATE_SERIES((SELECT MIN(date) FROM daily_fact), (SELECT MAX(date) FROM daily_fact),
                                       INTERVAL 1 DAY)) AS DATE) AS date
),
wide AS (
    SELECT date, MAX(mean) FILTER (flag = 'A') AS a, MAX(mean) FILTER (flag = 'N') AS n,
           MAX(max) FILTER (flag = 'R') AS r_max
    FROM daily_fact GROUP BY 1
),
series AS (
    SELECT d.date, x.a, x.n, x.r_max, w.* EXCLUDE (date), CAST(MONTH(d.date) AS INTEGER) AS month,
           CAST(ISODOW(d.date) - 1 AS INTEGER) AS day_of_week,
           CASE WHEN CAST(h.date IS NOT NULL AS INTEGER) + s.is_school_holiday > 0 THEN 1 ELSE 0 END AS holiday
    FROM days d LEFT JOIN wide x ON d.date = x.date LEFT JOIN weather w ON d.date = w.date
    LEFT JOIN public_holidays h ON d.date = h.date LEFT JOIN school_days s ON d.date = s.date
),
candidates AS (
    SELECT date, a AS pm25_d, LAG(a, 1) OVER o AS pm25_d1, LAG(a, 2) OVER o AS pm25_d2,
           CASE WHEN COUNT(a) OVER f >= 5 THEN CAST(SUM(CAST(a AS DECIMAL(18,2))) OVER f AS DOUBLE) / COUNT(a) OVER f END
               AS pm25_mean7,
           n AS nox_d, r_max AS o3max_d, LEAD(temp_mean_c) OVER o AS temp_next, LEAD(wind_mean_ms) OVER o AS wind_next,
           LEAD(wind_dir_deg) OVER o AS wind_dir_next, LEAD(rain_mm) OVER o AS rain_next,
           LEAD(pressure_mean_hpa) OVER o AS pressure_next, LEAD(humidity_mean_pct) OVER o AS humidity_next,
           LEAD(pressure_mean_hpa) OVER o - pressure_mean_hpa AS pressure_change, LEAD(month) OVER o AS month,
           LEAD(day_of_week) OVER o AS day_of_week, LEAD(holiday) OVER o AS holiday_next, LEAD(a) OVER o AS target
    FROM series
    WINDOW o AS (ORDER BY date), f AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
),
features AS (
    SELECT * FROM candidates
    WHERE {" AND ".join(f"{name} IS NOT NULL" for name in [*forecast.FEATURES, forecast.TARGET])}
)"""


def series_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily dataset of all line items as one series."""
    facts = proxies.daily_fact(spark, sf_dir).withColumnRenamed("flag", "pollutant_code")
    return dataset.build_dataset(
        facts.withColumn("station_code", F.lit("ALL")),
        ["A", "N"],
        proxies.weather(spark, sf_dir),
        proxies.public_holidays(spark, sf_dir),
        proxies.school_days(spark, sf_dir),
        stations=["ALL"],
        target="A",
        peak="R",
        threshold=GUIDELINE,
    )


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the stored dataset."""
    series = proxies.stored_table(spark, sf_dir, "series", series_rows)
    return forecast.features(series, value="a", companion="n", peak="r_max")


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = forecast.assembled(feature_rows(spark, sf_dir))
    return rows.withColumn("split", forecast.split_name(**YEARS))


@register("feature_matrix", f"WITH {SERIES} SELECT * FROM features")
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: F2-F5, B22, C10."""
    return feature_rows(spark, sf_dir)


@register(
    "time_split",
    f"""
    WITH {SERIES}
    SELECT CASE WHEN YEAR(date) <= 1998 THEN 'train' WHEN YEAR(date) = 1999 THEN 'validation'
                WHEN YEAR(date) = 2000 THEN 'test' ELSE 'demo' END AS split, COUNT(*) AS n_rows,
           {half_up(f"100.0::DOUBLE * COUNT(*) FILTER (target > {GUIDELINE}) / COUNT(*)", 1)} AS pct_days_above_who
    FROM features GROUP BY 1""",
)
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2."""
    return forecast.split_summary(feature_rows(spark, sf_dir), GUIDELINE, **YEARS)


@register(
    "persistence_metrics",
    f"""
    WITH {SERIES}, c AS (
        SELECT COUNT(*) AS n, AVG(ABS(target - pm25_d)) AS mae, SQRT(AVG((target - pm25_d) * (target - pm25_d))) AS rmse,
               1 - SUM((target - pm25_d) * (target - pm25_d)) / (VAR_POP(target) * COUNT(target)) AS r2,
               COUNT(*) FILTER (target > {GUIDELINE} AND pm25_d > {GUIDELINE})::DOUBLE AS hits,
               COUNT(*) FILTER (target > {GUIDELINE}) AS reals, COUNT(*) FILTER (pm25_d > {GUIDELINE}) AS alerts
        FROM features
    )
    SELECT 'persistence' AS model, n, {half_up("mae", 6)} AS "MAE", {half_up("rmse", 6)} AS "RMSE",
           {half_up("r2", 6)} AS "R2", {half_up("COALESCE(hits / NULLIF(reals, 0), 0)", 6)} AS recall,
           {half_up("COALESCE(hits / NULLIF(alerts, 0), 0)", 6)} AS precision,
           {half_up("COALESCE(2 * hits / NULLIF(reals + alerts, 0), 0)", 6)} AS "F1"
    FROM c""",
)
def persistence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3, L4: tomorrow is as today."""
    return scoring.metrics(feature_rows(spark, sf_dir), "persistence", "target", "pm25_d", GUIDELINE)


CURVE = f"""
{SERIES},
thresholds AS (SELECT CAST(20 + i / 2.0 AS DOUBLE) AS threshold FROM (SELECT UNNEST(GENERATE_SERIES(0, 16)) AS i)),
counts AS (
    SELECT threshold, COUNT(*) FILTER (target > {GUIDELINE}) AS reals, COUNT(*) FILTER (pm25_d > threshold) AS alerts,
           COUNT(*) FILTER (target > {GUIDELINE} AND pm25_d > threshold)::DOUBLE AS hits
    FROM thresholds LEFT JOIN features ON TRUE GROUP BY 1
),
curve AS (
    SELECT threshold, {half_up("COALESCE(hits / NULLIF(reals, 0), 0)", 6)} AS recall,
           {half_up("COALESCE(hits / NULLIF(alerts, 0), 0)", 6)} AS precision,
           {half_up("COALESCE(2 * hits / NULLIF(reals + alerts, 0), 0)", 6)} AS "F1"
    FROM counts
)"""


def curve_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.threshold_curve(feature_rows(spark, sf_dir), "target", "pm25_d", THRESHOLDS, GUIDELINE)


@register("threshold_curve", f"WITH {CURVE} SELECT * FROM curve")
def threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall and precision per alert threshold."""
    return curve_rows(spark, sf_dir)


@register(
    "chosen_threshold",
    f"WITH {CURVE} SELECT MAX(threshold) FILTER (recall >= 0.8) AS alert_threshold FROM curve",
)
def chosen_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest threshold that still catches 80 %."""
    return scoring.choose_threshold(curve_rows(spark, sf_dir))


@register(
    "confusion",
    f"""
    WITH {SERIES}
    SELECT a.actual_above, b.alert, COUNT(f.date) AS n
    FROM (SELECT UNNEST([0, 1]) AS actual_above) a CROSS JOIN (SELECT UNNEST([0, 1]) AS alert) b
    LEFT JOIN features f ON CAST(f.target > {GUIDELINE} AS INTEGER) = a.actual_above
                        AND CAST(f.pm25_d > 22.5 AS INTEGER) = b.alert
    GROUP BY 1, 2""",
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10."""
    return scoring.confusion(feature_rows(spark, sf_dir), "target", "pm25_d", GUIDELINE, 22.5)


@register(
    "published_forecasts",
    f"""
    WITH {SERIES}
    SELECT date AS day, date + 1 AS forecast_day, pm25_d AS measured_today, target AS measured_next_day,
           {half_even("pm25_mean7", 1)} AS forecast,
           CASE WHEN {half_even("pm25_mean7", 1)} > {GUIDELINE} THEN 'ALERT' ELSE '-' END AS alert
    FROM features""",
)
def published_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of the week as a forecast, as it would be published."""
    return scoring.published(feature_rows(spark, sf_dir), "pm25_d", "target", "pm25_mean7", GUIDELINE)


@register(
    "linear_one_feature",
    f"""
    WITH {SERIES}
    SELECT {half_up("REGR_SLOPE(target, pm25_d)", 6)} AS slope, {half_up("REGR_INTERCEPT(target, pm25_d)", 6)} AS intercept
    FROM features""",
)
def linear_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 on one feature, where the coefficients have a closed form."""
    model = forecast.fit_linear(forecast.assembled(feature_rows(spark, sf_dir), ["pm25_d"]))
    fitted = spark.createDataFrame(
        [(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double"
    )
    return fitted.select(*[portable_round(F.col(name), 6).alias(name) for name in fitted.columns])


@register("linear_fit")
def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the early years, measured on the validation year."""
    rows = split_rows(spark, sf_dir)
    model = forecast.fit_linear(rows.filter("split = 'train'"))
    valid = model.transform(rows.filter("split = 'validation'"))
    return scoring.metrics(valid, "linear regression", "target", "forecast", GUIDELINE)


def study(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the whole study: 18 forests of 300 trees, the best refitted, its threshold chosen; run once per session."""

    def write() -> str:
        folder = scratch_path(spark, "study")
        series = proxies.stored_table(spark, sf_dir, "series", series_rows)
        found = forecast.run(series, YEARS, guideline=GUIDELINE, thresholds=THRESHOLDS, value="a", companion="n", peak="r_max")

        def keep(part):
            if part == "model":
                forecast.save_model(found[part], f"{folder}/{part}")
            elif isinstance(found[part], DataFrame):
                found[part].write.parquet(f"{folder}/{part}")

        # Small tables of many short jobs, which keep few cores busy one after another.
        with ThreadPoolExecutor(len(found)) as pool:
            list(pool.map(inheritable_thread_target(spark)(keep), found))
        return folder

    folder = proxies.stored_folder(spark, sf_dir, "study", write)
    return spark.read.parquet(f"{folder}/{name}")


@register("forest_fit")
def forest_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tuned forest beside baseline and linear model on the validation year."""
    return study(spark, sf_dir, "validation")


@register("grid_search")
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation error per combination."""
    return study(spark, sf_dir, "grid")


@register("model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refitted on train and validation, compared once on the test year, the threshold chosen before."""
    return study(spark, sf_dir, "test")


@register("model_gain")
def model_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of the baseline's error that the forest saves on the test year."""
    return study(spark, sf_dir, "gain")


@register("permutation_importance")
def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each feature matters to the tuned forest on the validation year."""
    return study(spark, sf_dir, "importance")


@register("demo_metrics")
def demo_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline and forest, with its threshold, on a year that no choice was based on."""
    return study(spark, sf_dir, "demo_metrics")


@register("scored_demo")
def scored_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept pipeline scores the demo year; alerts use the threshold chosen on the validation year."""
    study(spark, sf_dir, "curve")
    rows = feature_rows(spark, sf_dir).withColumn("split", forecast.split_name(**YEARS)).filter("split = 'demo'")
    folder = proxies.stored_folder(spark, sf_dir, "study", str)
    threshold = scoring.choose_threshold(study(spark, sf_dir, "curve")).first().alert_threshold
    scored = forecast.score(f"{folder}/model", rows)
    return scoring.published(scored, "pm25_d", "target", "forecast", GUIDELINE if threshold is None else threshold)
