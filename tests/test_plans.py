"""M9-M14, H and N1 on a small star schema; plans on the given tables."""

from __future__ import annotations

import datetime as dt
import gc
import json
import math
import os
import random
import subprocess
import sys
import threading
import weakref

import duckdb
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle import connect, differences
from sensorloom import schemas, settings
from sensorloom.catalog import ORACLES, QUERIES
from sensorloom.operators import joins, keys, nested
from sensorloom.plans import analysis, dataset, forecast, reads, star
from sensorloom.session import scratch_path

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
# The smallest tables have no complete day, so there is nothing to fit.
FITTED = ["linear_one_feature"]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


@pytest.fixture(scope="module")
def sources(spark):
    stations = [("PA04C", "Paris Centre", "urban_background"), ("PA01H", "PARIS 1er", "urban_background"), ("RN20", "RN20", "traffic")]
    pollutants = [("PM25", "fine", "microg/m3", 2), ("NO2", "nitrogen", "microg/m3", 1), ("O3", "ozone", "microg/m3", 3)]
    daily = [(day(n), "PA01H", "PM25", float(10 + n), float(20 + n), 24) for n in (1, 2, 4, 5, 6)]
    daily += [(day(3), "PA04C", "PM25", 15.0, 30.0, 20), (day(2), "PA04C", "PM25", 99.0, 99.0, 18)]
    daily += [(day(n), "RN20", "NO2", 40.0 + n, 80.0, 23) for n in (1, 2)]
    daily += [(day(1), "PA01H", "NO2", 20.0, 40.0, 24), (day(2), "PA01H", "O3", 50.0, 120.0, 24)]
    weather = [(day(n), float(n), 1000.0 + n) for n in (0, 1, 2, 3, 9)]
    episodes = [
        (day(2), "PM10", "alert", "pdf_report", "True"),
        (day(2), "PM2.5", "information", "html_page", "False"),
        (day(4), "NO2", "information", "opendata_csv", None),
        (day(40), "NO2", "alert", "pdf_report", None),
    ]
    return {
        "stations": spark.createDataFrame(stations, "station_code string, station_name string, station_type string"),
        "pollutants": spark.createDataFrame(
            pollutants, "pollutant_code string, pollutant_name string, unit string, first_column long"
        ),
        "daily": spark.createDataFrame(daily, "date date, station_code string, pollutant_code string, mean double, max double, n_hours long"),
        "public_holidays": spark.createDataFrame([(day(1), "1er janvier")], "date date, holiday_name string"),
        "weather": spark.createDataFrame(weather, "date date, wind_mean_ms double, pressure_mean_hpa double"),
        "episodes": spark.createDataFrame(
            episodes, "date date, pollutant string, level string, source string, forecast string"
        ).withColumns(
            {c: F.lit(None).cast("string") for c in ("observed", "forecast_result", "criterion_population", "criterion_area")}
        ),
    }


@pytest.fixture(scope="module")
def tables(sources):
    return {name: df.persist() for name, df in star.build_star(**sources).items()}


def test_star_schema(tables):
    types = {name: df.schema.simpleString() for name, df in tables.items()}
    assert types == {name: schema.simpleString() for name, schema in schemas.STAR.items()}
    assert [tuple(r)[:2] for r in tables["station"].orderBy("station_id").collect()] == [(1, "PA01H"), (2, "PA04C"), (3, "RN20")]
    assert [r.pollutant_code for r in tables["pollutant"].orderBy("pollutant_id").collect()] == ["NO2", "PM25", "O3"]
    calendar = tables["calendar"].orderBy("date").collect()
    assert len(calendar) == 6 and calendar[0].is_public_holiday == 1 and calendar[1].is_public_holiday == 0
    # An absent source is unknown, not 'no'.
    assert {r.is_school_holiday for r in calendar} == {None}
    facts = tables["daily_measurement"].orderBy("measurement_id").collect()
    assert [r.measurement_id for r in facts] == list(range(1, 12))
    # Day, then station code, then pollutant code.
    assert [(r.date, r.station_id, r.pollutant_id) for r in facts[:4]] == [
        (day(1), 1, 1),
        (day(1), 1, 2),
        (day(1), 3, 1),
        (day(2), 1, 3),
    ]
    assert tables["weather_day"].count() == 3
    # Unknown pollutants and days outside the calendar are dropped.
    episodes = [(r.episode_id, r.date, r.forecast) for r in tables["episode"].orderBy("episode_id").collect()]
    assert episodes == [(1, day(2), 0), (2, day(4), None)]


def test_star_satisfies_its_declarations(tables):
    checks = star.check_star(tables).collect()
    assert {r.n_bad for r in checks} == {0} and len(checks) > 40
    broken = {**tables, "station": tables["station"].limit(1)}
    bad = {r.check for r in star.check_star(broken).filter("n_bad > 0").collect()}
    assert bad == {"daily_measurement.station_id -> station"}


def test_denormalised(tables):
    wide = star.denormalise(tables)
    assert wide.schema == schemas.DENORMALISED and wide.count() == 11
    row = wide.filter((F.col("date") == day(2)) & (F.col("station_code") == "PA04C")).first()
    assert (row.above_who_pm25, row.episode_level, row.wind_mean_ms, row.is_weekend) == (1, "information", 2.0, 0)
    assert {r.above_who_pm25 for r in wide.filter("pollutant_code <> 'PM25'").collect()} == {None}
    fields = nested.schema_fields(wide.schema)
    assert len(fields) == 27 and fields[0] == {"name": "date", "type": "DATE", "mode": "NULLABLE"}
    assert {f["type"] for f in fields} == {"DATE", "INTEGER", "STRING", "FLOAT"}


def test_queries(tables):
    yearly = analysis.yearly_mean_by_type(tables).collect()
    assert [(r.year, r.station_type, r.n_stations) for r in yearly] == [(2024, "urban_background", 2)]
    month = analysis.monthly_risk(tables).first()
    assert (month.days_measured, month.days_above_who, month.pct_days_above_who) == (7, 2, 28.6)
    gap = analysis.traffic_excess(tables).first()
    assert tuple(gap) == (2024, 20.0, 41.5, 21.5, 2.08)
    worst = analysis.worst_days(tables, k=2).collect()
    assert [(r.date, r.pm25_ug_m3, r.wind_mean_ms) for r in worst] == [(day(2), 99.0, 2.0), (day(6), 16.0, None)]
    episodes = analysis.episodes_and_measurements(tables, stations=["PA01H"]).orderBy("date").collect()
    # The row before the fourth is the second: the third day was not measured here.
    assert [(r.pm25_day_before_ug_m3, r.pm25_day_ug_m3, r.above_who) for r in episodes] == [(11.0, 12.0, 0), (12.0, 14.0, 0)]
    wide = star.denormalise(tables)
    assert analysis.rows_per_year(wide).first().n_rows == 11
    assert analysis.month_of_year(wide, "PM25", "PA01H").first().days_above_who == 1
    assert tuple(analysis.type_means(wide).first()) == (2024, 20.0, 41.5)
    classes = {r.wind_class[:1]: r.days for r in analysis.wind_classes(wide).collect()}
    assert classes == {"1": 1, "2": 3}


def test_reads(tables):
    rows, info = reads.list_measurements(tables, reads.MeasurementFilter(pollutant="pm25", min_value=15.0), per_page=2)
    assert [(r.date, r.mean) for r in rows.collect()] == [(day(6), 16.0), (day(5), 15.0)]
    assert tuple(info.first()) == (1, 2, 4, 2, 2, None)
    everything, _ = reads.list_measurements(tables, reads.MeasurementFilter(station="", start=""))
    assert everything.count() == 11
    one_day = reads.MeasurementFilter(start="2024-01-02", end="2024-01-02")
    assert reads.measurements_matching(tables, one_day).count() == 4
    with pytest.raises(ValueError):
        reads.measurements_matching(tables, reads.MeasurementFilter(start="02/01/2024"))
    with pytest.raises(ValueError):
        reads.stations_matching(tables, reads.StationFilter(type="road"))
    stations, _ = reads.list_stations(tables, reads.StationFilter(name="paris"))
    assert [r.station_code for r in stations.collect()] == ["PA01H", "PA04C"]
    document = json.loads(nested.as_json(reads.get_station(tables, "pa01h")).first().document)
    assert [p["pollutant_code"] for p in document["pollutants"]] == ["NO2", "O3", "PM25"]
    assert "days_above_who_pm25" not in document["pollutants"][0]
    assert document["pollutants"][2]["days_above_who_pm25"] == 1
    assert reads.get_station(tables, "nowhere").count() == 0
    found = reads.get_measurement(tables, 6).first()
    assert found.daily_mean == 99.0 and found.above_who_guideline is True
    assert [(e.pollutant_code, e.level) for e in found.episodes_of_the_day] == [("PM25", "information")]
    assert found.weather_of_the_day.wind_mean_ms == 2.0
    last = reads.get_measurement(tables, 11).first()
    assert last.weather_of_the_day is None and last.episodes_of_the_day == []
    assert reads.get_measurement(tables, 999).count() == 0


def test_dataset(sources):
    built = dataset.build_dataset(
        sources["daily"], ["PM25", "NO2", "O3"], sources["weather"], sources["public_holidays"], None, sources["episodes"]
    )
    rows = built.orderBy("date").collect()
    assert len(rows) == 6
    assert [(r.pm25, r.source_station) for r in rows[:4]] == [(11.0, "PA01H"), (12.0, "PA01H"), (15.0, "PA04C"), (14.0, "PA01H")]
    assert (rows[1].o3, rows[1].o3_max, rows[1].no2) == (50.0, 120.0, None)
    assert [r.above_who for r in rows] == [0, 0, 0, 0, 0, 1]
    assert (rows[0].is_public_holiday, rows[0].is_school_holiday, rows[1].episode_pm10, rows[2].episode_pm10) == (1, None, 1, 0)
    assert dataset.yearly_summary(built).first().days_measured == 6
    assert dataset.persistence(built).first().pairs == 5
    by_type = dataset.yearly_by_type(sources["daily"], sources["stations"], "NO2", ["urban_background", "traffic"])
    assert tuple(by_type.first()) == (2024, 20.0, 41.5)


@pytest.fixture(scope="module")
def daily_series(spark):
    rng = random.Random(3)
    start, rows, value = dt.date(2021, 1, 1), [], 12.0
    for i in range(1400):
        date = start + dt.timedelta(days=i)
        wind = 1 + 6 * rng.random()
        value = max(0.5, 0.6 * value + 14 - 2.2 * wind + rng.gauss(0, 1.5))
        rows.append(
            (date, round(value, 2), round(2 * value + rng.random(), 2), 30 + 10 * math.sin(i / 58), 10.0, round(wind, 1), 180.0, 0.0,
             1010.0 + rng.gauss(0, 5), 70.0, date.month, date.weekday(), 0, None if i % 2 else 1)
        )
    layout = (
        "date date, pm25 double, nox double, o3_max double, temp_mean_c double, wind_mean_ms double, wind_dir_deg double, "
        "rain_mm double, pressure_mean_hpa double, humidity_mean_pct double, month int, day_of_week int, "
        "is_public_holiday int, is_school_holiday int"
    )
    return spark.createDataFrame(rows, layout)


YEARS = {"train_until": 2022, "valid": 2023, "test": 2024, "demo": 2025}


def test_features(daily_series):
    rows = {r.date: r for r in forecast.features(daily_series).collect()}
    values = {r.date: r for r in daily_series.collect()}
    date = dt.date(2021, 2, 1)
    row, step = rows[date], dt.timedelta(days=1)
    assert (row.pm25_d, row.pm25_d1, row.pm25_d2) == tuple(values[date - k * step].pm25 for k in (0, 1, 2))
    assert row.target == values[date + step].pm25 and row.wind_next == values[date + step].wind_mean_ms
    assert row.pm25_mean7 == pytest.approx(sum(values[date - k * step].pm25 for k in range(7)) / 7)
    assert row.holiday_next == (1 if values[date + step].is_school_holiday else 0)
    # The first days lack lags, the last day has no tomorrow.
    assert min(rows) == dt.date(2021, 1, 5) and max(rows) == dt.date(2021, 1, 1) + dt.timedelta(days=1398)
    assert len(forecast.FEATURES) == 16


def test_split_follows_the_day_of_the_forecast(daily_series):
    split = forecast.features(daily_series).withColumn("s", forecast.split_name(**YEARS))
    assert split.filter(F.col("date") == dt.date(2022, 12, 31)).first().s == "train"
    target = forecast.split_name(**YEARS, split_on="target_date")
    assert split.withColumn("s", target).filter(F.col("date") == dt.date(2022, 12, 31)).first().s == "validation"
    assert {r.split for r in forecast.split_summary(split, **YEARS).collect()} == {"train", "validation", "test"}


def test_forecast_pipeline(spark, daily_series):
    result = forecast.run(daily_series, YEARS, depths=[5, None], leaves=[5], shares=[1.0, 0.5], trees=10)
    assert result["grid"].count() == 4 and result["grid"].first().valid_MAE == min(r.valid_MAE for r in result["grid"].collect())
    test = {r.model: r for r in result["test"].collect()}
    assert test["linear regression"].MAE < test["persistence"].MAE
    assert test["random forest"].MAE < test["persistence"].MAE
    assert result["gain"].first().gain == pytest.approx(1 - test["random forest"].MAE / test["persistence"].MAE)
    assert 0 < result["gain"].first().gain < 1
    # The metrics of every set, by SQL from the stored forecasts.
    predicted = result["forecasts"].toPandas()
    alert = settings.GUIDELINE if result["alert_threshold"] is None else result["alert_threshold"]
    for split, table in (("validation", "validation"), ("test", "test"), ("demo", "demo_metrics")):
        for row in result[table].collect():
            column = {"persistence": "pm25_d", "linear regression": "linear"}.get(row.model, "forest")
            limit = alert if "chosen" in row.model else settings.GUIDELINE
            wanted = duckdb.sql(f"""
                SELECT COUNT(*), AVG(ABS(target - {column})), SQRT(AVG((target - {column})**2)),
                       COALESCE(COUNT(*) FILTER (target > {settings.GUIDELINE} AND {column} > {limit})
                                / NULLIF(COUNT(*) FILTER (target > {settings.GUIDELINE}), 0), 0)
                FROM predicted WHERE split = '{split}'""").fetchall()[0]
            assert (row.n, row.MAE, row.RMSE, row.recall) == pytest.approx(wanted, abs=1e-6), (split, row.model)
    assert len(result["validation"].collect()) == 4
    assert sum(r.n for r in result["confusion"].collect()) == test["persistence"].n
    ranked = [r.feature for r in result["importance"].orderBy(F.desc("mae_increase")).collect()]
    assert len(ranked) == 16 and ranked[0] in ("wind_next", "pm25_d")
    path = scratch_path(spark, "model")
    forecast.save_model(result["model"], path)
    rows = forecast.features(daily_series).filter("year(date) = 2024")
    assert forecast.score(path, rows).filter("forecast is null").count() == 0


def test_codes_are_looked_up_where_the_facts_are(spark, monkeypatch):
    daily = spark.createDataFrame([(dt.date(2024, 1, d), s, "N", 1.0, 2.0, 24) for d in (2, 1) for s in ("B", "A")], "date date, station_code string, pollutant_code string, mean double, max double, n_hours bigint")
    station = spark.createDataFrame([(1, "A"), (2, "B")], "station_id int, station_code string")
    pollutant = spark.createDataFrame([(1, "N")], "pollutant_id int, pollutant_code string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = star.fact_rows(daily, station, pollutant)
        assert "SortMergeJoin" not in facts._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r)[:4] for r in facts.select("measurement_id", "date", "station_id", "pollutant_id").orderBy("measurement_id").collect()] == [
            (n + 1, dt.date(2024, 1, 1 + n // 2), 1 + n % 2, 1) for n in range(4)
        ]
        # A table that is too large for that is joined by size.
        plan = daily.join(joins.dimension(station, rows=1), "station_code")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_forest_is_fitted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(forecast, "PART_TREES", 4)
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 7 + i % 3)) for i in range(80)], "id int, a double, b double, target double")
    vectors = forecast.assembled(rows, ["a", "b"])
    shallow, deep = forecast.fit_forests(vectors, [forecast.Point(2), forecast.Point()], trees=10)
    for forest, depth in ((shallow, 2), (deep, 30)):
        *parts, _ = forest.stages
        assert [part.getNumTrees for part in parts] == [4, 4, 2] and max(t.depth for part in parts for t in part.trees) <= depth
        each = [[tree.predict(r.features) for part in parts for tree in part.trees] for r in vectors.orderBy("id").collect()]
        found = forest.transform(vectors)
        assert found.columns == ["id", "a", "b", "target", "features", "forecast"]
        assert [r.forecast for r in found.orderBy("id").collect()] == pytest.approx([sum(one) / 10 for one in each])
    # Parts draw samples of their own.
    first, second = deep.stages[:2]
    assert [t.toDebugString for t in first.trees] != [t.toDebugString for t in second.trees]


def test_trees_do_not_go_to_the_tasks_and_are_the_same(spark):
    rows = spark.createDataFrame([(i, float(i % 7), float(i * 13 % 50), float(i % 7 + i % 3)) for i in range(200)], "id int, a double, b double, target double")
    vectors = forecast.assembled(rows, ["a", "b"])
    model = forecast.fit_part(vectors, forecast.Point(), 5)
    assert model.getCacheNodeIds()
    plain = RandomForestRegressor(
        featuresCol="features", labelCol="target", numTrees=5, maxDepth=30, maxBins=128, featureSubsetStrategy="all", seed=settings.SEED
    ).fit(vectors)
    assert [t.toDebugString.split("\n", 1)[1] for t in model.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]


def test_a_forest_is_measured_while_others_are_fitted_and_not_kept(spark, monkeypatch):
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 7 + i % 3)) for i in range(80)], "id int, a double, b double, target double")
    vectors = forecast.assembled(rows, ["a", "b"])
    gate, fit = threading.Event(), forecast.fit_part

    def held(train, point, *rest):
        if point.max_depth == 1:
            assert gate.wait(60)
        return fit(train, point, *rest)

    monkeypatch.setattr(forecast, "fit_part", held)
    forests = forecast.each_forest(vectors, [forecast.Point(1), forecast.Point(3)], trees=3, at_once=2)
    point, model = next(forests)
    assert point == forecast.Point(3) and model.transform(vectors).filter("forecast IS NULL").count() == 0
    kept = weakref.ref(model)
    del model
    gate.set()
    assert next(forests)[0] == forecast.Point(1)
    gc.collect()
    assert kept() is None and list(forests) == []
    # The best of the grid is the first of the table, and its forest is the one that comes back.
    tuned = forecast.tune(vectors, vectors, [1, 3], [1], [1.0], trees=3)
    error = tuned.model.transform(vectors).agg(F.avg(F.abs(F.col("target") - F.col("forecast")))).first()[0]
    assert tuned.best["max_depth"] == 3 == tuned.grid.first().max_depth and tuned.grid.first().valid_MAE == pytest.approx(error)


def test_points_that_differ_in_depth_only_are_one_fit(spark, monkeypatch):
    monkeypatch.setattr(forecast, "PART_TREES", 3)
    rows = spark.createDataFrame(
        [(i, float(i * 7 % 31), float(i * 13 % 50), float(i * i % 23 + i % 7)) for i in range(240)], "id int, a double, b double, target double"
    )
    vectors = forecast.assembled(rows, ["a", "b"])
    train, valid = (vectors.filter(f"id % 3 {rest}").coalesce(1) for rest in ("> 0", "= 0"))
    fitted, fit = [], forecast.fit_part

    def counted(train, point, *rest):
        fitted.append(point)
        return fit(train, point, *rest)

    monkeypatch.setattr(forecast, "fit_part", counted)
    depths, leaves, shares = [None, 2, 4], [1, 4], [1.0, 0.5]
    tuned = forecast.tune(train, valid, depths, leaves, shares, trees=5)
    best = forecast.Point(**tuned.best)
    # Of the points with one leaf size and share, parts of 3 and 2 trees of one forest; the best has its own.
    deep = {point for point in fitted if point.max_depth is None}
    assert {point[1:] for point in deep} == {(1, 1.0), (1, 0.5), (4, 1.0), (4, 0.5)}
    assert len(fitted) <= 2 * (4 + 2) and set(fitted) - deep <= {best}
    # Every point's error is that of the forest fitted there.
    grid = [tuple(r) for r in tuned.grid.collect()]
    assert len(grid) == 12 and len({error for *_, error in grid}) > 8
    points = [forecast.Point(*point) for *point, _ in grid]
    for (*_, error), model in zip(grid, forecast.fit_forests(train, points, trees=5)):
        found = model.transform(valid).agg(F.avg(F.abs(F.col("target") - F.col("forecast")))).first()[0]
        assert error == pytest.approx(found, abs=1e-12)
    assert min(error for *_, error in grid) == pytest.approx(
        tuned.model.transform(valid).agg(F.avg(F.abs(F.col("target") - F.col("forecast")))).first()[0]
    )


def test_importance_permutes_within_repeats(spark):
    rows = spark.createDataFrame([(i, float(i % 7), float(i)) for i in range(60)], "id int, a double, target double")
    vectors = forecast.assembled(rows.withColumn("b", F.col("target")), ["a", "b"])
    model = forecast.fit_linear(vectors)
    found = {r.feature: r.mae_increase for r in forecast.importance(model, vectors, ["id"], ["a", "b"], repeats=4).collect()}
    # The target is b itself: shuffling b hurts by its mean distance, shuffling a not at all.
    assert found["a"] == pytest.approx(0, abs=1e-6) and 10 < found["b"] < 40
    # Rows meet their donors before the features multiply them.
    plan = forecast.importance(model, vectors, ["id"], ["a", "b"], repeats=4)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join Inner", 1)
    assert "[feature#" in above and "feature#" not in below and "repeat#" not in above


def test_no_single_task_on_facts(spark):
    """Plans of the fact-sized operators move nothing through one partition."""
    for name in ("daily_completeness", "keep_first", "long_to_wide", "rolling7_min5", "previous_row", "report_rows"):
        plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        window = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
        assert not window or "Subquery" in plan, name


def test_scans_are_pruned_and_pushed_down(spark):
    plan = contract.queries()["daily_fact"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan
    plan = contract.queries()["existence_flags"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["date", "mean", "max", "n_hours"]
    assert found.count() == 15 and found.agg(F.min("n_hours")).first()[0] >= 18


def test_contract_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(FITTED)))
def test_query_equals_its_sql(spark, oracle_connection, name):
    df = contract.queries()[name](spark, SMALL)
    assert differences(df, oracle_connection, contract.oracle_sql()[name]) == []


@pytest.fixture(scope="module")
def oracle_connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", FITTED)
def test_fit_equals_its_sql(spark, name):
    df = contract.queries()[name](spark, MEDIUM)
    assert differences(df, connect(MEDIUM), contract.oracle_sql()[name]) == []


def test_ids_survive_a_hot_first_column(spark):
    df = spark.range(1000).select(F.lit(1).alias("hot"), F.col("id").alias("x"))
    numbered = keys.dense_ids(df, ["hot", "x"], "n")
    assert numbered.filter("n <> x + 1").count() == 0


@pytest.mark.parametrize("missing", ["tiktoken", "public_tokenizers", "sensorloom.llm", "corpus_pipeline"])
def test_entry_without_a_part(missing):
    """In a process of its own, as modules that are loaded already would hide what is missing."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(contract.__file__)
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]
