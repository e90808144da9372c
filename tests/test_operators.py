"""C, D, E, F, G, K, N: operators on small fixtures."""

from __future__ import annotations

import datetime as dt
import random
import statistics as py

import pytest
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.operators import (
    calendar,
    dedup,
    filters,
    joins,
    keys,
    paging,
    quality,
    reshape,
    scoring,
    statistics,
    timeseries,
)
from sensorloom.operators.completeness import aggregate_daily


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_keep_first_sorts_ties_only(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"), F.col("id").cast("string").alias("v"))
    for kept in (
        dedup.keep_first(df, ["k"], [F.col("o")]),
        dedup.keep_first(df, ["k"], [F.col("o")], unique_order=True),
        dedup.first_seen(df, "k", ["v"], [F.col("o")]),
        dedup.keep_preferred(df, ["k"], "v", {"8": 0}, 1, [F.col("o")]),
        dedup.splice(df, ["k"], "v", ["8", "9"], "source"),
    ):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        scans = plan.split("Exchange")
        assert all("SortAggregate" not in part for part in scans[2:]), plan
        assert "ObjectHashAggregate" not in plan and "HashAggregate" in plan


KINDS = {
    "boolean": [True, False, None],
    "tinyint": [-128, 127, 0, None],
    "int": [-(2**31), 2**31 - 1, 0, None],
    "bigint": [-(2**63), 2**63 - 1, 0, None],
    "date": [dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(1970, 1, 1), None],
    "timestamp_ntz": [dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), None],
    "double": [float("-inf"), float("nan"), -0.5, None],
    "string": ["", "a", "é", None],
}


@pytest.mark.parametrize("kinds", [("bigint",), ("double", "int"), ("string", "int"), ("date", "bigint", "string"), ("timestamp_ntz", "bigint", "boolean"), ("tinyint", "bigint", "boolean", "int"), ("bigint", "bigint")])
def test_keep_first_of_any_order(spark, kinds):
    rng = random.Random(str(kinds))
    names = [f"o{i}" for i in range(len(kinds))]
    data = [(rng.choice([1, 2, 3, None]), *[rng.choice(KINDS[k]) for k in kinds], rng.choice("xyz")) for _ in range(60)]
    df = spark.createDataFrame(data, "k int, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds)) + ", v string").repartition(3)
    found = dedup.keep_first(df, ["k"], [F.col(n) for n in names])
    expected = dedup.least_row(df, ["k"], [F.col(n) for n in names])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.count() == 4


def test_keep_first_ignores_physical_order(spark):
    data = [("a", 3, "x"), ("a", 1, "y"), ("a", 1, "b"), ("b", 2, None), (None, 5, "n"), (None, 4, "m")]
    for n in (1, 4):
        df = spark.createDataFrame(data, "k string, o int, v string").repartition(n)
        first = dedup.keep_first(df, ["k"], [F.col("o")])
        assert sorted(rows(first), key=repr) == sorted([("a", 1, "b"), ("b", 2, None), (None, 4, "m")], key=repr)
    unique = dedup.keep_first(df.filter("v <> 'b' or v is null"), ["k"], [F.col("o")], unique_order=True)
    assert sorted(rows(unique), key=repr) == sorted([("a", 1, "y"), ("b", 2, None), (None, 4, "m")], key=repr)


def test_keep_first_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    first = dedup.keep_first(df, ["k"], [F.col("id")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert first.count() == df.select("k").distinct().count()
    assert first.filter("k = 0").first().id == 0


def test_priority_and_splice(spark):
    data = [(day(1), "p", s, i) for i, s in enumerate(["opendata_csv", "x", "pdf_report", "html_page"])]
    data += [(day(2), "p", "x", 9), (day(3), "p", "html_page", 1), (day(3), "p", "opendata_csv", 0)]
    df = spark.createDataFrame(data, "date date, pollutant string, source string, i int")
    ranks = {"pdf_report": 0, "html_page": 1, "opendata_csv": 2}
    best = dedup.keep_preferred(df, ["date", "pollutant"], "source", ranks, 9)
    assert [r[2] for r in rows(best, "date")] == ["pdf_report", "x", "html_page"]
    daily = spark.createDataFrame(
        [(day(1), "B", "q", 1.0), (day(1), "A", "q", 2.0), (day(2), "B", "q", 3.0), (day(2), "C", "q", 4.0)],
        "date date, station string, code string, mean double",
    )
    spliced = dedup.splice(daily, ["date", "code"], "station", ["A", "B"], "source")
    assert [(r.source, r.mean) for r in spliced.orderBy("date").collect()] == [("A", 2.0), ("B", 3.0)]


def test_first_seen(spark):
    df = spark.createDataFrame([("s", "new", 2), ("s", "old", 1), ("t", "only", 5)], "code string, name string, o int")
    assert rows(dedup.first_seen(df, "code", ["name"], [F.col("o")]), "code") == [("s", "old"), ("t", "only")]


@pytest.mark.parametrize("hours,kept", [(17, False), (18, True), (23, True), (24, True)])
def test_daily_completeness(spark, hours, kept):
    data = [(dt.datetime(2024, 1, 1, h), "s", float(h)) for h in range(hours)] + [
        (dt.datetime(2024, 1, 1, 23, 30), "s", None)
    ]
    df = spark.createDataFrame(data, "t timestamp_ntz, station string, value double")
    found = rows(aggregate_daily(df, F.col("t").cast("date"), ["station"], "value", 18))
    expected = [(day(1), "s", round(sum(range(hours)) / hours, 2), float(hours - 1), hours)]
    assert found == (expected if kept else [])


def test_filters(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "c string, v int")
    assert df.filter(filters.all_of([None, None])).count() == 3
    assert df.filter(filters.all_of([filters.equals_code(F.col("c"), "a"), F.col("v") < 5])).count() == 1
    assert filters.equals_code(F.col("c"), "") is None and filters.equals_code(F.col("c"), None) is None
    assert df.filter(filters.differs_or_missing(F.col("c"), "A")).count() == 2
    kept, rejected = filters.split_known(df, F.col("c").isin("A"))
    assert (kept.count(), rejected.count()) == (1, 2)
    assert filters.complete_rows(df, ["c"]).count() == 2
    assert rows(filters.lookup(df, "c", "b", upper=True)) == [("B", 2)]
    with pytest.raises(ValueError, match="start: .* is no ISO day"):
        filters.within_days(F.col("d"), "2024-13-01", None)
    with pytest.raises(ValueError, match="type must be one of"):
        filters.one_of(F.col("c"), "z", ["x"], "type")


def test_joins(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(joins.keep_matching(left, right, "k")) == [(1, "x")]
    assert sorted(r[1] for r in rows(joins.keep_missing(left, right, "k"))) == ["y", "z"]
    assert sorted(r[1:] for r in rows(joins.flag_matching(left, right, "k", "f"))) == [("x", 1), ("y", 0), ("z", 0)]
    periods = spark.createDataFrame(
        [(day(1), day(3), "p"), (day(2), day(2), "empty"), (day(9), day(5), "reversed"), (None, day(2), "open")],
        "s date, e date, n string",
    )
    days = joins.expand_intervals(periods, F.col("s"), F.col("e"), "date", ["n"])
    assert rows(days, "date") == [(day(1), "p"), (day(2), "p")]


def test_an_unknown_code_is_an_error_that_names_it(spark):
    known = spark.createDataFrame([("A", 1)], "code string, id int")
    facts = spark.createDataFrame([("A",), ("B",), (None,)], "code string")
    with pytest.raises(Exception, match="code without id: B"):
        joins.lookup_id(facts, known, "code", "id").collect()
    assert [r.id for r in joins.lookup_id(facts.filter("code <> 'B'"), known, "code", "id").collect()] == [1]
    assert sorted(str(r.id) for r in joins.lookup_id(facts, known, "code", "id", strict=False).collect()) == ["1", "None", "None"]


def test_conform_and_concatenate(spark):
    a = spark.createDataFrame([("2024-01-01", 1)], "d string, x int")
    b = spark.createDataFrame([("2024-01-02", "u")], "d string, y string")
    both = reshape.concatenate(a, b)
    assert rows(both, "d") == [("2024-01-01", 1, None), ("2024-01-02", None, "u")]
    conformed = reshape.conform(both, schemas.PUBLIC_HOLIDAYS, {"date": "d", "holiday_name": "y"})
    assert conformed.schema == schemas.PUBLIC_HOLIDAYS
    assert rows(conformed, "date") == [(day(1), None), (day(2), "u")]


def series(spark, values):
    data = [("s", day(n), v) for n, v in values.items()]
    return spark.createDataFrame(data, "k string, date date, v double")


def test_previous_row_is_not_the_previous_day(spark):
    df = series(spark, {1: 10.0, 2: 20.0, 4: 40.0})
    before = rows(timeseries.previous_row(df, ["k"], "v", "before").select("date", "before"), "date")
    assert before == [(day(1), None), (day(2), 10.0), (day(4), 20.0)]
    joined = timeseries.at_day_offset(df, ["k"], {"b": ("v", 1), "n": ("v", -2)}).select("date", "b", "n")
    assert rows(joined, "date") == [(day(1), None, None), (day(2), 10.0, 40.0), (day(4), None, None)]
    dense = timeseries.dense(df, ["k"])
    lagged = dense.select("date", timeseries.lag_days(F.col("v"), 1, ["k"]).alias("b"))
    assert rows(lagged, "date") == [(day(1), None), (day(2), 10.0), (day(3), 20.0), (day(4), None)]


def test_rolling_mean_needs_enough_values(spark):
    df = series(spark, {n: float(n) for n in (1, 2, 3, 4, 6, 7, 8, 20)})
    sparse = df.select("date", timeseries.rolling_mean(F.col("v"), 7, 5, ["k"]).alias("m"))
    dense = timeseries.dense(df, ["k"]).select(
        "date", timeseries.rolling_mean(F.col("v"), 7, 5, ["k"], is_dense=True).alias("m")
    )
    expected = {day(6): 3.2, day(7): 23 / 6, day(8): 5.0}
    for found in (dict(rows(sparse)), dict(rows(dense))):
        assert {d: m for d, m in found.items() if m is not None and d <= day(8)} == expected
    assert dict(rows(sparse))[day(20)] is None


def test_calendar_and_gaps(spark):
    df = series(spark, {1: 1.0, 3: 2.0})
    days = calendar.spine(calendar.day_range(df))
    assert [r[0] for r in rows(days, "date")] == [day(1), day(2), day(3)]
    assert rows(calendar.spine(calendar.day_range(df.limit(0)))) == []
    assert rows(calendar.on_spine(df.select("date", "v"), days), "date")[1] == (day(2), None)
    assert rows(timeseries.gap_report(df, ["k"])) == [("s", day(1), day(3), 2, 1)]
    months = series(spark, {1: 1.0, 2: 2.0, 70: 5.0})
    assert [r[1] for r in rows(timeseries.monthly_mean(months, "v"), "month_start")] == [1.5, None, 5.0]
    years = spark.createDataFrame([(day(1), None), (day(400), 1.0)], "date date, v double")
    assert rows(timeseries.empty_years(years, "v")) == [(2024,)]
    assert calendar.spine_between(spark, "2024-02-28", "2024-03-01").count() == 3


def test_quantiles_match_a_sort(spark):
    rng = random.Random(7)
    data = [("hot", round(rng.gauss(20, 9), 2)) for _ in range(2000)] + [("cold", 1.0), ("cold", 2.0), ("one", 5.0)]
    df = spark.createDataFrame(data + [("hot", None)], "g string, v double").repartition(4)
    found = {(r.g, r.share): r.quantile for r in statistics.quantiles(df, ["g"], "v", [0.25, 0.5, 0.75, 1.0]).collect()}
    for group in ("hot", "cold"):
        values = [v for g, v in data if g == group]
        quartiles = py.quantiles(values, n=4, method="inclusive")
        for share, expected in zip((0.25, 0.5, 0.75), quartiles):
            assert found[group, share] == pytest.approx(expected)
        assert found[group, 1.0] == max(values)
    assert found["one", 0.5] == 5.0


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e9])
def test_quantiles_of_large_groups_order_a_bracket_only(spark, monkeypatch, scale):
    monkeypatch.setattr(statistics, "ACCURACY", 100)
    rng = random.Random(8)
    values = [rng.gauss(0, 1) * scale for _ in range(4000)] + [0.25 * scale] * 3000
    data = [("hot", v) for v in values] + [(None, v) for v in values[:99]] + [("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    shares = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    found = {(r.g, r.share): r.quantile for r in statistics.quantiles(df, ["g"], "v", shares).collect()}
    assert len(found) == 18
    for group in ("hot", None, "two"):
        own = sorted(v for g, v in data if g == group)
        for share in shares:
            at = share * (len(own) - 1)
            low = int(at)
            expected = own[low] * (1 - (at - low)) + own[min(low + 1, len(own) - 1)] * (at - low)
            assert found[group, share] == pytest.approx(expected, rel=1e-12)
    edges = statistics.brackets(df.filter("g = 'hot'").select("g", F.col("v").alias("_value")), ["g"], [0.9]).first()._brackets[0]
    assert sum(edges.low <= v <= edges.high for v in values) < 700


def test_quantiles_send_brackets_to_the_rows(spark):
    df = spark.createDataFrame([("hot", float(n)) for n in range(300)] + [(None, 1.0)], "g string, v double")
    found = statistics.quantiles(df, ["g"], "v", [0.5])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(r.g, r.quantile) for r in found.collect()} == {("hot", 149.5), (None, 1.0)}


def test_years_without_a_value_per_series(spark):
    data = [("a", dt.date(2023, 5, 1), None), ("a", dt.date(2024, 5, 1), 1.0), ("b", dt.date(2024, 1, 1), None), ("b", dt.date(2024, 1, 2), None)]
    df = spark.createDataFrame(data, "s string, date date, v double")
    assert rows(timeseries.empty_years(df, "v", series=["s"]), "s") == [("a", 2023), ("b", 2024)]
    assert rows(timeseries.empty_years(df, "v")) == [(2023,)]


def test_memory_and_crosstab(spark):
    df = spark.createDataFrame([(20.0, 20.0), (20.0, 1.0), (1.0, 20.0), (1.0, 1.0), (1.0, None)], "a double, b double")
    assert rows(statistics.exceedance_memory(df, "a", "b", 15.0)) == [(4, 0.5, 0.5, 0.0)]
    rising = spark.createDataFrame([(float(n), 2.0 * n + 1) for n in range(9)], "a double, b double")
    assert statistics.exceedance_memory(rising, "a", "b", 4.0).first().r == 1.0
    assert rows(statistics.crosstab(df, F.col("a"), "a", "b", ["1.0", "7.0"]), "a") == [(1.0, 1, 0), (20.0, 1, 0)]


def test_dense_ids_are_dense(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") % 3).alias("k"), "id", F.lit("hot").alias("hot")).repartition(7)
    numbered = keys.dense_ids(df, ["hot", "k", "id"], "number")
    found = [tuple(r) for r in numbered.orderBy("k", "id").select("number").collect()]
    assert [r[0] for r in found] == list(range(1, n + 1))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert numbered.columns == ["number", "k", "id", "hot"] and "BroadcastHashJoin" in plan


def test_pages(spark):
    df = spark.range(250).withColumn("v", F.col("id") * 2)
    with pytest.raises(ValueError):
        paging.page_window(0, 10)
    assert paging.page_window(1, 500) == (1, 100)
    page = paging.page_of(df, [F.desc("id")], 2, 10)
    assert [r.id for r in page.collect()] == list(range(239, 229, -1))
    deep = paging.page_of(df, [F.desc("id")], 20, 10)
    assert [r.id for r in deep.collect()] == list(range(59, 49, -1))
    numbered = paging.numbered(df, [F.desc("id")])
    assert numbered.rows.count() == 250 and paging.page_info(numbered, 3, 20).first().total_items == 250
    assert [r.id for r in paging.page_of_numbered(numbered, 20, 10).collect()] == list(range(59, 49, -1))
    beyond = paging.page_of_numbered(numbered, 26, 10)
    assert beyond.columns == df.columns and beyond.count() == 0
    pages = [[r.id for r in paging.page_of_numbered(numbered, n, 37).collect()] for n in range(1, 8)]
    assert sum(pages, []) == list(range(249, -1, -1))
    plan = paging.page_of_numbered(numbered, 20, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_slot" in plan.split("PushedFilters: [")[1].split("]")[0]
    none = paging.numbered(df.limit(0), ["id"])
    assert paging.page_of_numbered(none).count() == 0 and paging.page_info(none).first().total_pages == 1
    assert paging.page_of(df, [F.desc("id")], 26, 10).count() == 0
    assert rows(paging.page_info(df, 25, 10)) == [(25, 10, 250, 25, None, 24)]
    assert rows(paging.page_info(df.limit(0))) == [(1, 20, 0, 1, None, None)]
    after = paging.page_after(df, F.col("id") > 10, [F.col("id")], 3)
    assert [r.id for r in after.collect()] == [11, 12, 13]
    assert [r.id for r in paging.top_k(df, [F.desc("v")], 2).collect()] == [249, 248]


def test_quality_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (1, "a"), (7, None), (None, "abc")], "pid int, v string")
    assert rows(quality.duplicate_keys(child, ["pid", "v"])) == [(1, "a", 2)]
    assert rows(quality.key_check(child, "child", ["pid", "v"])) == [("child(pid, v)", 4, 3, 1)]
    assert rows(quality.reference_check(child, parent, "fk", "pid", "id")) == [("fk", 3, 2, 1)]
    checks = {**quality.not_null(["v"]), **quality.max_length({"v": 2}), "pid > 0": F.col("pid") > 0}
    assert [r[2] for r in rows(quality.predicate_checks(child, checks))] == [1, 1, 1]
    assert rows(quality.missing_share(child, ["pid", "v"]), "column") == [("pid", 1, 0.25), ("v", 1, 0.25)]
    assert rows(quality.missing_share(parent, ["id"])) == []
    audit = quality.column_audit(spark, {"station": schemas.STATION, "visitor": parent.schema}, schemas.STAR)
    assert [r.column for r in audit.filter("refused").collect()] == ["id"]
    hours = [("a", dt.datetime(2024, 1, 1, h)) for h in range(3)] + [("b", dt.datetime(2025, 1, 1, 0))]
    hours += [("b", dt.datetime(2024, 1, 1, 0))]
    coverage = quality.coverage(spark.createDataFrame(hours, "s string, t timestamp_ntz"), "s", "t")
    assert rows(coverage, "s", "year") == [("a", 2024, 100.0), ("a", 2025, 0.0), ("b", 2024, 33.0), ("b", 2025, 100.0)]


def test_scores(spark):
    df = spark.createDataFrame(
        [(day(1), 20.0, 18.0), (day(2), 10.0, 16.0), (day(3), 16.0, 12.0), (day(4), 5.0, 5.0)],
        "date date, y double, f double",
    )
    score = scoring.metrics(df, "m", "y", "f").first()
    assert (score.n, score.MAE, score.recall, score.precision, score.F1) == (4, 3.0, 0.5, 0.5, 0.5)
    assert score.RMSE == pytest.approx((56 / 4) ** 0.5, abs=1e-6)
    mean = (20 + 10 + 16 + 5) / 4
    total = sum((v - mean) ** 2 for v in (20, 10, 16, 5))
    assert score.R2 == pytest.approx(1 - 56 / total, abs=1e-6)
    none = scoring.metrics(df.filter("y < 15"), "m", "y", "f", alert_above=99).first()
    assert (none.recall, none.precision, none.F1) == (0, 0, 0)
    curve = scoring.threshold_curve(df, "y", "f", [11, 12, 17])
    assert [r[1] for r in rows(curve, "threshold")] == [1.0, 0.5, 0.5]
    assert scoring.choose_threshold(curve).first()[0] == 11
    assert scoring.choose_threshold(curve, 1.1).first()[0] is None
    assert [r.n for r in scoring.confusion(df, "y", "f").orderBy("actual_above", "alert").collect()] == [1, 1, 1, 1]
    assert sum(r.n for r in scoring.confusion(df.limit(0), "y", "f").collect()) == 0
    shown = scoring.published(df, "f", "y", "f", 16.0).orderBy("day").first()
    assert (shown.forecast_day, shown.alert) == (day(2), "ALERT")
