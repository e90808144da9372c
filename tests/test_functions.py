"""B: scalar expressions."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import dates, numeric, text
from sensorloom.operators import filters, joins, quality


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_to_double_keeps_numbers_only(spark):
    values = ["1.5", " 2 ", "-3", "1e2", "n/a", "", "NaN", "1.0d", "7f", None]
    assert column(spark, values, "string", numeric.to_double) == [1.5, 2, -3, 100, None, None, None, None, None, None]


def test_clamp_keeps_null(spark):
    assert column(spark, [-3.0, 0.0, 2.5, None], "double", numeric.clamp_floor) == [0, 0, 2.5, None]


def test_rounding_modes(spark):
    values = [0.125, 2.675, 1.005, -0.125, None]
    assert column(spark, values, "double", lambda v: numeric.portable_round(v, 2, "half_even")) == [
        0.12,
        2.68,
        1.0,
        -0.12,
        None,
    ]
    assert column(spark, values, "double", lambda v: numeric.portable_round(v, 2)) == [0.13, 2.68, 1.01, -0.13, None]
    with pytest.raises(ValueError):
        numeric.portable_round(F.lit(1.0), 1, "up")


def test_threshold_flags(spark):
    values = [15.0, 15.004, 15.01, None]
    assert column(spark, values, "double", lambda v: numeric.exceeds(v, 15.0)) == [0, 1, 1, None]
    # The stored mean is rounded before it is compared.
    rounded = lambda v: numeric.exceeds(numeric.portable_round(v, 2, "half_even"), 15.0)
    assert column(spark, values, "double", rounded) == [0, 0, 1, None]
    one = lambda v: numeric.exceeds_for(v, "PM25", F.lit(20.0), 15.0)
    assert column(spark, ["PM25", "NO2", None], "string", one) == [1, None, None]


def test_classes_differ_at_their_edges(spark):
    values = [0.0, 2.0, 2.1, 4.0, 5.0, 6.0, 20.0, 21.0, None]
    left = column(spark, values, "double", lambda v: numeric.classes_left_closed(v, [2, 4, 6], list("abcd")))
    assert left == ["a", "b", "b", "c", "c", "d", "d", "d", "d"]
    right = column(
        spark, values, "double", lambda v: numeric.classes_right_closed(v, [0, 2, 3, 4, 5, 20], list("abcde"))
    )
    assert right == [None, "a", "b", "c", "d", "e", "e", None, None]


def test_ratio_flags_and_labels(spark):
    assert column(spark, [2.0, 0.0, None], "double", lambda v: numeric.safe_ratio(F.lit(1.0), v)) == [0.5, None, None]
    assert column(spark, [0, 1, None], "int", lambda v: numeric.either_flag(v, F.lit(0))) == [0, 1, 0]
    assert column(spark, [13.04, 13.06], "double", lambda v: numeric.alert_label(v, 13.0, 1)) == ["-", "ALERT"]
    assert column(spark, [13.04, 13.0], "double", lambda v: numeric.alert_label(v, 13.0)) == ["ALERT", "-"]


def test_exact_mean_does_not_depend_on_order(spark):
    values = [(0.1,), (0.2,), (0.3,), (1e9,), (None,)]
    up = spark.createDataFrame(values, "v double").repartition(3)
    down = spark.createDataFrame(values[::-1], "v double").coalesce(1)
    results = {df.agg(numeric.exact_mean(F.col("v"), 2)).first()[0] for df in (up, down)}
    assert results == {1000000000.6 / 4}
    assert up.filter("v > 1e12").agg(numeric.exact_mean(F.col("v"))).first()[0] is None


def test_means_are_not_cut(spark):
    """Values of many decimals, very large ones and NaN have their plain mean and stop nothing."""
    groups = {
        "small": [0.00004, 0.00002],
        "six": [1.123457, 2.000001, 3.5],
        "large": [1e16, 3.0],
        "huge": [1e300, -1e300],
        "two": [0.1, 0.2, 0.3],
        "empty": [None],
    }
    rows = [(name, v) for name, values in groups.items() for v in values] + [("nan", float("nan")), ("nan", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for decimals in (2, 4):
        found = {r.k: r.m for r in df.groupBy("k").agg(numeric.exact_mean(F.col("v"), decimals).alias("m")).collect()}
        for name, values in groups.items():
            assert found[name] == (None if name == "empty" else pytest.approx(sum(values) / len(values), rel=1e-15))
        assert math.isnan(found["nan"]) and found["two"] == 0.6 / 3


def test_iso_text_to_utc(spark):
    values = [
        "2026-01-01 01:00:00Z",
        "2023-10-20T22:00:00+00:00",
        "2023-10-21T00:00:00+02:00",
        "2024-01-01",
        "2024-01-01 05:00:00",
        "soon",
        None,
    ]
    assert column(spark, values, "string", dates.iso_utc) == [
        dt.datetime(2026, 1, 1, 1),
        dt.datetime(2023, 10, 20, 22),
        dt.datetime(2023, 10, 20, 22),
        dt.datetime(2024, 1, 1),
        dt.datetime(2024, 1, 1, 5),
        None,
        None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_local_time_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ends = ["2025-10-26 01:00:00Z", "2025-10-26 02:00:00Z", "2025-03-30 02:00:00Z", "2026-01-01 00:00:00Z"]
        starts = column(spark, ends, "string", lambda v: dates.hour_start_local(dates.iso_utc(v)).cast("string"))
        # Both hours of the autumn change start at 02:00; the spring day has no 02:00.
        assert starts == [
            "2025-10-26 02:00:00",
            "2025-10-26 02:00:00",
            "2025-03-30 03:00:00",
            "2026-01-01 00:00:00",
        ]
        alerts = ["2019/01/20 23:00:00+00", "2019/06/30 21:00:00+00", "bad"]
        assert column(spark, alerts, "string", dates.slashed_utc_to_local_day) == [
            dt.date(2019, 1, 21),
            dt.date(2019, 6, 30),
            None,
        ]
        clock = ["2024-03-10 02:30:00"]
        floor = column(spark, clock, "string", lambda v: dates.floor_hour(v.cast("timestamp_ntz")).cast("string"))
        assert floor == ["2024-03-10 02:00:00"]
        seconds = lambda v: dates.clock_seconds(v.cast("timestamp_ntz"))
        moments = ["1970-01-02 00:00:01", "2024-03-10 02:30:00", "2024-03-10 03:30:00"]
        assert column(spark, moments, "string", seconds) == [86401, 1710037800, 1710041400]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_days_and_weekdays(spark):
    assert column(spark, ["20240131", "2024x"], "string", dates.compact_day) == [dt.date(2024, 1, 31), None]
    assert column(spark, ["31/01/2024", "31/02/2024"], "string", dates.french_day) == [dt.date(2024, 1, 31), None]
    monday, sunday = dt.date(2024, 1, 1), dt.date(2024, 1, 7)
    assert column(spark, [monday, sunday], "date", dates.weekday_from_1) == [1, 7]
    assert column(spark, [monday, sunday], "date", dates.weekday_from_0) == [0, 6]
    assert column(spark, [monday, sunday], "date", dates.is_weekend) == [0, 1]
    assert column(spark, [monday], "date", dates.iso_day_text) == ["2024-01-01"]


def test_station_types(spark):
    expected = {
        "Champigny-sur-Marne": "urban_background",
        "RN20 Montlhéry": "traffic",
        "RN 2 Pantin": "traffic",
        "Boulevard Haussmann": "traffic",
        "Place de l'Opéra": "traffic",
        "Zone rurale Nord": "rural",
        "Rambouillet, route du parc": "rural",
        "Tour Eiffel 3e étage, avenue": "observation",
        "PARIS 1er Les Halles": "urban_background",
        "Éplace": "urban_background",
    }
    assert column(spark, list(expected), "string", text.station_type) == list(expected.values())


def test_names_labels_and_levels(spark):
    assert column(spark, [" Date de début ", "Fin d'été"], "string", text.normalise) == ["date_de_debut", "fin_d_ete"]
    assert text.normalise_header(" Académies ") == "academies"
    assert column(spark, ["a", "b", None], "string", lambda v: text.harmonise(v, {"a": "x"})) == ["x", None, None]
    assert column(spark, ["a", "b", None], "string", lambda v: text.replace_known(v, {"a": "x"})) == ["x", "b", None]
    assert column(spark, ["True", "false", "", None], "string", text.flag_from_text) == [1, 0, None, None]
    assert column(spark, [True, False, None], "boolean", text.flag_from_text) == [1, 0, None]
    # The region wins over the length of its code.
    assert column(spark, [0, 75, 75101], "int", text.geo_level) == ["region", "department", "municipality"]
    literal = lambda v: text.contains_ignoring_case(v, "50%")
    assert column(spark, ["Rue 50% X", "Rue 500"], "string", literal) == [True, False]


def test_collated_text(spark):
    names = ["Champs-Élysées", "CHAMPS-ELYSEES", "Quai", None, "champs-elysées 50%"]
    df = spark.createDataFrame([(n, s) for n, s in enumerate(names)], "n int, s string")
    found = lambda condition: [r.n for r in df.filter(condition).orderBy("n").collect()]
    assert found(text.contains_text(F.col("s"), "elysee")) == [0, 1, 4]
    assert found(text.contains_text(F.col("s"), "ÉLYSÉES 50%")) == [4]
    assert found(text.contains_text(F.col("s"), "")) == [0, 1, 2, 4]
    assert found(filters.equals_text(F.col("s"), "champs-élysées")) == [0, 1] and filters.equals_text(F.col("s"), "") is None
    codes = spark.createDataFrame([("a1",), ("A1",), ("Á1",), ("b",), ("c",), ("c",), (None,), (None,)], "code string")
    rows = {tuple(r) for r in quality.duplicate_spellings(codes, "code").collect()}
    assert rows == {("A1", 3, 3), ("c", 1, 2)}
    ids = spark.createDataFrame([("A1", 7), ("B", 8), ("C", 9)], "code string, id int")
    looked = joins.lookup_id(codes, ids, "code", "id", collation="UNICODE_CI_AI")
    assert sorted(r.id or 0 for r in looked.collect()) == [0, 0, 7, 7, 7, 8, 9, 9]
    with pytest.raises(Exception, match="code without id"):
        joins.lookup_id(codes, ids, "code", "id").collect()
