"""A, J and M1-M8: files, pages and sinks."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.operators import quality
from sensorloom.plans import context, measurements
from sensorloom.sources import pages, sinks, tabular, wide_csv


def day(y, m, d):
    return dt.date(y, m, d)


def write(path, text, bom=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(("﻿" if bom else "") + text, encoding="utf-8")


def wide_file(codes, names, pollutant, lines):
    n = len(codes)
    header = [
        ["x"] + [f"{code}:{pollutant}" for code in codes],
        ["x"] + [f'"{name}"' if "," in name else name for name in names],
        ["x"] + codes,
        ["x"] + [f"{pollutant} long name"] * n,
        ["x"] + [pollutant] * n,
        ["x"] + ["microg/m3"] * n,
    ]
    return "\n".join([",".join(row) for row in header] + lines) + "\n"


@pytest.fixture()
def station_folder(tmp_path):
    full = [f"2026-01-{d:02d} {h:02d}:00:00Z" for d in (5, 6) for h in range(24)]
    lines = [f"{t},{i % 5}.5,{'' if i % 2 else 7},bad," for i, t in enumerate(full)]
    lines[3] = f"{full[3]},-2.5,1,9.0,"
    write(
        tmp_path / "2026" / "2026_PM25.csv",
        wide_file(["PA01H", "RD934", "RD934", "VIDE"], ["PARIS 1er, Les Halles", "RD934 Nord", "RD934 bis", "Vide"], "PM25", lines),
        bom=True,
    )
    # The first hour of 2026 also ends the file of 2025; the autumn change of 2025 repeats an hour.
    write(
        tmp_path / "2025 PM25.csv",
        wide_file(
            ["PA01H"],
            ["Les Halles (old name)"],
            "PM25",
            ["2025-10-26 01:00:00Z,10", "2025-10-26 02:00:00Z,20", "2026-01-05 00:00:00Z,99", ""],
        ),
    )
    write(tmp_path / "2025-no2.csv", wide_file(["PA01H"], ["x"], "NO2", ["2025-07-01 12:00:00Z,3"]))
    write(tmp_path / "2024_NO2_boulevard_ring.csv", "time,A-B,\"C, D\"\n" + "".join(
        f"2024-01-0{d} {h:02d}:00:00,{h},{'' if h < 7 else h}\n" for d in (1, 2) for h in range(18 if d == 1 else 17)
    ))
    write(tmp_path / "notes.csv", "free text\n")
    write(tmp_path / "2024_PM25.txt", "no csv\n")
    return str(tmp_path)


def test_station_files(spark, station_folder):
    found = measurements.load_measurements(spark, station_folder)
    hourly = {(r.timestamp, r.station_code, r.pollutant_code): r.value for r in found.hourly.collect()}
    # End of hour in UTC -> start of hour in Paris.
    assert hourly[dt.datetime(2025, 7, 1, 13), "PA01H", "NO2"] == 3.0
    # The earlier of the two hours that share a local time stays.
    assert hourly[dt.datetime(2025, 10, 26, 2), "PA01H", "PM25"] == 10.0
    # The 2025 file comes first in path order.
    assert hourly[dt.datetime(2026, 1, 5, 0), "PA01H", "PM25"] == 99.0
    # A negative becomes 0, the left of two columns with one code wins, a bad cell is dropped.
    assert hourly[dt.datetime(2026, 1, 5, 3), "PA01H", "PM25"] == 0.0
    assert hourly[dt.datetime(2026, 1, 5, 3), "RD934", "PM25"] == 1.0
    assert (dt.datetime(2026, 1, 5, 1), "RD934", "PM25") not in hourly
    stations = {r.station_code: (r.station_name, r.station_type) for r in found.stations.collect()}
    assert stations == {
        "PA01H": ("Les Halles (old name)", "urban_background"),
        "RD934": ("RD934 Nord", "traffic"),
    }
    assert {r.pollutant_code: r.unit for r in found.pollutants.collect()} == {"PM25": "microg/m3", "NO2": "microg/m3"}
    first = found.pollutants.orderBy("first_column").first()
    assert first.pollutant_code == "PM25"
    assert [(r.file.rsplit("/", 1)[1], r.station_code) for r in found.empty_stations.collect()] == [("2026_PM25.csv", "VIDE")]
    daily = {(r.date, r.station_code): r.n_hours for r in found.daily.collect()}
    assert daily == {(day(2026, 1, 5), "PA01H"): 24, (day(2026, 1, 6), "PA01H"): 24}
    audit = found.audit.first()
    assert (audit.n_negative, audit.lowest_value, audit.n_duplicates) == (1, -2.5, 3)


def test_both_autumn_hours_on_request(spark, station_folder):
    found = measurements.load_measurements(spark, station_folder, dedup_on="utc")
    fold = found.hourly.filter(F.col("timestamp") == F.lit("2025-10-26 02:00:00").cast("timestamp_ntz"))
    assert sorted(r.value for r in fold.collect()) == [10.0, 20.0]
    with pytest.raises(ValueError):
        measurements.load_measurements(spark, station_folder, dedup_on="x")


def test_quoted_cells_stay_in_their_column(spark, tmp_path):
    lines = ['2024-01-01 01:00:00Z,"1,5",7,9', '"2024-01-01 02:00:00Z","2.5", 8 ,"a ""b"", c"']
    write(tmp_path / "2024_NO2.csv", wide_file(["A", "B", "C"], ["a", "b", "c"], "NO2", lines[:1] + ["2024-01-01 02:00:00Z," + lines[1].split(",", 1)[1]]))
    found = measurements.load_measurements(spark, str(tmp_path)).hourly.collect()
    assert sorted((r.timestamp.hour, r.station_code, r.value) for r in found) == [(1, "B", 7.0), (1, "C", 9.0), (2, "A", 2.5), (2, "B", 8.0)]


def test_header_rows_of_any_length(spark):
    line = ",".join(f'"name, {n} ""x"""' for n in range(10_000))
    row = spark.createDataFrame([(line,), ("a, b ,,",), ("",)], "line string").select(wide_csv.split_row(F.col("line")).alias("cells")).collect()
    assert len(row[0].cells) == 10_000 and row[0].cells[9_999] == 'name, 9999 "x"'
    assert row[1].cells == ["a", "b", "", ""] and row[2].cells == [""]


def test_impossible_times_stop_the_run(spark, tmp_path):
    for n in range(7):
        write(tmp_path / f"200{n}_NO2.csv", wide_file(["A"], ["a"], "NO2", ["2024-01-01 01:00:00Z,1", "2024-13-45 02:00:00Z,5"]))
    with pytest.raises(ValueError, match="^7 files without .* and 2 more$"):
        measurements.load_measurements(spark, str(tmp_path))


def test_another_layout_stops_the_run(spark, tmp_path):
    write(tmp_path / "2020_O3.csv", "a,b\n1,2\n" * 4)
    write(tmp_path / "2021_O3.csv", wide_file(["S"], ["s"], "O3", ["2021-01-01 01:00:00Z,1"]))
    with pytest.raises(ValueError, match="2020_O3.csv"):
        measurements.load_measurements(spark, str(tmp_path))
    layout = wide_csv.read_layout(wide_csv.read_lines(spark, str(tmp_path), wide_csv.STATION_FILE))
    report = {r.file.rsplit("/", 1)[1]: r.well_formed for r in wide_csv.header_report(layout).collect()}
    assert report == {"2020_O3.csv": False, "2021_O3.csv": True}


def test_segments(spark, station_folder):
    daily = measurements.load_segments(spark, station_folder)
    assert [tuple(r) for r in daily.collect()] == [(day(2024, 1, 1), "A-B", "NO2", 8.5, 18)]


def test_measurements_are_stored(spark, station_folder, tmp_path):
    out = str(tmp_path / "out")
    measurements.store_measurements(measurements.load_measurements(spark, station_folder), out)
    assert spark.read.parquet(f"{out}/stations").count() == 2
    daily = spark.read.parquet(f"{out}/daily_measurements")
    assert daily.columns == ["date", "station_code", "pollutant_code", "mean", "max", "n_hours"]
    audit = spark.read.parquet(f"{out}/audit").first()
    assert (audit.n_negative, audit.lowest_value, audit.n_duplicates) == (1, -2.5, 3)
    assert [r.station_code for r in spark.read.parquet(f"{out}/empty_stations").collect()] == ["VIDE"]


def test_raw_lines_are_scanned_once(spark, station_folder, monkeypatch):
    labels = []
    for module in (measurements, wide_csv):
        store = module.stored
        monkeypatch.setattr(module, "stored", lambda df, label, store=store: labels.append((label, scans(df))) or store(df, label))

    def scans(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("] text\n")

    found = measurements.load_measurements(spark, station_folder)
    assert labels == [("raw-pass", 1), ("layout", 0), ("columns", 0)]
    tables = [found.stations, found.pollutants, found.hourly, found.daily, found.empty_stations, found.audit]
    assert [scans(table) for table in tables] == [0] * 6
    plan = found.hourly._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_pass_keeps_what_is_no_number(spark):
    lines = [("f", 0, "x,a,b,c"), ("f", 1, '2024-01-01 01:00:00Z,1,"x, y", '), ("f", 2, "2024-13-01,7"), ("f", 3, "2024-01-01 02:00:00Z"), ("g", 9, "only a header")]
    df = spark.createDataFrame(lines, "file string, line_id bigint, line string")
    rows = {(r.pos, r.line_id, r.value, r.time is not None) for r in wide_csv.raw_rows(df).collect()}
    assert rows == {(-1, 0, None, False), (0, 1, None, True), (1, None, 1.0, True), (2, None, None, True), (0, 2, None, False), (0, 3, None, True), (-1, 9, None, False)}
    kept = wide_csv.store_pass(df)
    assert kept.counts == {"n_values": 1, "n_negative": 0, "lowest_value": 1.0}
    report = {r.file: r.well_formed for r in wide_csv.header_report(wide_csv.layout_of(kept.rows), 1).collect()}
    assert report == {"f": False, "g": False}
    nothing = wide_csv.store_pass(df.limit(0))
    assert nothing.rows.count() == 0 and nothing.counts == {"n_values": 0, "n_negative": 0, "lowest_value": None}


def test_indices(spark, tmp_path):
    write(tmp_path / "indices_2014.csv", "date,ninsee,no2,o3,pm10\n01/02/2014,0,1,2,3\n01/02/2014,0,9,9,9\n01/02/2014,75,4,,6\n")
    write(tmp_path / "Indices 2015.csv", "date,ninsee,o3,no2,pm10\n01/02/2015,75101,2,1,3\n")
    write(tmp_path / "other.csv", "date,ninsee,no2,o3,pm10\n01/02/2016,1,1,1,1\n")
    found = context.indices(tabular.read_indices(spark, str(tmp_path)))
    assert [tuple(r) for r in found.orderBy("date", "insee_code").collect()] == [
        (day(2014, 2, 1), 0, 1.0, 2.0, 3.0, "region"),
        (day(2014, 2, 1), 75, 4.0, None, 6.0, "department"),
        (day(2015, 2, 1), 75101, 1.0, 2.0, 3.0, "municipality"),
    ]


@pytest.fixture()
def small_splits(spark):
    sizes = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in sizes}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    yield
    for name, size in before.items():
        spark.conf.unset(name) if size is None else spark.conf.set(name, size)


def quoted_csv(rng, rows, end="\n"):
    """A CSV file whose cells hold line breaks, doubled quotes and delimiters, and its rows."""
    pieces = ["a", "é", ",", '""', "\n", "\n\n", " ", "word,", "id,x,y\n"]
    lines, expected = ["id,x,y"], []
    for n in range(rows):
        long = rng.random() < 0.05
        cells = ["".join(rng.choices(pieces, k=400 if long else rng.randint(0, 6))) for _ in range(2)]
        quoted = [f'"{c}"' if rng.random() < 0.5 or set(c) & set(',"\n') else c for c in cells]
        lines.append(",".join([str(n), *quoted]))
        if rng.random() < 0.1:
            lines.append("")
        expected.append((str(n), *[c.replace('""', '"') if len(q) > 2 and q.startswith('"') else c or None for c, q in zip(cells, quoted)]))
    return end.join(lines).replace("\n", end) + end, expected


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_quoted_file_is_read_by_several_tasks(spark, tmp_path, small_splits, end):
    rng = random.Random(end)
    expected = []
    for name in ("b.csv", "a.csv"):
        text, rows = quoted_csv(rng, 250, end)
        (tmp_path / name).write_bytes(("\ufeff" * (name == "a.csv") + text).encode())
        expected = rows + expected
    found = tabular.scan_csv(spark, str(tmp_path)).orderBy("_file", "_row")
    assert [tuple(r)[:3] for r in found.collect()] == expected
    reader = spark.read.schema("id string, x string, y string").option("header", True).option("escape", '"').option("multiLine", True)
    # Spark's own reader, one task a file, reads a break of two characters as two breaks.
    assert end != "\n" or sorted(map(str, reader.csv(str(tmp_path)).collect())) == sorted(map(str, found.drop("_file", "_row").collect()))
    lines = tabular.records.store_lines(tabular.records.raw_lines(spark, str(tmp_path))).rows
    blocks = {r.file: r.n for r in lines.groupBy("file").agg(F.count_distinct("block").alias("n")).collect()}
    assert len(blocks) == 2 and min(blocks.values()) > 4
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "] text" not in plan and "] csv" not in plan


def test_headers_are_read_without_a_file_list(spark, tmp_path):
    for n in range(40):
        write(tmp_path / f"{n:02d}.csv", ["k,v\n1,2\n", "v,k,z\n3,4,5\n6,7,8\n", "v;k\n"][n % 3])
    found = tabular.scan_csv(spark, str(tmp_path))
    assert found.columns[:2] == ["k", "v"] and found.filter("k = '4' AND v = '3' AND z = '5'").count() == 13
    assert found.filter("k = '1'").count() == 14 and found.select("_file").distinct().count() == 27
    write(tmp_path / "empty" / "e.csv", "")
    with pytest.raises(FileNotFoundError):
        tabular.scan_csv(spark, str(tmp_path / "empty"))


def test_alerts(spark, tmp_path):
    write(
        tmp_path / "alerts.csv",
        "date_ech,lib_pol,etat\n"
        "2019/01/20 23:00:00+00,Particules PM10,Information et recommandation\n"
        "2019/01/20 23:00:00+00,PM10,ALERTE\n"
        "2019/06/30 22:00:00+00,Ozone,Alerte\n"
        "2019/07/01 22:00:00+00,O3,Vigilance\n"
        "2019/07/01 22:00:00+00,SO2,Alerte\n",
    )
    known, unknown = context.alerts(tabular.read_alerts(spark, str(tmp_path)))
    assert known.schema == schemas.EPISODE_EVENT
    assert [tuple(r)[:6] for r in known.orderBy("date").collect()] == [
        (day(2019, 1, 21), "PM10", "information", "opendata_csv", "True", None),
        (day(2019, 7, 1), "O3", "alert", "opendata_csv", "True", None),
    ]
    assert unknown.count() == 2


@pytest.mark.parametrize("language", ["french", "english"])
def test_school_calendar(spark, tmp_path, language):
    if language == "french":
        header, sep = "Description;Population;Date de début;Date de fin;Académies", ";"
    else:
        header, sep = "description,population,start_date,end_date,location", ","
    lines = [
        ["Toussaint", "", "2023-10-20T22:00:00+00:00", "2023-10-22T22:00:00+00:00", "Paris"],
        ["Overlap", "Élèves", "2023-10-21T22:00:00+00:00", "2023-10-23T22:00:00+00:00", " Paris "],
        ["Teachers", "Enseignants", "2023-10-25T22:00:00+00:00", "2023-10-27T22:00:00+00:00", "Paris"],
        ["Empty", "-", "2023-10-28", "2023-10-28", "Paris"],
        ["Elsewhere", "-", "2023-10-28", "2023-10-30", "Lyon"],
    ]
    write(tmp_path / "school.csv", "\n".join([header, *[sep.join(line) for line in lines]]) + "\n", bom=True)
    periods = tabular.read_school_calendar(spark, str(tmp_path / "school.csv"))
    days = spark.sql("select explode(sequence(date'2023-10-20', date'2023-10-30')) as date")
    found = context.school_calendar(context.holiday_days(periods), days)
    named = {r.date.day: r.holiday_name for r in found.filter("is_school_holiday = 1").collect()}
    assert named == {21: "Toussaint", 22: "Toussaint", 23: "Overlap"}
    assert found.count() == 11
    with pytest.raises(KeyError):
        context.holiday_days(periods.drop("location", "academies"))


def test_weather(spark, tmp_path):
    write(
        tmp_path / "weather_2023.csv",
        "POSTE;DATE; TM;QTM;RR;QRR;TN\n07511400;20231231;5,5;1;0;1;-1,25\n07511400;20231231;9,9;1;0;1;0\n",
    )
    write(tmp_path / "weather_2024.csv", "POSTE;DATE;TM;QTM;DXY\n07511400;20240102;x;1;270\n")
    found = context.weather(tabular.read_weather(spark, str(tmp_path)))
    assert found.columns == schemas.WEATHER_DAY.names
    first, second = found.orderBy("date").collect()
    assert (first.date, first.temp_mean_c, first.temp_min_c, first.rain_mm) == (day(2023, 12, 31), 5.5, -1.25, 0.0)
    assert (first.wind_dir_deg, second.wind_dir_deg, second.temp_mean_c) == (None, 270.0, None)
    gaps, missing = context.weather_report(found)
    assert gaps.first().missing_days == 1
    assert {r.column: r.n_missing for r in missing.collect()}["temp_max_c"] == 2
    assert context.in_study_period(found, "2024-01-01", "2024-12-31").count() == 1


def test_holidays_and_optional_sources(spark, tmp_path):
    write(tmp_path / "h" / "2024.json", '{\n "2024-01-01": "1er janvier",\n "2024-05-01": "Fête, travail"\n}')
    write(tmp_path / "h" / "2025.json", '{"2025-01-01": "1er janvier"}')
    found = tabular.read_holidays(spark, str(tmp_path / "h"))
    assert [tuple(r) for r in found.orderBy("date").collect()] == [
        (day(2024, 1, 1), "1er janvier"),
        (day(2024, 5, 1), "Fête, travail"),
        (day(2025, 1, 1), "1er janvier"),
    ]
    empty, present = tabular.read_optional(spark, str(tmp_path / "none"), schemas.PUBLIC_HOLIDAYS)
    assert not present and empty.count() == 0 and empty.schema == schemas.PUBLIC_HOLIDAYS
    sinks.write_table(found, str(tmp_path / "some"))
    assert tabular.read_optional(spark, str(tmp_path / "some"), schemas.PUBLIC_HOLIDAYS)[1]


PAGE = """<table><tr><th>Niveau</th></tr>
<tr><td> Informations </td><td><b>PM</b>10</td><td>13/01/2026</td><td><img src="check.png"></td><td></td><td>d</td></tr>
<TR class="x"><TD>Alerte</TD><TD>O3</TD><TD> 14/01/2026 </TD><TD></TD><TD><IMG src='c'/></TD><TD>d</TD></TR>
<tr><td>Alerte</td><td>O3</td><td>soon</td><td></td><td></td><td></td></tr>
<tr><td>Alerte</td><td>NH3</td><td>15/01/2026</td><td></td><td></td><td></td></tr>
<tr><td>Alerte</td><td>O3</td><td>16/01/2026</td><td></td></tr></table>"""

REPORT = """Bilan
13/01/2024 PM10 Information OUI NON Fausse détection
14/01/2024 O3Information NON OUI Détection manquée
15/01/2024 PM
Alerte OUI OUI Bonne détection
16/01/2024 NO Information OUIOUI
17/01/2024 CO Information OUI OUI
"""


def test_pages_and_reports(spark):
    page = pages.episode_table_rows(spark.createDataFrame([(PAGE,)], "html string"))
    assert sorted(tuple(r) for r in page.collect()) == [
        ("13/01/2026", "PM10", "Informations", True, False, "html_page"),
        ("14/01/2026", "O3", "Alerte", False, True, "html_page"),
    ]
    report = pages.report_rows(spark.createDataFrame([(REPORT,)], "text string"))
    assert [tuple(r)[:6] for r in report.orderBy("date").collect()] == [
        ("13/01/2024", "PM10", "Information", True, False, "false_alarm"),
        ("14/01/2024", "O3", "Information", False, True, "missed_detection"),
        ("15/01/2024", "PM10", "Alerte", True, True, "correct_detection"),
        ("16/01/2024", "NO2", "Information", True, True, None),
    ]
    text = spark.createDataFrame([("14/01/2026 O3 Alerte NON OUI Détection manquée",)], "text string")
    scraped = context.scraped_episodes(page, report.union(pages.report_rows(text)))
    found = {(r.date, r.pollutant): r for r in scraped.collect()}
    assert scraped.columns == schemas.EPISODE_EVENT.names and len(found) == 6
    assert found[day(2026, 1, 14), "O3"].source == "pdf_report"
    html = found[day(2026, 1, 13), "PM10"]
    assert (html.level, html.observed, html.forecast, html.criterion_population) == ("information", "true", None, "true")
    opendata = spark.createDataFrame(
        [(day(2026, 1, 13), "PM10", "alert", "opendata_csv"), (day(2019, 1, 1), "PM10", "alert", "opendata_csv")],
        "date date, pollutant string, level string, source string",
    )
    merged = {(r.date, r.pollutant): r.source for r in context.merge_episodes(scraped, opendata).collect()}
    assert len(merged) == 7 and merged[day(2026, 1, 13), "PM10"] == "html_page"


@pytest.mark.parametrize("stretch", [5.0, 30.0, 1000.0])
def test_lines_from_characters(spark, stretch):
    def line(text, top, start=0.0):
        x, out = start, []
        for i, ch in enumerate(text):
            if ch == " ":
                x += 10
                continue
            out.append(("d", 1, ch, x, x + 5, top + (i % 2) * 0.4, i))
            x += 5.5
        return out

    characters = line("14/01/2024 O3", 10.1) + line("Information OUI", 20.1, 3.0) + [("d", 2, "z", 0.0, 1.0, 10.0, 0)]
    layout = "doc string, page int, text string, x0 double, x1 double, top double, seq int"
    df = spark.createDataFrame(characters[::-1], layout).repartition(3)
    lines = pages.rebuild_lines(df, ["doc", "page"], stretch=stretch)
    found = [r.text for r in lines.orderBy("page", "line").collect()]
    assert found == ["14/01/2024 O3", "Information OUI", "z"]
    whole = pages.document_text(lines, ["doc"], ["page", "line"])
    assert whole.first().text == "14/01/2024 O3\nInformation OUI\nz"


def test_sinks(spark, tmp_path):
    df = spark.range(300).select(
        (F.col("id") % 3 + 2022).cast("int").alias("year"),
        F.concat(F.lit("P"), F.col("id") % 2).alias("pollutant_code"),
        F.lit("S").alias("station_code"),
        "id",
    )
    path = str(tmp_path / "by_year")
    sinks.write_partitioned(df, path)
    stored = spark.read.parquet(path).filter("year = 2023")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and stored.count() == 100
    tables = {"station": df.limit(0).select(F.lit(1).alias("station_id"), F.lit("extra").alias("unlisted"))}
    sinks.write_star(tables, str(tmp_path / "star"))
    again = sinks.read_star(spark, str(tmp_path / "star"))
    assert list(again) == ["station"] and again["station"].columns == schemas.STATION.names
    report = sinks.reconcile({"a": df, "b": df}, {"a": df, "b": df.limit(5)}).orderBy("table").collect()
    assert [(r.n_source, r.n_stored, r.ok) for r in report] == [(300, 300, True), (300, 5, False)]
    sinks.write_table(df, str(tmp_path / "csv"), "csv", order=["id"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 300
    assert quality.row_counts({"a": df}).first().n_rows == 300


def test_a_heavy_year_is_dealt_over_tasks(spark, tmp_path):
    """Also where all its rows come from one task."""
    df = spark.range(4000, numPartitions=1).select(
        F.lit(2023).alias("year"), F.lit("A").alias("pollutant_code"), F.sha2(F.col("id").cast("string"), 256).alias("station_code"), "id"
    )
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {name: spark.conf.get(name) for name in sizes}
    try:
        for name, value in sizes.items():
            spark.conf.set(name, value)
        sinks.write_partitioned(df, str(tmp_path / "heavy"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    back = spark.read.parquet(str(tmp_path / "heavy"))
    files = back.groupBy(F.col("_metadata.file_name")).agg(F.count("*").alias("n"), F.min("station_code").alias("low"), F.max("station_code").alias("high"))
    files = files.orderBy("low").collect()
    assert sum(f.n for f in files) == 4000 and len(files) > 2 and max(f.n for f in files) < 2000
    assert all(a.high < b.low for a, b in zip(files, files[1:]))


def test_a_star_that_is_half_written_is_not_seen(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "star")

    def tables(n):
        return {name: spark.range(n).select(F.col("id").cast("int").alias(schemas.STAR[name].names[0])) for name in ("station", "pollutant", "episode")}

    def sizes(**options):
        return {name: df.count() for name, df in sinks.read_star(spark, folder, **options).items()}

    with pytest.raises(FileNotFoundError):
        sinks.read_star(spark, folder)
    assert sinks.write_star(tables(1), folder) == "000000000000"
    write = sinks.write_table
    written = []

    def stops(df, path, *rest, **options):
        if written:
            raise OSError("lost")
        written.append(write(df, path, *rest, **options))

    monkeypatch.setattr(sinks, "write_table", stops)
    with pytest.raises(OSError):
        sinks.write_star(tables(2), folder)
    monkeypatch.setattr(sinks, "write_table", write)
    assert len(written) == 1 and sizes() == dict.fromkeys(("station", "pollutant", "episode"), 1)
    before = sinks.read_star(spark, folder)["station"]
    sinks.write_star(tables(3), folder)
    assert set(sizes().values()) == {3} and set(sizes(version="000000000000").values()) == {1}
    assert before.count() == 1  # a reader that began before goes on with its version
    sinks.write_star(tables(4), folder)
    assert sinks.versions(spark, folder) == ["000000000001", "000000000002"] and set(sizes().values()) == {4}
    # Another writer took the number in between.
    monkeypatch.setattr(sinks, "versions", lambda *_: ["000000000001"])
    with pytest.raises(FileExistsError):
        sinks.write_star(tables(5), folder)
