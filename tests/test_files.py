"""Raw files on disk: readers, jobs and the stream."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.operators import tables as upkeep
from gaugeworks.plans import backfill, gapfill, update
from gaugeworks.sources import observations, stations, tables
from gaugeworks.streaming.updates import stream_updates

OLD = ('"Longitude (x)","Latitude (y)","Station Name","Climate ID","Date/Time","Year","Month","Day","Data Quality",'
       '"Max Temp (°C)","Total Precip (mm)","Total Precip Flag","Spd of Max Gust (km/h)","Spd of Max Gust Flag"')
NEW = '"Date/Time","Climate ID","Total Precip (mm)","Station Name","Extra Column","Spd of Max Gust (km/h)"'
HOURLY = '"Climate ID","Date/Time (LST)","Year","Month","Day","Time (LST)","Temp (°C)","Wind Spd (km/h)","Weather"'


def put(path, *lines, end="\r\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(end.join(lines) + end, encoding="utf-8")


@pytest.fixture
def tree(tmp_path):
    raw = tmp_path / "raw"
    put(raw / "51/daily/en_climate_daily_BC_C51_1999_P1D.csv", "﻿" + OLD,
        '"-123.1","49.2","BAY, ""NORTH""","C51","1999-12-30","1999","12","30","","5.5","1.5","M","<31","E"',
        '"-123.1","49.2","BAY, ""NORTH""","C51","1999-12-31","1999","12","31","","","","","","NA"')
    put(raw / "51/daily/en_climate_daily_BC_C51_2000_P1D.csv", NEW,
        '"2000-01-01","C51","3.25","BAY, ""NORTH""","?","12.5"', "", '"2000-01-02","C51","NA","BAY, ""NORTH""","?","M"')
    put(raw / "77/daily/en_climate_daily_BC_C77_2000_P1D.csv", NEW, '2000-01-01,C77,8,HILL,?,45', end="\n")
    put(raw / "77/hourly/en_climate_hourly_BC_C77_01-2000_P1H.csv", HOURLY,
        '"C77","2000-01-01 00:00","2000","1","1","00:00","-1.5","7","Rain,Fog"',
        '"C77","2000-01-01 13:00","2000","1","1","13:00","","<8","NA"')
    (raw / "90/daily").mkdir(parents=True)
    return str(raw)


def by_key(rows):
    return {(r.ec_station_id, str(r.datetime)): r for r in rows}


def test_daily_tree(spark, tree):
    df = observations.read_observation_tree(spark, tree, "daily")
    assert df.schema.names == schemas.observation_schema("daily").names
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.observation_schema("daily")]
    got = by_key(df.collect())
    assert set(got) == {("51", "1999-12-30"), ("51", "1999-12-31"), ("51", "2000-01-01"), ("51", "2000-01-02"), ("77", "2000-01-01")}
    first = got["51", "1999-12-30"]
    assert (first.station_name, first.climate_id, first.longitude, first.max_temp) == ('BAY, "NORTH"', "C51", -123.1, 5.5)
    assert (first.total_precip, first.total_precip_flag, first.spd_of_max_gust, first.spd_of_max_gust_flag) == (1.5, "M", 31.0, "E")
    assert (first.year, first.month, first.day, first.data_quality, first.snow_on_grnd) == (1999, 12, 30, None, None)
    blank = got["51", "1999-12-31"]
    assert (blank.total_precip, blank.spd_of_max_gust, blank.spd_of_max_gust_flag) == (None, None, None)
    assert got["51", "2000-01-01"].spd_of_max_gust == 12.5 and got["51", "2000-01-02"].spd_of_max_gust is None
    assert (got["77", "2000-01-01"].total_precip, got["77", "2000-01-01"].spd_of_max_gust) == (8.0, 45.0)


def test_strict_speed(spark, tree):
    got = by_key(observations.read_observation_tree(spark, tree, "daily", keep_point=False).collect())
    assert got["51", "2000-01-01"].spd_of_max_gust == 125.0
    assert got["51", "1999-12-30"].spd_of_max_gust_flag == ""


def test_hourly_tree(spark, tree):
    got = by_key(observations.read_observation_tree(spark, tree, "hourly").collect())
    a, b = got["77", "2000-01-01 00:00:00"], got["77", "2000-01-01 13:00:00"]
    assert (a.time, a.temp, a.wind_spd, a.weather, a.precip_amount) == ("00:00", -1.5, 7.0, "Rain,Fog", None)
    assert (b.time, b.temp, b.wind_spd, b.weather) == ("13:00", None, 8.0, None)


def test_delivered_files(spark, tree, tmp_path):
    put(tmp_path / "raw/77/monthly/en_climate_monthly_BC_C77_1990-2000_P1M.csv", "x")
    rows = {tuple(r) for r in observations.delivered_files(spark, tree).collect()}
    assert rows == {("51", "daily", 1999, None), ("51", "daily", 2000, None), ("77", "daily", 2000, None),
                    ("77", "hourly", 2000, 1), ("77", "monthly", None, None)}


def test_no_files_of_a_kind(spark, tmp_path):
    put(tmp_path / "raw/77/daily/x_2000_P1D.csv", NEW, "2000-01-01,C77,8,HILL,?,45")
    assert observations.read_observation_tree(spark, str(tmp_path / "raw"), "hourly").count() == 0
    assert observations.read_observation_tree(spark, str(tmp_path / "raw"), "daily").count() == 1


LISTING = ['Modified Date: 2023-01-01', '', '"Station Inventory, and a note"',
           '"Name","Province","Climate ID","Station ID","WMO ID","TC ID","Latitude (Decimal Degrees)",'
           '"Longitude (Decimal Degrees)","Latitude","Longitude","Elevation (m)","First Year","Last Year",'
           '"HLY First Year","HLY Last Year","DLY First Year","DLY Last Year","MLY First Year","MLY Last Year"',
           '"BAY, NORTH","BRITISH COLUMBIA","C51","51","","","49.2","-123.1","491200000","-1230600000","4","1990","2001","","","1990","2001","1990","2000"',
           '"HILL","ALBERTA","C77","77","71123","YXX","51","-114","510000000","-1140000000","","1995","2005","1995","2005","1995","2005","",""',
           '"PEAK","BRITISH COLUMBIA","C90","90","","","50","-120","500000000","-1200000000","1200","1995","2005","","","1995","2005","",""']


@pytest.mark.parametrize("skip", [0, 3, 4], ids=["preamble", "header only", "bare"])
def test_station_list(spark, tmp_path, skip):
    put(tmp_path / "list.csv", *LISTING[skip:])
    df = stations.read_station_list(spark, str(tmp_path / "list.csv"))
    assert df.schema == schemas.STATION_SCHEMA
    rows = {r.station_id: r for r in df.collect()}
    assert set(rows) == {"51", "77", "90"}
    assert (rows["51"].name, rows["51"].latitude_dd, rows["51"].hly_first_year, rows["51"].tc_id) == ("BAY, NORTH", 49.2, None, None)
    assert rows["77"].tc_id == "YXX" and rows["77"].elevation_m is None
    known = schemas.provinces(spark)
    assert {r.station_id for r in stations.in_province(df, known, "BC").collect()} == {"51", "90"}
    assert {r.code for r in stations.with_province_code(df, known).collect()} == {"AB", "BC"}
    assert schemas.provinces(spark, "fr").where("code = 'BC'").first().province == "COLOMBIE-BRITANNIQUE"


def test_jobs_from_files_to_filled_records(spark, tree, tmp_path):
    out, listing = str(tmp_path / "out"), tmp_path / "list.csv"
    put(listing, *LISTING)
    backfill.write_station_tables(spark, str(listing), out)
    backfill.backfill(spark, tree, out, "1999-12")
    daily = lambda: tables.read_observations(spark, f"{out}/daily", "daily")
    assert daily().count() == 2
    assert "BRITISH COLUMBIA" in {r.province for r in backfill.read_station_table(spark, out).collect()}
    assert backfill.read_station_table(spark, out, "ALBERTA").count() == 1

    first = update.update(spark, tree, out, dt.date(2000, 1, 2), str(listing))
    assert [(r["table"], r["batch_rows"], r["inserted_rows"]) for r in first] == [("daily", 4, 2), ("hourly", 2, 2)]
    again = update.update(spark, tree, out, dt.date(2000, 1, 2))
    assert [r["inserted_rows"] for r in again] == [0, 0]
    last = {r.table: r for r in upkeep.last_update(spark, f"{out}/update_log").collect()}
    assert last["daily"].inserted_rows == 0 and last["daily"].min_dt == "1999-12-30"

    # The day after tomorrow's rows become old enough, and only they are added.
    later = update.update(spark, tree, out, dt.date(2000, 2, 1), kinds=("daily",))
    assert later[0]["inserted_rows"] == 1 and daily().count() == 5
    recent = update.update(spark, tree, out, dt.date(2000, 2, 9), kinds=("daily",), days_back=31)
    assert (recent[0]["batch_rows"], recent[0]["inserted_rows"]) == (3, 0)

    gapfill.rebuild_representative_years(spark, out)
    gapfill.rebuild_pairwise_weights(spark, out)
    weights = spark.read.parquet(f"{out}/precip_pairwise_weights")
    assert {(r.active_station, r.station_id) for r in weights.collect()} == {("51", "77"), ("77", "51")}
    for stored in (False, True):
        filled = gapfill.fill(spark, out, stored_weights=stored)
        assert filled.count() == 5
        assert {r.precip_intp_flag for r in filled.collect()} == {"recorded", "interpolated"}


def test_update_keeps_years_and_weights_up(spark, tree, tmp_path):
    out, listing = str(tmp_path / "out"), tmp_path / "list.csv"
    put(listing, *LISTING)
    backfill.write_station_tables(spark, str(listing), out)
    backfill.backfill(spark, tree, out, "1999-12", ["daily"])
    gapfill.rebuild_representative_years(spark, out)
    gapfill.rebuild_pairwise_weights(spark, out)
    read = lambda: (spark.read.parquet(f"{out}/{gapfill.YEAR}"), gapfill.stored_weights_of(spark, out))
    stored = lambda: [sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in df.collect()) for df in read()]
    before = stored()
    facts, = update.update(spark, tree, out, dt.date(2000, 2, 1), kinds=("daily",), weights=True)
    kept = stored()
    assert facts["inserted_rows"] == 3 and kept[0] != before[0]
    assert update.update(spark, tree, out, dt.date(2000, 2, 1), kinds=("daily",), years=True)[0]["inserted_rows"] == 0 and stored() == kept
    gapfill.rebuild_representative_years(spark, out)
    gapfill.rebuild_pairwise_weights(spark, out)
    assert stored() == kept


def test_stream_inserts_each_file_once(spark, tree, tmp_path):
    out, place = str(tmp_path / "out"), str(tmp_path / "progress")
    tables.create_table(spark, f"{out}/daily", "daily")
    run = lambda: stream_updates(
        spark, tree, out, "daily", place, as_of=lambda: dt.date(2001, 1, 1), once=True).awaitTermination(120)
    run()
    stored = lambda: tables.read_observations(spark, f"{out}/daily", "daily")
    assert stored().count() == 5
    run()
    assert stored().count() == 5
    put(tmp_path / "raw/77/daily/en_climate_daily_BC_C77_1999_P1D.csv", NEW,
        "1999-01-01,C77,1,HILL,?,45", "1999-01-02,C77,2,HILL,?,45")
    run()
    assert stored().count() == 7
    assert stored().where("ec_station_id = '77'").agg({"total_precip": "sum"}).first()[0] == 11.0
    log = spark.read.parquet(f"{out}/update_log")
    facts = dict(log.where("run_id like '%#0'").first().asDict(), inserted_rows=99)
    upkeep.append_update_log(spark, f"{out}/update_log", facts, dt.datetime(2001, 1, 1), facts["run_id"])
    assert spark.read.parquet(f"{out}/update_log").where("inserted_rows = 99").count() == 0


def test_command_line(spark, tree, tmp_path):
    from gaugeworks.__main__ import arguments, run

    out, listing = str(tmp_path / "out"), tmp_path / "list.csv"
    put(listing, *LISTING)
    common = ["--raw", tree, "--out", out, "--stations", str(listing)]
    run(spark, arguments(["backfill", *common, "--maxdate", "2001-01"]))
    run(spark, arguments(["update", *common]))
    run(spark, arguments(["weights", "--out", out]))
    run(spark, arguments(["fill", "--out", out, "--to", f"{out}/filled", "--station", "51", "--start", "2000-01-01"]))
    assert spark.read.parquet(f"{out}/filled").count() == 2
    run(spark, arguments(["weights", "--out", out, "--active-since", "2005"]))
    assert {r.active_station for r in spark.read.parquet(f"{out}/precip_pairwise_weights").collect()} == {"77"}
    run(spark, arguments(["buckets", "--out", out, "--to", f"{out}/buckets", "--step", "1"]))
    assert spark.read.option("header", True).csv(f"{out}/buckets/daily").count() == 5
    with pytest.raises(SystemExit):
        arguments(["gaps", *common])
    run(spark, arguments(["gaps", *common, "BC", "--kind", "daily", "--start", "1999", "--to", f"{out}/gaps"]))
    gaps = spark.read.option("header", True).csv(f"{out}/gaps").collect()
    assert {(r.station_id, r.year) for r in gaps} == {("51", "2001"), *(("90", str(y)) for y in range(1999, 2006))}


def test_headers_lines_and_cells(spark, tmp_path):
    """Preamble, CR line ends, another spelling of the date column, and a cell with the header's text."""
    raw = tmp_path / "raw"
    put(raw / "1/daily/a_2001_P1D.csv", "some preamble, date/time of download", "", '"Date/Time","Total Precip (mm)"', '"2001-01-01","1"', end="\r")
    put(raw / "2/daily/a_2001_P1D.csv", '"DATE/TIME","Total Precip (mm)","Station Name"', '"2001/1/2","2","Date/Time"', '"20010103","3","at date/time"', end="\n")
    put(raw / "3/daily/a_2001_P1D.csv", "no header at all", "2001-01-01,1")
    got = observations.read_observation_tree(spark, str(raw), "daily").select("ec_station_id", "datetime", "total_precip", "station_name")
    assert sorted((r[0], str(r[1]), r[2], r[3]) for r in got.collect()) == [
        ("1", "2001-01-01", 1.0, None), ("2", "2001-01-02", 2.0, "Date/Time"), ("2", "2001-01-03", 3.0, "at date/time")]
    bad = observations.files_without_header(observations.whole_files(spark, str(raw), "daily")).collect()
    assert [r.path.rsplit("/", 3)[1] for r in bad] == ["3"]


def test_files_of_a_window(spark, tree):
    got = observations.read_observation_tree(spark, tree, "daily", first="2000-01").collect()
    assert {str(r.datetime)[:4] for r in got} == {"2000"}
    assert observations.read_observation_tree(spark, tree, "hourly", first="2000-02").count() == 0
    assert observations.read_observation_tree(spark, tree, "hourly", last="2000-01").count() == 2


def test_wide_files_and_quoted_commas(spark):
    """A header of ninety fields, names with commas and doubled quotes, and a file without a header beside it."""
    extra = [f'"Extra, no. ""{i}"""' for i in range(88)]
    wide = ",".join([*extra[:70], '"Date/Time"', *extra[70:], '"Total Precip (mm)"'])
    data = ",".join([*(['"1,5 ""x"""'] * 70), "2001-02-03", *([""] * 18), '"7.5"'])
    files = spark.createDataFrame([("/r/1/daily/a_2001_P1D.csv", f"about date/time, below\n{wide}\n{data}\n"), ("/r/2/daily/b_2001_P1D.csv", "no header\n1,2")], "path string, content string")
    row, = observations.parse_files(files, "daily").collect()
    assert (row.ec_station_id, str(row.datetime), row.total_precip) == ("1", "2001-02-03", 7.5)
    assert [r.path for r in observations.files_without_header(files).collect()] == ["/r/2/daily/b_2001_P1D.csv"]


@pytest.mark.parametrize("line, fields", [
    ("", [""]), (",", ["", ""]), ("a,b", ["a", "b"]), ('"a,b",c', ["a,b", "c"]), ('"",""', ["", ""]), ('"say ""hi""",x', ['say "hi"', "x"]),
    ('"""",y', ['"', "y"]), (',"a"', ["", "a"]), ('a"b,c', ['a"b', "c"]), ('"open,c', ['"open', "c"]), ('x,"' + "q" * 100_000 + '"', ["x", "q" * 100_000])])
def test_csv_fields(spark, line, fields):
    from gaugeworks.functions import text

    assert spark.createDataFrame([(line,)], "line string").select(text.csv_fields(F.col("line"))).first()[0] == fields


def test_a_tree_that_is_read_for_one_kind_has_files_of_that_kind(spark, sf, tmp_path, monkeypatch):
    from gaugeworks.catalogue import queries

    monkeypatch.setattr(queries, "scratch_folder", lambda _: str(tmp_path / "scratch"))
    for kind in ("daily", "hourly"):
        queries.QUERIES[f"ingest_tree_{kind}"](spark, sf)
        made = {p.parent.name for p in (tmp_path / "scratch").rglob("*.csv")}
        assert made == {kind}
        shutil.rmtree(tmp_path / "scratch")


def test_small_files_share_tasks(spark, tmp_path):
    root = tmp_path / "many"
    for station in range(100):
        for year in range(2000, 2006):
            put(root / str(station) / "daily" / f"x_{year}_P1D.csv", NEW)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "77")  # any setting of the caller's
    try:
        files, names = observations.whole_files(spark, str(root), "daily"), observations.delivered_files(spark, str(root))
        assert files.sparkSession.conf.get("spark.sql.files.maxRecordsPerFile") == "77"
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert files.count() == names.count() == 600
    assert files.rdd.getNumPartitions() <= 16
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(observations.OPEN_COST)


def test_whole_files_come_as_bytes_and_stations_below_one_listing(spark, tmp_path):
    """Files are read byte by byte, not by the reader of text, and only names of stations are matched on the driver."""
    root = tmp_path / "raw"
    for place, text in (("1/daily/en_C1_1999_P1D.csv", "\ufeffa\rb\r\n"), ("_2/daily/x y_1999_P1D.csv", "x"), ("1/daily/deeper/en_C1_2000_P1D.csv", "no"),
                        ("3/hourly/en_01-2000_P1H.csv", "h"), ("3/other/z.csv", "no"), ("top.csv", "no"), ("3/daily.txt", "no")):
        (root / place).parent.mkdir(parents=True, exist_ok=True)
        (root / place).write_bytes(text.encode())
    found = observations.whole_files(spark, str(root), "daily")
    assert {(r.path.rsplit("/", 1)[1], r.content) for r in found.collect()} == {("en_C1_1999_P1D.csv", "\ufeffa\rb\r\n"), ("x%20y_1999_P1D.csv", "x")}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "binaryFile" in plan
    listed = observations.delivered_files(spark, f"{root}/")
    assert {tuple(r) for r in listed.collect()} == {("1", "daily", 1999, None), ("_2", "daily", 1999, None), ("3", "hourly", 2000, 1)}
    assert "(4 paths)" in listed._jdf.queryExecution().sparkPlan().toString()  # what lies below root, not each station's directories
    assert observations.read_observation_tree(spark, str(tmp_path / "none"), "daily").isEmpty()
