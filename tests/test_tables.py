"""Upkeep of stored tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import tables as upkeep
from gaugeworks.operators.union import union_by_name
from gaugeworks.sources import tables

ROW = "climate_id string, datetime date, v int"
D = dt.date


def keys(df):
    return sorted(((r.climate_id, r.datetime) for r in df.collect()), key=str)


def test_insert_only_new_keys_and_null_keys_match(spark):
    stored = spark.createDataFrame([("a", D(2000, 1, 1), 1), ("b", None, 2)], ROW)
    batch = spark.createDataFrame(
        [("a", D(2000, 1, 1), 9), ("b", None, 9), ("a", D(2000, 1, 2), 5), ("a", D(2000, 1, 2), 4), (None, D(2000, 1, 1), 7)], ROW)
    new = upkeep.rows_to_insert(batch, stored)
    assert keys(new) == sorted([("a", D(2000, 1, 2)), (None, D(2000, 1, 1))], key=str)
    assert new.where("climate_id = 'a'").first().v == 4
    assert upkeep.rows_to_insert(batch, stored, dedupe=False).count() == 3
    assert upkeep.rows_to_insert(batch, stored.unionByName(new)).count() == 0


def test_before_drops_today_and_undated(spark):
    df = spark.createDataFrame([("a", D(2000, 1, 1), 1), ("a", D(2000, 1, 2), 1), ("a", None, 1)], ROW)
    assert keys(upkeep.before(df, D(2000, 1, 2))) == [("a", D(2000, 1, 1))]


def test_batch_range(spark):
    stored = spark.createDataFrame([("a", D(1999, 1, 1), 1), ("a", D(2000, 1, 1), 1), ("a", D(2001, 1, 1), 1)], ROW)
    batch = stored.where("datetime >= '2000-01-01'").where("datetime < '2001-01-01'")
    assert keys(upkeep.in_batch_range(stored, batch)) == [("a", D(2000, 1, 1))]
    assert upkeep.in_batch_range(stored, batch.where("false")).count() == 0


def test_insert_creates_a_missing_table_and_counts(spark, tmp_path):
    path = str(tmp_path / "daily")
    rows = [("C1", "1", D(2000, 1, 1)), ("C1", "1", D(2000, 1, 1)), ("C1", "1", D(2001, 1, 1)), ("C1", "1", None)]
    batch = spark.createDataFrame(rows, "climate_id string, ec_station_id string, datetime date")
    facts = upkeep.incremental_insert(batch, path, "daily", D(2001, 1, 1))
    assert facts == {"table": "daily", "batch_rows": 2, "inserted_rows": 1, "min_dt": "2000-01-01", "max_dt": "2000-01-01"}
    assert upkeep.incremental_insert(batch, path, "daily", D(2001, 1, 2))["inserted_rows"] == 1
    empty = upkeep.incremental_insert(batch.where("false"), path, "daily", D(2001, 1, 2))
    assert (empty["batch_rows"], empty["inserted_rows"], empty["min_dt"]) == (0, 0, None)
    assert tables.read_observations(spark, path, "daily").count() == 2


@pytest.mark.parametrize("start, end, n", [(None, None, 3), ("2000-01-01", None, 2), (None, "2000-01-01", 2), ("2000-01-01", "2000-01-01", 1)])
def test_range_scan(spark, start, end, n):
    df = spark.createDataFrame([("a", D(1999, 12, 31), 1), ("a", D(2000, 1, 1), 1), ("a", D(2001, 1, 1), 1)], ROW)
    assert tables.range_scan(df, "datetime", start, end).count() == n


def test_range_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "daily")
    tables.create_table(spark, path, "daily")
    assert tables.read_observations(spark, path, "daily").count() == 0
    empty = tables.read_observations(spark, path, "daily").drop(tables.PARTITION)
    rows = spark.createDataFrame([("C1", D(y, 7, 1)) for y in (1999, 2000, 2001)] + [("C1", None)], "climate_id string, datetime date")
    tables.write_observations(union_by_name(empty, rows), path)
    scan = tables.range_scan(tables.read_observations(spark, path, "daily"), "datetime", "2000-01-01", "2000-12-31")
    assert scan.count() == 1
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"({tables.PARTITION}" in plan.split("PartitionFilters")[1][:300]


def test_truncation_keeps_undated_rows(spark):
    df = spark.createDataFrame([("a", D(2000, 2, 29), 1), ("a", D(2000, 3, 1), 1), ("a", None, 1)], ROW)
    assert upkeep.truncate_daily(df, "2000-02").count() == 2
    assert upkeep.truncate_daily(df, D(2000, 2, 28)).count() == 1
    hours = spark.createDataFrame([(1999, 12), (2000, 2), (2000, 3), (2001, 1), (None, 5)], "year int, month int")
    assert sorted(map(tuple, upkeep.truncate_hourly(hours, "2000-02").collect()), key=str) == [(1999, 12), (2000, 2), (None, 5)]
    strict = {tuple(r) for r in upkeep.truncate_hourly(hours, "2000-02", strict=True).collect()}
    assert strict == {(1999, 12), (2000, 2), (2001, 1), (None, 5)}


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "archive")
    df = spark.createDataFrame([(1,)], "v int")
    dropped = [upkeep.archive_snapshot(df, path, f"2023-01-0{d}") for d in range(1, 7)]
    assert dropped == [[], [], [], [], ["2023-01-01"], ["2023-01-02"]]
    kept = spark.read.parquet(path)
    assert kept.select("snapshot_date").distinct().count() == 4
    newest = upkeep.keep_newest(kept, "snapshot_date", 3).select("snapshot_date").distinct().collect()
    assert {str(r[0]) for r in newest} == {"2023-01-04", "2023-01-05", "2023-01-06"}


def test_year_bucket_files(spark, tmp_path):
    df = spark.createDataFrame([(y,) for y in range(1990, 2023)], "year int")
    upkeep.write_year_buckets(df, str(tmp_path / "b"), 10)
    back = spark.read.option("header", True).csv(str(tmp_path / "b"))
    assert {(r.bucket, r.n) for r in back.groupBy("bucket").agg(F.count("*").alias("n")).collect()} == {
        ("2012-2022", 11), ("2002-2012", 10), ("1990-2002", 12)}
    assert upkeep.with_year_bucket(df.where("false"), 10).count() == 0


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "z int, x int")
    assert {(r.x, r.y, r.z) for r in union_by_name(a, b).collect()} == {(1, 2, None), (4 if False else 4, None, 3)}


def test_stored_keys_that_a_batch_lacks_are_not_shuffled(spark, tmp_path, monkeypatch):
    """What is compared grows with the batch; keys without an id, and days given as times, are found all the same."""
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    stored = spark.createDataFrame([(f"C{k}", day(n)) for k in range(40) for n in range(100)] + [(None, day(3))], "climate_id string, datetime date")
    batch = spark.createDataFrame([("C1", day(0)), ("C1", day(700)), ("x", day(99)), (None, day(3)), (None, day(4))], stored.schema)
    kept = {tuple(r) for r in upkeep.maybe_in_batch(stored, batch).collect()}
    assert {("C1", day(0)), (None, day(3))} <= kept and len(kept) < 10
    times = batch.withColumn("datetime", F.col("datetime").cast("timestamp"))
    assert {("C1", day(0)), (None, day(3))} <= {tuple(r) for r in upkeep.maybe_in_batch(stored, times).collect()}
    compared = []
    real = upkeep.rows_to_insert
    monkeypatch.setattr(upkeep, "rows_to_insert", lambda batch, stored, **k: compared.append(stored.count()) or real(batch, stored, **k))
    upkeep.incremental_insert(stored.withColumn("total_precip", F.lit(1.0)), f"{tmp_path}/daily", "daily", "2100-01-01")
    facts = upkeep.incremental_insert(batch.withColumn("total_precip", F.lit(1.0)), f"{tmp_path}/daily", "daily", "2100-01-01")
    assert facts["inserted_rows"] == 3 and compared[0] == 0 and compared[1] < 10
