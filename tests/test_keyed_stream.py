"""The stream that remembers keys in its state."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.operators import tables as upkeep
from gaugeworks.sources import tables
from gaugeworks.streaming import keyed
from gaugeworks.streaming.keyed import insert_keyed_stream


def day(n, climate="C1", station="1", precip=1.0):
    return {"climate_id": climate, "ec_station_id": station, "datetime": n and dt.date(2000, 12, 28) + dt.timedelta(days=n), "total_precip": precip}


@pytest.fixture
def job(spark, tmp_path):
    """Functions that deliver rows as one file, run the stream until all are read, and list what is stored."""
    schema, out = schemas.observation_schema("daily"), str(tmp_path / "out")
    delivered = []

    def deliver(*rows):
        values = [tuple(r.get(f.name) for f in schema) for r in rows]
        delivered.append(f"{tmp_path}/arriving/{len(delivered):03d}")
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(delivered[-1])

    def run(as_of="2001-06-01"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/arriving")
        insert_keyed_stream(stream, out, "daily", str(tmp_path / "progress"), as_of, once=True).awaitTermination(120)

    def stored():
        found = tables.read_observations(spark, f"{out}/daily", "daily")
        assert found.where("obs_year <> year(datetime)").isEmpty()
        return sorted(((r.climate_id, r.ec_station_id, r.datetime.isoformat()[2:], r.total_precip) for r in found.collect()), key=repr)

    return deliver, run, stored, out, tmp_path / "progress"


def test_only_the_first_batch_of_a_start_is_compared_with_stored_rows(spark, job, monkeypatch):
    deliver, run, stored, out, _ = job
    compared = []
    real = upkeep.rows_to_insert
    monkeypatch.setattr(upkeep, "rows_to_insert", lambda *a, **k: compared.append(1) or real(*a, **k))
    schema = schemas.observation_schema("daily")
    before = spark.createDataFrame([tuple(day(n, precip=0.0).get(f.name) for f in schema) for n in (1, 9)], schema)
    upkeep.incremental_insert(before, f"{out}/daily", "daily", "2001-06-01")
    compared.clear()
    deliver(day(1), day(2), day(2, precip=0.5), day(4, "C2", "2"))
    deliver(day(2, precip=9.0), day(3), day(9), day(4, "C2", "2", precip=9.0))  # day 9 is known from the first state alone
    deliver(day(-300), day(1, "C3", "3"))  # late data
    run()
    assert len(compared) == 1
    want = [("C1", "1", "00-03-03", 1.0), ("C1", "1", "00-12-29", 0.0), ("C1", "1", "00-12-30", 0.5), ("C1", "1", "00-12-31", 1.0),
            ("C1", "1", "01-01-06", 0.0), ("C2", "2", "01-01-01", 1.0), ("C3", "3", "00-12-29", 1.0)]
    assert stored() == sorted(want)
    run()  # nothing new
    deliver(day(1), day(9), day(-300), day(5))
    run()
    assert stored() == sorted([*want, ("C1", "1", "01-01-02", 1.0)])
    log = spark.read.parquet(f"{out}/update_log")
    assert sorted(r.inserted_rows for r in log.collect()) == [1, 1, 2, 2] and log.select("run_id").distinct().count() == 4


def test_a_batch_that_runs_again_adds_nothing(job):
    deliver, run, stored, _, progress = job
    deliver(day(1), day(2))
    deliver(day(3), day(2))
    run()
    (progress / "commits" / "1").unlink()  # as if the stream had failed after it had written
    (progress / "commits" / ".1.crc").unlink(missing_ok=True)
    once = stored()
    deliver(day(3), day(4))
    run()
    assert stored() == [*once, ("C1", "1", "01-01-01", 1.0)] and len(once) == 3


def test_days_to_come_undated_rows_and_rows_without_an_id(job):
    deliver, run, stored, _, _ = job
    deliver(day(1, None, "1"), day(1, None, "2"), day(None), day(3))
    deliver(day(1, None, "3"), day(2, None, "1"))
    run(as_of="2000-12-31")
    # Stations without an id keep theirs within one batch; afterwards a stored row without one counts as present.
    want = [(None, "1", "00-12-29", 1.0), (None, "1", "00-12-30", 1.0), (None, "2", "00-12-29", 1.0)]
    assert stored() == want
    deliver(day(3))
    run(as_of="2001-06-01")  # a day that was yet to come is not remembered
    assert stored() == sorted([*want, ("C1", "1", "00-12-31", 1.0)], key=repr)


def test_hours(spark, tmp_path):
    schema, out = schemas.observation_schema("hourly"), str(tmp_path / "out")
    for k, hours in enumerate([(1, 2, 800), (2, 3, 800)]):
        rows = [tuple({"climate_id": "C", "ec_station_id": "1", "datetime": dt.datetime(2000, 1, 1) + dt.timedelta(hours=h)}.get(f.name) for f in schema)
                for h in hours]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/arriving/{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/arriving")
    insert_keyed_stream(stream, out, "hourly", str(tmp_path / "progress"), once=True).awaitTermination(120)
    found = tables.read_observations(spark, f"{out}/hourly", "hourly")
    assert found.count() == found.select("datetime").distinct().count() == 4
    assert {r.datetime.hour for r in found.collect()} == {1, 2, 3, 8}
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_groups_do_not_grow_with_the_stations(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("C"), (F.col("id") % 4000).cast("string")).alias("climate_id"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("datetime"))
    groups = keyed._keyed(rows, "daily").select("bucket_", "span_").distinct().count()
    assert groups <= 256
    undated = rows.withColumn("climate_id", F.lit(None).cast("string"))
    assert keyed._keyed(undated, "daily").select("bucket_", "span_").distinct().count() > 1  # days of those without an id are spread


class _State:
    """One group's value, in place of the store."""

    def __init__(self):
        self.value = None

    def getValueState(self, *_):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_one_state_tells_stations_and_days_apart():
    unseen, passed = keyed.Unseen(["v"]), []
    unseen.init(_State())
    unseen.handleInitialState(None, pd.DataFrame({"who_": ["=a", ""], "stored_": [[3, 1], [5]]}), None)
    for who, at in ((["=a", "=b", "=b", "", "="], [1, 1, 1, 5, 5]), (["=b", "=a", "=c", ""], [1, 2, 2, 6]), (["=c", "=a", "=", "=b"], [2, 3, 5, 1 << 41])):
        rows = pd.DataFrame({"who_": who, "at_": at, "v": [f"{w}{a}" for w, a in zip(who, at)]})
        passed.append([v for some in unseen.handleInputRows(None, iter([rows.iloc[:2], rows.iloc[2:]]), None) for v in some["v"]])
    # Rows of one micro-batch with one new key all pass.
    assert passed == [["=b1", "=b1", "=5"], ["=a2", "=c2", "6"], [f"=b{1 << 41}"]]
