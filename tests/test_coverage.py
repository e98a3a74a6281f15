"""Station selection, requested periods and file plans."""

import pytest

from gaugeworks import schemas
from gaugeworks.operators import coverage

LIST = "station_id string, province string, tc_id string, dly_first_year int, dly_last_year int, hly_first_year int, hly_last_year int, mly_first_year int, mly_last_year int"


@pytest.fixture
def listed(spark):
    return spark.createDataFrame([
        ("1", "ALBERTA", "YYC", 1990, 2000, 1999, 2000, 1990, 1991),
        ("2", "BRITISH COLUMBIA", "YYC", None, None, None, None, None, None),
        ("123", "BRITISH COLUMBIA", "YV", 1995, 1996, None, None, None, None),
    ], LIST)


def ids(df):
    return sorted(r.station_id for r in df.collect())


@pytest.mark.parametrize("asked, want", [
    (["all"], ["1", "123", "2"]), (["YYC"], ["1", "2"]), (["123"], ["123"]), (["BC", "123", "2"], ["123", "2"]),
    (["ALL"], []), (["YV"], []), (["yyc"], []), (["bc"], []), (["AB", "AB"], ["1"]),
])
def test_selection(spark, listed, asked, want):
    assert ids(coverage.select_stations(listed, asked, schemas.provinces(spark))) == want


def test_unmatched(spark, listed):
    rows = coverage.unmatched_selectors(listed, ["AB", "ALL", "9", "XX", "north", "1"], schemas.provinces(spark)).collect()
    assert {tuple(r) for r in rows} == {("ALL", "airport"), ("9", "station"), ("XX", "province"), ("north", "invalid")}


@pytest.mark.parametrize("period, want", [
    ({}, ("1990-01", "2000-12")),
    ({"start": "1985"}, ("1990-01", "2000-12")),
    ({"start": "1995-05"}, ("1995-05", "2000-12")),
    ({"start": "2001"}, None),
    ({"start": "1985-01", "end": "2005-12"}, ("1985-01", "2005-12")),
    ({"start": "1985-01", "end": "1989-12"}, None),
    ({"end": "2005-12"}, ("1990-01", "2000-12")),
    ({"end": "1995"}, ("1990-01", "1995-01")),
    ({"end": "1989-12"}, None),
    ({"date": "1995-06"}, ("1995-06", "1995-06")),
    ({"date": "2001"}, None),
    ({"date": "1995-06", "start": "1900", "end": "1800"}, ("1995-06", "1995-06")),
])
def test_clipping(spark, listed, period, want):
    rows = coverage.clip_period(listed.where("station_id = '1'"), ["daily"], **period).collect()
    assert [(r.first_month, r.last_month) for r in rows] == ([want] if want else [])


def test_no_availability_and_climate(spark, listed):
    rows = coverage.clip_period(listed.where("station_id = '2'"), coverage.KINDS).collect()
    assert [tuple(r) for r in rows] == [("2", "climate", None, None)]
    with pytest.raises(ValueError):
        coverage.clip_period(listed, ["weekly"])


def test_plan_and_gaps(spark, listed):
    plan = coverage.expand_file_plan(coverage.clip_period(listed, coverage.KINDS, end="1999-03"))
    rows = {tuple(r) for r in plan.collect()}
    assert {r for r in rows if r[1] == "hourly"} == {("1", "hourly", 1999, m) for m in (1, 2, 3)}
    assert {r[2] for r in rows if r[:2] == ("1", "daily")} == set(range(1990, 2000))
    assert {r for r in rows if r[1] == "monthly"} == {("1", "monthly", None, None)}
    assert len([r for r in rows if r[1] == "climate"]) == 3
    delivered = spark.createDataFrame(
        [("1", "hourly", 1999, 2), ("1", "monthly", None, None), ("123", "daily", 1995, None)],
        "station_id string, kind string, year int, month int")
    gaps = {tuple(r) for r in coverage.missing_files(plan, delivered).collect()}
    assert gaps == rows - {tuple(r) for r in delivered.collect()}


def test_info(spark, listed):
    rows = coverage.station_info(listed, ["1"], schemas.provinces(spark)).collect()
    assert {r.field: r.value for r in rows}["tc_id"] == "YYC" and len(rows) == len(listed.columns)
