"""Column expressions on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks import schemas
from gaugeworks.functions import calendar as cal
from gaugeworks.functions import geo, stats
from gaugeworks.functions import text as tx


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_speed_marks(spark):
    raw = ["<31", "45", "12.5", "M", None]
    assert column(spark, raw, lambda v: tx.number(tx.digits_only(v))) == [31.0, 45.0, 12.5, None, None]
    assert column(spark, raw, lambda v: tx.digits_only(v, keep_point=False)) == ["31", "45", "125", "", None]


def test_names(spark):
    raw = ["Stn. Press (kPa)", "Date/Time (LST)", "Spd of Max Gust (km/h)", " Hmdx ", "Dew Point Temp (°C)"]
    want = ["stn_press", "date/time", "spd_of_max_gust", "hmdx", "dew_point_temp"]
    assert column(spark, raw, tx.clean_name) == want
    assert tx.clean_names(spark.createDataFrame([(1,) * 5], raw)).columns == want


def test_safe_types(spark):
    raw = ["1.5", "", "NA", "x", " 7 ", "NaN", None]
    assert column(spark, raw, lambda v: tx.typed(v, T.DoubleType())) == [1.5, None, None, None, 7.0, None, None]
    assert column(spark, raw, lambda v: tx.typed(v, T.IntegerType()))[4] == 7
    assert column(spark, ["", "NA", "ok"], tx.blank_to_null) == [None, None, "ok"]


def test_dates(spark):
    day = dt.date(2000, 2, 29)
    assert column(spark, ["2000-02-29", "2001-02-29", "x", None], cal.to_day) == [day, None, None, None]
    minute = dt.datetime(2020, 1, 2, 3, 4)
    assert column(spark, ["2020-01-02 03:04", "2020-01-02", "noon", "2020-01-02 25:04"], cal.to_minute) == [minute, None, None, None]
    want = [dt.date(1999, 1, 1), dt.date(1999, 7, 1), None, None, None]
    assert column(spark, ["1999", "1999-07", "1999-13", "1999-07-01", "x"], cal.to_month) == want
    window = spark.range(1).select(*cal.update_window(F.lit(dt.date(2023, 3, 15)))).first()
    assert tuple(window) == ("2023-02", "2023-03")


def test_slots_cover_a_common_year_in_order(spark):
    days = [dt.date(2001, 1, 1) + dt.timedelta(i) for i in range(365)]
    assert column(spark, [f"{d.month}-{d.day}" for d in days], cal.slot_of) == list(range(365))


@pytest.mark.parametrize("lo, hi, step, want", [
    (1990, 2022, 10, {"2012-2022", "2002-2012", "1990-2002"}),
    (2000, 2009, 10, {"2000-2009"}),
    (2000, 2010, 10, {"2000-2010"}),
    (1990, 2022, 5, {"2017-2022", "2012-2017", "2007-2012", "2002-2007", "1997-2002", "1990-1997"}),
    (2005, 2005, 5, {"2005-2005"}),
])
def test_year_buckets(spark, lo, hi, step, want):
    years = list(range(lo, hi + 1))
    labels = column(spark, years, lambda y: cal.year_bucket(y, lo, hi, step), "int")
    assert set(labels) == want
    for year, label in zip(years, labels):
        start, end = map(int, label.split("-"))
        assert start <= year and (year < end or (year == end == hi))


def test_requested_period():
    assert cal.requested_period("1999-05", "x", None) == (dt.date(1999, 5, 1), None, None)
    assert cal.requested_period(start="1999-01", end="1999") == (None, dt.date(1999, 1, 1), dt.date(1999, 12, 1))
    assert cal.requested_period(start="1999", end="2000") == (None, dt.date(1999, 1, 1), dt.date(2000, 1, 1))
    for bad in ({"start": "2000-02", "end": "2000"}, {"date": "2000-01-01"}, {"end": "20xx"}):
        with pytest.raises(ValueError):
            cal.requested_period(**bad)


def test_correlation_and_means(spark):
    flat = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 5.0)], "x double, y double")
    assert flat.agg(stats.pearson(F.col("x"), F.col("y"))).first()[0] is None
    rows = [(1.0, 1.0), (2.0, 4.0), (4.0, 3.0), (None, 7.0), (2.0, None)]
    some = spark.createDataFrame(rows, "x double, y double")
    assert abs(some.agg(stats.pearson(F.col("x"), F.col("y"))).first()[0] - 0.5) < 1e-12
    assert some.agg(stats.completeness(F.col("x"))).first()[0] == 0.8
    assert some.where("false").agg(stats.weighted_mean(F.col("x"), F.col("y"))).first()[0] is None
    even = spark.createDataFrame([(10.0, 1.0), (20.0, 3.0)], "x double, y double")
    assert even.agg(stats.weighted_mean(F.col("x"), F.col("y"))).first()[0] == 17.5


def test_great_circle(spark):
    quarter = spark.range(1).select(geo.haversine(*(F.lit(float(v)) for v in (0, 0, 0, 90)))).first()[0]
    assert abs(quarter - geo.EARTH_RADIUS_M * 3.141592653589793 / 2) < 1e-6


def test_schemas():
    assert len(schemas.STATION_SCHEMA) == 19
    assert len(schemas.observation_schema("daily")) == 32
    assert len(schemas.observation_schema("hourly")) == 31
    assert schemas.observation_schema("daily").names == sorted(schemas.observation_schema("daily").names)


def test_column_helpers(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["Z", "Max Spd", "wind spd flag"])
    changed = tx.transform_matching(df, "Spd", F.upper)
    assert tx.sorted_columns(changed).columns == ["Max Spd", "Z", "wind spd flag"]
    assert tuple(tx.sorted_columns(changed).first()) == ("B", "a", "C")
