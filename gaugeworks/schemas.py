"""Canonical schemas and lookup tables.

Identifiers are strings everywhere, measurements are doubles, and a missing
value is NULL (never NaN).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the published station list, in file order.
STATION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "name", "province", "climate_id", "station_id", "wmo_id", "tc_id")]
    + [T.StructField(c, T.DoubleType()) for c in (
        "latitude_dd", "longitude_dd", "latitude", "longitude", "elevation_m")]
    + [T.StructField(c, T.IntegerType()) for c in (
        "first_year", "last_year", "hly_first_year", "hly_last_year",
        "dly_first_year", "dly_last_year", "mly_first_year", "mly_last_year")]
)

# What each kind of observation measures. Every measurement has a
# text companion named <measurement>_flag.
DAILY_MEASUREMENTS = (
    "cool_deg_days", "dir_of_max_gust", "heat_deg_days", "max_temp", "mean_temp",
    "min_temp", "snow_on_grnd", "spd_of_max_gust", "total_precip", "total_rain", "total_snow",
)
HOURLY_MEASUREMENTS = (
    "dew_point_temp", "hmdx", "precip_amount", "rel_hum", "stn_press", "temp",
    "visibility", "wind_chill", "wind_dir", "wind_spd",
)

_TEXT = {
    "daily": ("climate_id", "station_name", "ec_station_id", "data_quality"),
    "hourly": ("climate_id", "station_name", "ec_station_id", "weather", "time"),
}
_MEASUREMENTS = {"daily": DAILY_MEASUREMENTS, "hourly": HOURLY_MEASUREMENTS}
_INSTANT = {"daily": T.DateType(), "hourly": T.TimestampNTZType()}


def observation_schema(kind: str) -> T.StructType:
    """Schema of the ``daily`` (32 columns) or ``hourly`` (31 columns) table, columns A to Z."""
    types: dict[str, T.DataType] = {c: T.StringType() for c in _TEXT[kind]}
    types |= {c: T.IntegerType() for c in ("year", "month", "day")}
    types |= {c: T.DoubleType() for c in ("latitude", "longitude", *_MEASUREMENTS[kind])}
    types |= {f"{c}_flag": T.StringType() for c in _MEASUREMENTS[kind]}
    types["datetime"] = _INSTANT[kind]
    return T.StructType([T.StructField(c, types[c]) for c in sorted(types)])


UPDATE_LOG_SCHEMA = T.StructType([
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("table", T.StringType()),
    T.StructField("batch_rows", T.LongType()),
    T.StructField("inserted_rows", T.LongType()),
    T.StructField("min_dt", T.StringType()),
    T.StructField("max_dt", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

# Province and territory codes with their English and French names
# as the station lists spell them.
PROVINCES = (
    ("AB", "ALBERTA", "ALBERTA"),
    ("BC", "BRITISH COLUMBIA", "COLOMBIE-BRITANNIQUE"),
    ("MB", "MANITOBA", "MANITOBA"),
    ("NB", "NEW BRUNSWICK", "NOUVEAU-BRUNSWICK"),
    ("NL", "NEWFOUNDLAND", "TERRE-NEUVE"),
    ("NS", "NOVA SCOTIA", "NOUVELLE-ECOSSE"),
    ("NT", "NORTHWEST TERRITORIES", "TERRITOIRES DU NORD-OUEST"),
    ("NU", "NUNAVUT", "NUNAVUT"),
    ("ON", "ONTARIO", "ONTARIO"),
    ("PE", "PRINCE EDWARD ISLAND", "ILE DU PRINCE-EDOUARD"),
    ("QC", "QUEBEC", "QUEBEC"),
    ("SK", "SASKATCHEWAN", "SASKATCHEWAN"),
    ("YT", "YUKON TERRITORY", "YUKON"),
)


def provinces(spark: SparkSession, lang: str = "en") -> DataFrame:
    """The 13 provinces and territories as (code, province)."""
    at = {"en": 1, "fr": 2}[lang]
    rows = [(p[0], p[at]) for p in PROVINCES]
    return F.broadcast(spark.createDataFrame(rows, "code string, province string"))
