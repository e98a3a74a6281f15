"""Station lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks import schemas
from gaugeworks.functions import text as tx


def read_station_list(spark: SparkSession, path: str) -> DataFrame:
    """Typed station list from a CSV with any number of preamble and header lines.

    Data rows are those whose station id is a number, so the same reader serves files with and
    without preamble.
    """
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.STATION_SCHEMA])
    raw = spark.read.schema(raw_schema).csv(path)
    data = raw.where(F.trim("station_id").try_cast("int").isNotNull())
    return data.select(
        *(tx.typed(F.col(f.name), f.dataType).alias(f.name) for f in schemas.STATION_SCHEMA)
    )


def with_province_code(stations: DataFrame, provinces: DataFrame) -> DataFrame:
    """Add ``code`` from a (code, province) lookup; unknown provinces get NULL.

    The lookup is small when it is the built-in table, and left to the optimizer's size estimate
    otherwise.
    """
    return stations.join(provinces.select("province", "code"), "province", "left")


def in_province(stations: DataFrame, provinces: DataFrame, *codes: str) -> DataFrame:
    """Stations of the provinces with the given codes."""
    wanted = provinces.where(F.col("code").isin(*codes)).select("province")
    return stations.join(wanted, "province", "left_semi")


def active_since(last_year: Column, year: int) -> Column:
    """Whether a station still reported in ``year`` or later."""
    return last_year >= year
