"""Backfill: a tree of raw files and a station list become clean, typed, partitioned tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from gaugeworks.operators import tables as upkeep
from gaugeworks.sources import observations, stations, tables

TRUNCATE = {"daily": upkeep.truncate_daily, "hourly": upkeep.truncate_hourly}


def write_station_tables(spark: SparkSession, station_list: str, out: str) -> None:
    """Replace the stored station list, one directory per province."""
    listed = stations.read_station_list(spark, station_list)
    listed.write.mode("overwrite").partitionBy("province").parquet(f"{out}/station_metadata")


def read_station_table(spark: SparkSession, out: str, *province_names: str):
    """The stored station list, or the part of it for some provinces (by directory)."""
    from gaugeworks.schemas import STATION_SCHEMA

    listed = spark.read.schema(STATION_SCHEMA).parquet(f"{out}/station_metadata")
    return listed.where(listed.province.isin(*province_names)) if province_names else listed


def backfill(spark: SparkSession, raw: str, out: str, maxdate: dt.date | str, kinds=("daily", "hourly")) -> None:
    """Rebuild the observation tables from all raw files up to ``maxdate``.

    From file to table this is a single lazy plan with one shuffle, for the partitioned write.
    """
    for kind in kinds:
        parsed = observations.read_observation_tree(spark, raw, kind)
        tables.write_observations(TRUNCATE[kind](parsed, maxdate), f"{out}/{kind}", mode="overwrite")


def truncate(spark: SparkSession, out: str, maxdate: dt.date | str, kinds=("daily", "hourly"), strict: bool = False) -> list[dict[str, object]]:
    """Delete from the stored tables what is dated after ``maxdate``; returns what was done to each."""
    return [{"table": kind, **upkeep.delete_after(spark, f"{out}/{kind}", kind, maxdate, strict)} for kind in kinds]
