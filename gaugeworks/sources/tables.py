"""Stored observation tables: partitioned Parquet, read by date range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks import schemas
from gaugeworks.session import file_system

# Partition column, derived from the row's own date so that pruning is always right whatever the
# file's year column says. A missing date goes to the partition of NULL.
PARTITION = "obs_year"


def range_scan(
    df: DataFrame, column: str, start: dt.date | str | None = None, end: dt.date | str | None = None
) -> DataFrame:
    """Rows with ``start <= column <= end``; either bound may be left out.

    An end that is a day takes in the whole of that day, also where the column has times. On a stored table the
    bounds also select partitions.
    """
    kind = df.schema[column].dataType
    if start is not None:
        df = df.where(F.col(column) >= F.lit(str(start)).cast(kind))
    if end is not None:
        if len(str(end)) == 10 and not isinstance(kind, T.DateType):
            df = df.where(F.col(column) < F.date_add(F.lit(str(end)).cast("date"), 1).cast(kind))
        else:
            df = df.where(F.col(column) <= F.lit(str(end)).cast(kind))
    if PARTITION in df.columns:
        df = df if start is None else df.where(F.col(PARTITION) >= int(str(start)[:4]))
        df = df if end is None else df.where(F.col(PARTITION) <= int(str(end)[:4]))
    return df


def create_table(spark: SparkSession, path: str, kind: str) -> None:
    """Create an empty ``daily`` or ``hourly`` table, dropping what was there."""
    empty = spark.createDataFrame([], schemas.observation_schema(kind))
    write_observations(empty, path, mode="overwrite")


def whole_rows(df: DataFrame) -> DataFrame:
    """The columns of the daily table, or of the hourly one where dates have a time, in order; those that lack are NULL."""
    kind = "daily" if isinstance(df.schema["datetime"].dataType, T.DateType) else "hourly"
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schemas.observation_schema(kind)))


def write_observations(
    df: DataFrame, path: str, mode: str = "append", watch: Observation | None = None, only_years: bool = False
) -> None:
    """Write rows partitioned by year of observation.

    ``mode="overwrite"`` replaces the table, or, with ``only_years``, the directories of the years that ``df`` has.

    Rows are gathered by year, and adaptive execution then cuts large years into several tasks and puts
    small ones together, so files are few and of even size whatever the input and however uneven the
    years. Within a file they are sorted by station and date, which lets scans skip row groups. ``watch``
    counts the rows in the writing tasks themselves, so a recomputed stage is not counted twice. All files have all
    columns of the table.
    """
    order = (PARTITION, "ec_station_id", "datetime")
    rows = whole_rows(df).withColumn(PARTITION, F.year("datetime")).hint("rebalance", PARTITION).sortWithinPartitions(*order)
    if watch is not None:
        rows = rows.observe(watch, F.count(F.lit(1)).alias("n"))
    replaced = "dynamic" if only_years else "static"
    rows.write.mode(mode).option("partitionOverwriteMode", replaced).partitionBy(PARTITION).parquet(path)


def read_observations(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A stored table with its partition column, schema declared rather than inferred."""
    schema = schemas.observation_schema(kind).add(PARTITION, T.IntegerType())
    return spark.read.schema(schema).parquet(path)


def partition_folder(path: str, year: int | None) -> str:
    """Where a table keeps the rows of a year, or those without a date."""
    return f"{path}/{PARTITION}={'__HIVE_DEFAULT_PARTITION__' if year is None else year}"


def years_stored(spark: SparkSession, path: str) -> list[int]:
    """Years that a table has directories for, ascending; nothing is read."""
    files, where = file_system(spark, f"{path}/{PARTITION}=*")
    names = [x.getPath().getName().partition("=")[2] for x in files.globStatus(where) or []]
    return sorted(int(x) for x in names if x.lstrip("-").isdigit())


def date_extremes(spark: SparkSession, path: str) -> DataFrame:
    """One row for a daily table: min_datetime, max_datetime and n_rows of its dated rows, from file footers; no data is read.

    (Footers do not hold the extremes of timestamps; an hourly table has :func:`years_stored`.)
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    dated = read_observations(session, path, "daily").where(F.col(PARTITION).isNotNull())
    return dated.agg(F.min("datetime").alias("min_datetime"), F.max("datetime").alias("max_datetime"), F.count("*").alias("n_rows"))
