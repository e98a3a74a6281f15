"""Stored tables under a name in the session's catalog: SQL over them, and inserts that leave the stored side where it is.

A table that is registered with ``buckets`` keeps its rows apart by a hash of the key columns, sorted within each file. What arrives
is dealt out the same way and meets the stored keys bucket by bucket, so an insert shuffles the new rows only, however
large the table is. The catalog of a plain session forgets names at its end; registering the same folder again finds all
that is stored.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions.geo import EARTH_RADIUS_M
from gaugeworks.session import file_system, staged
from gaugeworks.sources.tables import PARTITION, range_scan, whole_rows

KEY = ("climate_id", "datetime")


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def register(spark: SparkSession, name: str, path: str, kind: str, buckets: int | None = None, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Name the ``daily`` or ``hourly`` table at ``path``, creating it where nothing is, and return it.

    ``buckets`` has to be the same each time a folder is registered; it is also the number of tasks of an insert.
    """
    files, where = file_system(spark, path)
    files.mkdirs(where)
    by = ", ".join(f"`{k}`" for k in keys)
    clustered = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schemas.observation_schema(kind))}, `{PARTITION}` int) USING parquet "
              f"PARTITIONED BY (`{PARTITION}`) {clustered} LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def register_stations(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Name the stored station list, whose directories are provinces."""
    fields = [f for f in schemas.STATION_SCHEMA if f.name != "province"]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(fields)}, `province` string) USING parquet PARTITIONED BY (`province`) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def _buckets(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets of a table and the columns they go by."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return int(facts["Num Buckets"]), [c.strip(" `") for c in facts["Bucket Columns"].strip("[]").split(",")]


def add_rows(df: DataFrame, name: str, watch: Observation | None = None) -> None:
    """Append rows to a bucketed table: one file for each bucket and year that has any. Columns that ``df`` lacks are NULL."""
    spark = df.sparkSession
    buckets, keys = _buckets(spark, name)
    rows = whole_rows(df).withColumn(PARTITION, F.year("datetime")).repartition(buckets, *keys)
    if watch is not None:
        rows = rows.observe(watch, F.count(F.lit(1)).alias("n"))
    rows.write.insertInto(name)


def new_rows(batch: DataFrame, stored: DataFrame, keys: tuple[str, ...] = KEY, dedupe: bool = True, station: str = "ec_station_id") -> DataFrame:
    """Like :func:`gaugeworks.operators.tables.rows_to_insert`, with ``stored`` in buckets by the keys.

    Rows whose keys are all there are compared by plain equality, which buckets serve; the few that lack a part of the key are
    compared apart. Rows are thinned to one per key after the comparison, when they already lie together by key. Keys meet by a
    merge, as in :func:`gaugeworks.operators.tables.rows_to_insert`.
    """
    full = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    kept = stored.select(*keys)
    whole = batch.where(full).join(kept.where(full).hint("merge"), list(keys), "left_anti")
    have = kept.where(~full).select(*(F.col(k).alias(f"_have_{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_have_{k}")) for k in keys))
    loose = batch.where(~full).join(have.hint("merge"), same, "left_anti")
    if not dedupe:
        return whole.unionByName(loose)

    def one(df: DataFrame, *whose: Column) -> DataFrame:
        place = Window.partitionBy(*keys, *whose).orderBy(*(c for c in batch.columns if c not in keys))
        return df.withColumn("_one", F.row_number().over(place)).where(F.col("_one") == 1).drop("_one")

    told = [F.when(F.col(keys[0]).isNull(), F.col(station))] if station in batch.columns else []
    return one(whole).unionByName(one(loose, *told))


def insert_new(batch: DataFrame, name: str, as_of: dt.date | str, dedupe: bool = True) -> dict[str, object]:
    """Append the batch rows before ``as_of`` that the bucketed table ``name`` does not have yet; running twice adds nothing.

    Only years and dates of the batch are compared. Returns the figures for the update log.
    """
    spark, kind = batch.sparkSession, batch.schema["datetime"].dataType
    with staged(batch.where(F.col("datetime") < F.lit(str(as_of)).cast(kind)), "batch") as rows:
        n, lo, hi, years = rows.agg(F.count(F.lit(1)), F.min("datetime"), F.max("datetime"), F.collect_set(F.year("datetime"))).first()  # a handful
        facts = {"table": name, "batch_rows": n, "inserted_rows": 0, "min_dt": None, "max_dt": None}
        if n:
            stored = range_scan(spark.table(name), "datetime", lo, hi).where(F.col(PARTITION).isin(years))
            added = Observation()
            add_rows(new_rows(rows, stored, dedupe=dedupe), name, added)
            facts |= {"inserted_rows": added.get["n"], "min_dt": str(lo), "max_dt": str(hi)}
        return facts


#: The library's expressions under names that SQL text can use.
FUNCTIONS = {
    "station_distance": ("lat1 double, lon1 double, lat2 double, lon2 double", "double",
                         f"""{2 * EARTH_RADIUS_M} * asin(sqrt(least(1d, pow(sin(radians(lat2 - lat1) / 2), 2)
                             + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))"""),
    "speed_of": ("raw string", "double", "try_cast(nullif(regexp_replace(raw, '[^0-9.]', ''), '') as double)"),
    "day_index": ("day date", "string", "concat(month(day), '-', day(day))"),
    "year_month": ("day date", "string", "date_format(day, 'yyyy-MM')"),
}


def register_functions(spark: SparkSession) -> None:
    """Make ``station_distance``, ``speed_of``, ``day_index`` and ``year_month`` known to this session's SQL."""
    for name, (takes, gives, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({takes}) RETURNS {gives} RETURN {body}")
