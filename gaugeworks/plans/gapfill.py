"""Gap filling: daily table to representative years, to weights, to filled records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import climatology, gapfill, weights
from gaugeworks.plans.backfill import read_station_table
from gaugeworks.session import file_system, remove, staged, written
from gaugeworks.sources import stations, tables


def _known(spark: SparkSession, out: str) -> DataFrame:
    listed = read_station_table(spark, out)
    places = listed.select("station_id", F.col("latitude_dd").alias("lat"), F.col("longitude_dd").alias("lon"))
    return weights.station_profiles(places, spark.read.parquet(f"{out}/{YEAR}"))


SUMS, YEAR = "precip_day_sums", "precip_representative_year"


def rebuild_representative_years(spark: SparkSession, out: str) -> None:
    """Replace the stored sums by day and the representative years by those of the whole daily table."""
    sums = climatology.day_sums(tables.read_observations(spark, f"{out}/daily", "daily"))
    sums.write.mode("overwrite").parquet(f"{out}/{SUMS}/run=all")
    for run in _runs(spark, out):
        if run != "run=all":
            remove(spark, f"{out}/{SUMS}/{run}")
    _store_years(spark, out)


def add_to_sums(inserted: DataFrame, out: str, run: str) -> None:
    """Store the sums by day of rows that were inserted, as those of one run; a run that is repeated replaces its own."""
    climatology.day_sums(inserted).write.mode("overwrite").parquet(f"{out}/{SUMS}/run={run}")


def refresh_representative_years(spark: SparkSession, out: str) -> bool:
    """Bring the representative years up to date by the stored sums alone; no observation is read.

    Should the sums count other rows than the table's files do (an update broke off between the two), everything is rebuilt,
    and the answer is False. After many runs their sums are put together.
    """
    runs = _runs(spark, out)
    if not runs:
        rebuild_representative_years(spark, out)
        return False
    sums = spark.read.parquet(*(f"{out}/{SUMS}/{run}" for run in runs))
    counted = sums.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    dated = tables.read_observations(spark, f"{out}/daily", "daily").where(F.col(tables.PARTITION).isNotNull())
    if counted != dated.count():  # a count of rows comes from the footers
        rebuild_representative_years(spark, out)
        return False
    if len(runs) > MOST_RUNS:
        with staged(climatology.added_sums(sums), "sums") as together:
            together.write.mode("overwrite").parquet(f"{out}/{SUMS}/run=all")
        for run in runs:
            if run != "run=all":
                remove(spark, f"{out}/{SUMS}/{run}")
    _store_years(spark, out)
    return True


#: Runs whose sums lie side by side before they are added up.
MOST_RUNS = 32


def _runs(spark: SparkSession, out: str) -> list[str]:
    """Folders of the runs whose sums are stored, one for each update since they were last put together."""
    files, where = file_system(spark, f"{out}/{SUMS}/run=*/_SUCCESS")
    return sorted(s.getPath().getParent().getName() for s in files.globStatus(where) or [])


def _store_years(spark: SparkSession, out: str) -> None:
    sums = spark.read.parquet(*(f"{out}/{SUMS}/{run}" for run in _runs(spark, out)))
    climatology.year_of_sums(sums).write.mode("overwrite").parquet(f"{out}/{YEAR}")


WEIGHTS, WEIGHED = "precip_pairwise_weights", "precip_weighed_stations"
#: Directories of the stored weights, by a hash of the target; an update rewrites those that hold an affected one.
WEIGHT_PARTS = 64


def _stored_by_part(found: DataFrame, path: str, only_parts: bool = False) -> None:
    part = F.pmod(F.xxhash64("active_station"), F.lit(WEIGHT_PARTS)).cast("int")
    rows = found.withColumn("part", part).hint("rebalance", "part")
    mode = "dynamic" if only_parts else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("part").parquet(path)


def rebuild_pairwise_weights(spark: SparkSession, out: str, targets: DataFrame | None = None, nearest: int = weights.NEAREST) -> None:
    """Replace the stored weights of every target (all stations by default) and its nearest stations."""
    known = _known(spark, out)
    _stored_by_part(weights.pairwise_weights(known, known if targets is None else targets, nearest), f"{out}/{WEIGHTS}")
    known.select("station_id", "lat", "lon").write.mode("overwrite").parquet(f"{out}/{WEIGHED}")


def stored_weights_of(spark: SparkSession, out: str) -> DataFrame:
    """The stored weights and their directory ``part``; the schema is stated, as a table without weights has no file to tell it."""
    return spark.read.schema(f"{weights.PAIR}, part int").parquet(f"{out}/{WEIGHTS}")


def affected_targets(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """Targets (``station_id``) of the stored weights that are among the changed stations or have one among their nearest.

    The weights are their own index from stations back to targets: each row is one entry.
    """
    names = changed.select("station_id").distinct()
    through = stored.join(names, "station_id", "left_semi").select(F.col("active_station").alias("station_id"))
    own = stored.select(F.col("active_station").alias("station_id")).join(names, "station_id", "left_semi")
    return through.unionByName(own).distinct()


def refresh_pairwise_weights(spark: SparkSession, out: str, changed: DataFrame, nearest: int = weights.NEAREST) -> int | None:
    """Work out again the stored weights that ``changed`` stations (``station_id``) have a part in; returns the number of targets.

    A representative year decides the correlations of its station as a target and as a neighbour, nothing else. Should stations have come, gone or
    moved, distances are others, too; then everything is rebuilt and the answer is None. Targets that lack weights stay without.
    """
    files, where = file_system(spark, f"{out}/{WEIGHED}/_SUCCESS")
    known = _known(spark, out)
    places = known.select("station_id", "lat", "lon")
    same = files.exists(where)
    if same:
        before = spark.read.schema(places.schema).parquet(f"{out}/{WEIGHED}")
        same = places.exceptAll(before).isEmpty() and before.exceptAll(places).isEmpty()
    if not same:
        rebuild_pairwise_weights(spark, out, nearest=nearest)
        return None
    stored = stored_weights_of(spark, out)
    with staged(affected_targets(stored, changed), "affected") as targets:
        n = targets.count()
        if n:
            parts = [r[0] for r in targets.select(F.pmod(F.xxhash64("station_id"), F.lit(WEIGHT_PARTS)).cast("int")).distinct().collect()]  # WEIGHT_PARTS at most
            others = stored.where(F.col("part").isin(parts)).join(targets.select(F.col("station_id").alias("active_station")), "active_station", "left_anti")
            again = weights.pairwise_weights(known, targets.join(known.select("station_id"), "station_id"), nearest)
            with staged(others.drop("part").unionByName(again), "weights") as rows:
                _stored_by_part(rows, f"{out}/{WEIGHTS}", only_parts=True)
    return n


def active_stations(spark: SparkSession, out: str, year: int) -> DataFrame:
    """Stations that still reported days in ``year`` or later, as targets."""
    listed = read_station_table(spark, out)
    return listed.where(stations.active_since(F.col("dly_last_year"), year)).select("station_id")


def fill(
    spark: SparkSession, out: str, targets: DataFrame | None = None, start: dt.date | str | None = None,
    end: dt.date | str | None = None, stored_weights: bool = True,
) -> DataFrame:
    """Filled daily records of the targets in a date range.

    Weights are the stored ones of each station's nearest, or computed over all stations.
    """
    daily = tables.read_observations(spark, f"{out}/daily", "daily")
    if stored_weights:
        found = weights.top_positive(stored_weights_of(spark, out).drop("part"))
    else:
        known = _known(spark, out)
        found = weights.station_weights(known, known if targets is None else targets)
    listed = read_station_table(spark, out).select("station_id", F.col("latitude_dd").alias("lat"), F.col("longitude_dd").alias("lon"))
    return gapfill.interpolate_precip(daily, written(found, "weights"), targets, start, end, listed)
