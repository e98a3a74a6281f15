"""Upkeep of stored tables: insert-only updates, truncation, year buckets, retention, log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions import calendar as cal
from gaugeworks.operators.membership import maybe_among
from gaugeworks.session import file_system, remove, staged
from gaugeworks.sources import named_files, tables

KEY = ("climate_id", "datetime")
#: Two to this number bits tell which stored keys a batch may have (16 MB for a million slots and their bits).
BATCH_BITS = 26


def before(df: DataFrame, as_of: dt.date | str, column: str = "datetime") -> DataFrame:
    """Rows dated before the day ``as_of``; rows without a date are dropped."""
    return df.where(F.col(column) < F.lit(str(as_of)).cast(df.schema[column].dataType))


def rows_to_insert(
    batch: DataFrame, stored: DataFrame, keys: tuple[str, ...] = KEY, dedupe: bool = True, station: str = "ec_station_id"
) -> DataFrame:
    """Batch rows whose key is not stored yet, one per key. NULL keys equal stored NULL keys.

    Of several batch rows with one key the smallest by its remaining columns stays, whatever their order;
    rows without a first key are told apart by ``station``, so stations that lack an id all keep theirs.
    ``dedupe=False`` keeps all. Only keys are compared with the stored side, each of its keys once, and by a merge: its files are so
    much smaller than its rows that a plan by their size would send all keys through the driver.
    """
    if dedupe:
        batch = one_per_key(batch, keys, station)
    have = stored.select(*(F.col(k).alias(f"_have_{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_have_{k}")) for k in keys))
    return batch.join(have.hint("merge"), same, "left_anti")


def one_per_key(batch: DataFrame, keys: tuple[str, ...] = KEY, station: str = "ec_station_id") -> DataFrame:
    """The row of each key that :func:`rows_to_insert` chooses."""
    whose = [F.when(F.col(keys[0]).isNull(), F.col(station))] if station in batch.columns else []
    rest = [F.col(c) for c in batch.columns if c not in keys]
    one = Window.partitionBy(*keys, *whose).orderBy(*rest)
    return batch.withColumn("_one", F.row_number().over(one)).where(F.col("_one") == 1).drop("_one")


def maybe_in_batch(stored: DataFrame, batch: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """The keys of ``stored`` without most of those that the batch does not have, which need not be shuffled and sorted then.

    A bit map of the batch's keys tells them; no key that the batch has is lost.
    """
    hashed = stored.select(*keys, F.xxhash64(*keys).alias("_key"))
    asked = batch.select(F.xxhash64(*(F.col(k).cast(stored.schema[k].dataType) for k in keys)).alias("_key"))
    return maybe_among(hashed, asked, "_key", BATCH_BITS).where("maybe").select(*keys)


def in_batch_range(stored: DataFrame, batch: DataFrame, column: str = "datetime") -> DataFrame:
    """Stored rows between the earliest and latest date of the batch.

    The two dates are fetched and used as literals, so that the stored side is pruned by partition
    and by Parquet statistics.
    """
    lo, hi = batch.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return stored.where(F.lit(False))
    return tables.range_scan(stored, column, lo, hi)


def incremental_insert(
    batch: DataFrame, path: str, kind: str, as_of: dt.date | str, dedupe: bool = True, stage: bool = True,
    then: Callable[[DataFrame], None] | None = None,
) -> dict[str, object]:
    """Append the batch rows not stored yet to the table at ``path``; running twice adds nothing.

    A missing table is created. The cleaned batch is staged for the duration, so raw files are parsed a single time (``stage=False``
    where it is a stored table already). ``then`` is called with the rows that were inserted, for what is kept up with
    the table. Returns the figures for the update log.
    """
    files, where = file_system(batch.sparkSession, path)
    if not files.exists(where):
        tables.create_table(batch.sparkSession, path, kind)
    current = before(batch, as_of)
    if not stage:
        return insert_rows(current, path, kind, dedupe, then)
    with staged(current, f"batch-{kind}") as stored_batch:
        return insert_rows(stored_batch, path, kind, dedupe, then)


def insert_rows(
    batch: DataFrame, path: str, kind: str, dedupe: bool = True, then: Callable[[DataFrame], None] | None = None, compare: bool = True,
) -> dict[str, object]:
    """Append a stored batch to the table at ``path``, which exists; see :func:`incremental_insert`.

    ``compare=False`` is for rows that are known not to be stored: only equal keys of the batch are told apart.
    """
    n, lo, hi, years = batch.agg(  # the years are a handful of numbers
        F.count(F.lit(1)), F.min("datetime"), F.max("datetime"), F.collect_set(F.year("datetime"))).first()
    facts = {"table": kind, "batch_rows": n, "inserted_rows": 0, "min_dt": None, "max_dt": None}
    if n:
        if compare:
            stored = tables.read_observations(batch.sparkSession, path, kind)
            if lo is not None:
                stored = tables.range_scan(stored, "datetime", lo, hi).where(F.col(tables.PARTITION).isin(years))
            new = rows_to_insert(batch, maybe_in_batch(stored, batch), dedupe=dedupe)
        else:
            new = one_per_key(batch) if dedupe else batch
        added = Observation()
        if then is None:
            tables.write_observations(new, path, watch=added)
        else:
            with staged(new, f"new-{kind}") as rows:
                tables.write_observations(rows, path, watch=added)
                then(rows)
        facts |= {"inserted_rows": added.get["n"], "min_dt": str(lo), "max_dt": str(hi)}
    return facts


def append_update_log(
    spark: SparkSession, path: str, facts: dict[str, object], run_ts: dt.datetime, run_id: str | None = None
) -> None:
    """Record one run; the latest row is the status report. A ``run_id`` that is in the log is not recorded again."""
    files, where = file_system(spark, path)
    if run_id is not None and files.exists(where):
        log = spark.read.schema(schemas.UPDATE_LOG_SCHEMA).parquet(path)
        if not log.where((F.col("run_id") == run_id) & (F.col("table") == facts["table"])).isEmpty():
            return
    row = tuple({"run_ts": run_ts, "run_id": run_id, **facts}[f.name] for f in schemas.UPDATE_LOG_SCHEMA)
    spark.createDataFrame([row], schemas.UPDATE_LOG_SCHEMA).write.mode("append").parquet(path)


def last_update(spark: SparkSession, path: str) -> DataFrame:
    """The newest log row of each table."""
    log = spark.read.schema(schemas.UPDATE_LOG_SCHEMA).parquet(path)
    rest = [c for c in log.columns if c not in ("table", "run_ts")]
    return log.groupBy("table").agg(
        F.max("run_ts").alias("run_ts"), *(F.max_by(c, "run_ts").alias(c) for c in rest)
    )


def _last_day(maxdate: dt.date | str) -> dt.date:
    """A date as given, or the last day of a ``YYYY-MM`` month."""
    text = str(maxdate)
    if len(text) > 7:
        return dt.date.fromisoformat(text[:10])
    month = cal.parse_month(text)
    return (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def _late(kind: str, maxdate: dt.date | str, strict: bool = False) -> Column:
    """Whether a row is dated after ``maxdate``: by its date if daily, by its columns year and month if hourly."""
    last = _last_day(maxdate)
    if kind == "daily":
        return F.coalesce(F.col("datetime") > F.lit(last), F.lit(False))
    year, month = F.col("year"), F.col("month")
    late = (year >= last.year) & (month > last.month) if strict else year * 12 + month > last.year * 12 + last.month
    return F.coalesce(late, F.lit(False))


def truncate_daily(df: DataFrame, maxdate: dt.date | str) -> DataFrame:
    """Drop rows dated after ``maxdate``; undated rows stay."""
    return df.where(~_late("daily", maxdate))


def truncate_hourly(df: DataFrame, maxdate: dt.date | str, strict: bool = False) -> DataFrame:
    """Drop rows of months after that of ``maxdate``, by the ``year`` and ``month`` columns.

    ``strict=True`` compares year and month separately, which keeps the early months of later years.
    """
    return df.where(~_late("hourly", maxdate, strict))


def delete_after(spark: SparkSession, path: str, kind: str, maxdate: dt.date | str, strict: bool = False) -> dict[str, object]:
    """Delete from the table at ``path`` what :func:`truncate_daily` or :func:`truncate_hourly` drops.

    One scan of the dates counts the rows to delete in each year. Years that lose all rows go by directory, those that lose
    some are rewritten, one directory each, and files of all others are left alone. Rows that stay in a year are staged
    before their directory is replaced; running again deletes nothing. Returns years dropped, years rewritten and rows deleted.
    """
    stored, late = tables.read_observations(spark, path, kind), _late(kind, maxdate, strict)
    # A day's year is that of its directory; hours go by columns of their own.
    scanned = stored.where(F.col(tables.PARTITION) >= _last_day(maxdate).year) if kind == "daily" else stored
    hit = scanned.groupBy(tables.PARTITION).agg(F.count_if(late).alias("late"), F.count("*").alias("n")).where("late > 0").collect()  # years
    dropped, cut = ([row[0] for row in hit if (row["late"] == row["n"]) == whole] for whole in (True, False))
    if cut:
        year = F.col(tables.PARTITION)
        chosen = year.isin([y for y in cut if y is not None]) | (year.isNull() if None in cut else F.lit(False))
        with staged(stored.where(chosen).where(~late).drop(tables.PARTITION), f"kept-{kind}") as kept:
            tables.write_observations(kept, path, mode="overwrite", only_years=True)
    for y in dropped:
        remove(spark, tables.partition_folder(path, y))
    by_age = {"key": lambda y: (y is not None, y or 0)}
    return {"dropped": sorted(dropped, **by_age), "rewritten": sorted(cut, **by_age), "deleted_rows": sum(row["late"] for row in hit)}


def with_year_bucket(df: DataFrame, step: int, year: str = "year", span: tuple[int | None, int | None] | None = None) -> DataFrame:
    """Add ``bucket``, the label of the row's piece of the years present (10 daily, 5 hourly).

    ``span``, the first and the last year, spares a scan where it is known (see :func:`gaugeworks.sources.tables.years_stored`).
    """
    lo, hi = span or df.agg(F.min(year), F.max(year)).first()
    if lo is None:
        return df.withColumn("bucket", F.lit(None).cast("string"))
    return df.withColumn("bucket", cal.year_bucket(F.col(year), int(lo), int(hi), step))


def write_year_buckets(df: DataFrame, path: str, step: int, year: str = "year", span: tuple[int | None, int | None] | None = None) -> None:
    """One directory of CSV files per year bucket; rows are gathered by bucket, and large ones are split again."""
    with_year_bucket(df, step, year, span).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").csv(path, header=True)


def write_named_buckets(
    df: DataFrame, path: str, label: str, step: int, year: str = "year", span: tuple[int | None, int | None] | None = None,
    pieces: int = 1, piece: Column | None = None,
) -> None:
    """CSV files ``<label>_<piece>_<lo>-<hi>.csv``, one for each year bucket and piece of its stations.

    Many tasks sort and write the parts of a file. Stations are dealt to the ``pieces`` by a hash of their id, or by the whole
    number ``piece`` modulo their number. Rows without a year are left out.
    """
    dealt = F.pmod(F.xxhash64("ec_station_id") if piece is None else piece, F.lit(pieces))
    bucketed = with_year_bucket(df, step, year, span).where("bucket is not null")
    name = F.concat_ws("_", F.lit(label), dealt.cast("string"), "bucket")
    named_files.write_named(bucketed, path, name, sort=("ec_station_id", "datetime"))


def newest_dates(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    """The ``n`` newest distinct values of a date column: a top-n, never a full sort."""
    dates = df.select(column).where(F.col(column).isNotNull()).distinct()
    return dates.orderBy(F.desc(column)).limit(n)


def keep_newest(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    """Rows of the ``n`` newest snapshots. The broadcast side has ``n`` rows."""
    return df.join(F.broadcast(newest_dates(df, column, n)), column, "left_semi")


def archive_snapshot(df: DataFrame, path: str, day: dt.date | str, keep: int = 3) -> list[str]:
    """Drop all but the ``keep`` newest snapshots below ``path``, then add today's.

    Up to ``keep + 1`` remain. Returns the dates dropped.
    """
    spark, prefix = df.sparkSession, "snapshot_date="
    files, base = file_system(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(base)] if files.exists(base) else []
    dates = sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))
    expired = [d for d in dates[:-keep] if d != str(day)]
    for d in expired:
        remove(spark, f"{path}/{prefix}{d}")
    df.write.mode("overwrite").parquet(f"{path}/{prefix}{day}")
    return expired
