"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Doubles are rounded to six places, and zero is added so that a negative zero prints as zero.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks import fixtures as fx
from gaugeworks import schemas
from gaugeworks.functions import calendar as cal
from gaugeworks.functions import geo
from gaugeworks.functions import text as tx
from gaugeworks.operators import climatology, coverage, gapfill, neighbours, tables, weights
from gaugeworks.operators.union import union_by_name
from gaugeworks.plans import backfill
from gaugeworks.plans import gapfill as gapfill_jobs
from gaugeworks.session import scratch_folder, written
from gaugeworks.sources import catalog, named_files, observations, stations
from gaugeworks.sources import tables as tables_io
from gaugeworks.sources.tables import range_scan
from gaugeworks.streaming import keyed, updates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SELECTORS = ("DD", "7", "42", "EAE", "IAB", "ZZZ", "999999999", "QQ", "x", "north shore")
NEAR = weights.NEAREST


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r6(column: Column | str) -> Column:
    return F.round(column, 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


# --- representative year -------------------------------------------------------------------------

@query
def rep_year(spark, sf):
    return rounded(climatology.representative_year(fx.daily(spark, sf)))


@query
def completeness(spark, sf):
    return rounded(climatology.rep_year_completeness(climatology.representative_year(fx.daily(spark, sf))))


@query
def stations_without(spark, sf):
    """Orders play the stations here, since some of them have no value at all."""
    shipped = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("ec_station_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("total_precip"),
    )
    return climatology.stations_without(shipped)


# --- distances and weights -----------------------------------------------------------------------

def _stations(spark, sf):
    return written(fx.stations(spark, sf).select("station_id", "lat", "lon"), "stations")


def _profiles(spark, sf):
    return weights.station_profiles(fx.stations(spark, sf), climatology.representative_year(fx.daily(spark, sf)))


@query
def distance_range(spark, sf):
    places = _stations(spark, sf)
    return rounded(neighbours.distance_range(places, places))


@query
def nearest_stations(spark, sf):
    places = _stations(spark, sf)
    return rounded(neighbours.nearest_stations(places, places, NEAR).drop("min_distance", "max_distance"))


@query
def distance_weight(spark, sf):
    places = _stations(spark, sf)
    found = neighbours.nearest_stations(places, places, weights.NEAREST)
    weight = neighbours.scaled(F.col("distance"), F.col("min_distance"), F.col("max_distance"))
    return rounded(found.select("active_station", "station_id", weight.alias("dist_weight")))


@query
def rep_year_corr(spark, sf):
    """Correlation, and distance by plain expressions, for each station's nearest."""
    year = written(climatology.representative_year(fx.daily(spark, sf)), "rep-year")
    places = _stations(spark, sf)
    pairs = written(neighbours.nearest_stations(places, places, NEAR).select("active_station", "station_id"), "nearest")
    a = places.select(F.col("station_id").alias("active_station"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    metres = geo.haversine(F.col("lat1"), F.col("lon1"), F.col("lat"), F.col("lon"))
    r = weights.correlated(pairs, year, places)
    far = pairs.join(a, "active_station").join(places, "station_id")
    far = far.select("active_station", "station_id", F.round(metres, 3).alias("distance"))
    return rounded(far.join(r, ["active_station", "station_id"], "left"))


@query
def pairwise_weights(spark, sf):
    known = _profiles(spark, sf)
    return rounded(weights.pairwise_weights(known, known))


@query
def station_weights_top(spark, sf):
    known = _profiles(spark, sf)
    return rounded(weights.station_weights(known, known))


@query
def stored_weights_top(spark, sf):
    """The best hundred positive weights among each station's nearest, best first."""
    known = _profiles(spark, sf)
    return rounded(weights.by_weight(weights.top_positive(weights.pairwise_weights(known, known))))


# --- gap filling ---------------------------------------------------------------------------------

def _filled(spark, sf, **period):
    daily = written(fx.daily(spark, sf), "daily")
    known = weights.station_profiles(fx.stations(spark, sf), climatology.representative_year(daily))
    places = fx.stations(spark, sf).select("station_id", "lat", "lon")
    return gapfill.interpolate_precip(daily, written(weights.station_weights(known, known), "weights"), places=places, **period)


FILLED = ("ec_station_id", "datetime", "total_precip", "og_total_precip", "precip_intp_flag", "n_neighbours")


@query
def interpolate_precip(spark, sf):
    return rounded(_filled(spark, sf).select(*FILLED))


@query
def interpolate_range(spark, sf):
    return rounded(_filled(spark, sf, start="1996-02-01", end="1997-06-30").select(*FILLED))


@query
def interpolation_summary(spark, sf):
    return gapfill.interpolation_summary(_filled(spark, sf))


# --- stored tables -------------------------------------------------------------------------------

OBSERVED = ("ec_station_id", "datetime", "total_precip")


@query
def range_scan_both(spark, sf):
    return range_scan(fx.daily(spark, sf), "datetime", "1996-02-01", "1997-12-31").select(*OBSERVED)


@query
def range_scan_start(spark, sf):
    return range_scan(fx.daily(spark, sf), "datetime", start="1999-07-15").select(*OBSERVED)


@query
def range_scan_end(spark, sf):
    return range_scan(fx.daily(spark, sf), "datetime", end="1996-02-29").select(*OBSERVED)


def _stored_daily(spark, sf):
    """Station-days already stored: those with a finished shipment."""
    done = fx.table(spark, sf, "lineitem").where(F.col("l_linestatus") == "F")
    return done.select(
        F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("climate_id"),
        F.col("l_shipdate").cast("date").alias("datetime"),
    )


def _stored_hourly(spark, sf):
    """Station-hours already stored: those with a click."""
    hourly = fx.hourly_of(fx.table(spark, sf, "events").where(F.col("event_type") == "click"))
    return hourly.select("climate_id", "datetime")


@query
def range_scan_hourly(spark, sf):
    """A range of days over hours: the last day is in it to its end."""
    hours = range_scan(fx.hourly(spark, sf), "datetime", "2024-01-10", "2024-01-20")
    return rounded(hours.select("ec_station_id", "datetime", "temp"))


def _inserted(spark, sf, kind):
    """Folder of a table and log after two inserts of one batch, which repeats keys and lacks some climate ids.

    Every tenth station has no climate id; every row comes twice, the copy with a larger value.
    """
    rows, stored, as_of, value = {
        "daily": (fx.daily, _stored_daily, "2001-06-01", "total_precip"), "hourly": (fx.hourly, _stored_hourly, "2024-01-25", "temp"),
    }[kind]
    folder = f"{scratch_folder(spark)}/upkeep-{uuid.uuid4().hex}"
    there = stored(spark, sf).distinct().withColumns({"ec_station_id": F.substring("climate_id", 2, 99), "station_name": F.lit("stored")})
    tables_io.write_observations(there, f"{folder}/{kind}", mode="overwrite")
    tenth = F.col("ec_station_id").cast("int") % 10 == 0
    once = rows(spark, sf).withColumn("climate_id", F.when(~tenth, F.col("climate_id")))
    batch = written(once.unionByName(once.withColumn(value, F.col(value) + 1000).withColumn("year", F.col("year") + 1)), f"{folder}/batch", f"{folder}/batch")
    for run in (1, 2):
        facts = tables.incremental_insert(batch, f"{folder}/{kind}", kind, as_of, stage=False)
        tables.append_update_log(spark, f"{folder}/log", facts, dt.datetime(2024, 1, run))
    return folder


def _added(spark, sf, kind):
    found = tables_io.read_observations(spark, f"{_inserted(spark, sf, kind)}/{kind}", kind)
    return found.where("station_name is null or station_name <> 'stored'")


@query
def insert_daily(spark, sf):
    return _added(spark, sf, "daily").select("climate_id", *OBSERVED)


@query
def insert_hourly(spark, sf):
    return rounded(_added(spark, sf, "hourly").select("climate_id", "ec_station_id", "datetime", "time", "temp"))


@query
def interpolated_record(spark, sf):
    """Filled records as they are stored and read again, one directory per year."""
    path = f"{scratch_folder(spark)}/filled-{uuid.uuid4().hex}"
    gapfill.write_interpolated(_filled(spark, sf), path)
    return rounded(spark.read.parquet(path).select(*FILLED))


@query
def insert_stream(spark, sf):
    """The whole daily table as a stream of files, inserted twice over into an empty table."""
    folder = f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = written(fx.daily(spark, sf), "arriving", f"{folder}/arriving")
    tables_io.create_table(spark, f"{folder}/daily", "daily")
    for run in ("first", "again"):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/arriving")
        updates.insert_stream(stream, folder, "daily", f"{folder}/{run}", lambda: "2001-06-01", once=True).awaitTermination()
    return tables_io.read_observations(spark, f"{folder}/daily", "daily").select("climate_id", *OBSERVED)


@query
def insert_keyed_stream(spark, sf):
    """As ``insert_stream``, with keys held in the state; half of the rows are stored before the stream begins, and it stops once on its way."""
    folder = _new_folder(spark, "keyed-stream")
    rows = written(fx.daily(spark, sf), "arriving", f"{folder}/arriving")
    before = rows.where(F.pmod(F.hash("ec_station_id", "datetime"), F.lit(2)) == 0)
    tables.incremental_insert(before, f"{folder}/daily", "daily", "2001-06-01")
    for part in ("first", "more"):
        if part == "more":
            written(rows, "again", f"{folder}/arriving/again")  # all files once more
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).option("recursiveFileLookup", True).parquet(f"{folder}/arriving")
        keyed.insert_keyed_stream(stream, folder, "daily", f"{folder}/checkpoint", "2001-06-01", once=True).awaitTermination()
    return tables_io.read_observations(spark, f"{folder}/daily", "daily").select("climate_id", *OBSERVED)


@query
def update_log(spark, sf):
    """Both log rows of the daily inserts: the second run adds nothing."""
    log = spark.read.parquet(f"{_inserted(spark, sf, 'daily')}/log")
    return log.select("table", F.day("run_ts").alias("run"), "batch_rows", "inserted_rows", "min_dt", "max_dt")


@query
def last_update(spark, sf):
    return tables.last_update(spark, f"{_inserted(spark, sf, 'daily')}/log").select("table", F.day("run_ts").alias("run"), "inserted_rows")


@query
def truncate_daily(spark, sf):
    return tables.truncate_daily(fx.daily(spark, sf), "2000-02").select(*OBSERVED)


@query
def truncate_hourly(spark, sf):
    return tables.truncate_hourly(fx.daily(spark, sf), "1998-06").select(*OBSERVED)


@query
def truncate_hourly_strict(spark, sf):
    return tables.truncate_hourly(fx.daily(spark, sf), "1998-06", strict=True).select(*OBSERVED)


def _new_folder(spark, label):
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _with_undated(spark, sf):
    """Daily rows, and one without a date for each station."""
    undated = fx.stations(spark, sf).select(F.col("station_id").alias("ec_station_id"), "climate_id")
    return union_by_name(fx.daily(spark, sf), undated)


@query
def delete_after_daily(spark, sf):
    """A stored table after what is dated after February 2000 was deleted from it, twice."""
    path = _new_folder(spark, "cut")
    tables_io.write_observations(_with_undated(spark, sf), path, mode="overwrite")
    for _ in range(2):
        tables.delete_after(spark, path, "daily", "2000-02")
    return tables_io.read_observations(spark, path, "daily").select(*OBSERVED)


def _deleted_hours(strict):
    def run(spark, sf):
        path = _new_folder(spark, "cut")
        rows = _with_undated(spark, sf).select(
            "ec_station_id", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "year", "month", F.col("total_precip").alias("temp"))
        tables_io.write_observations(rows, path, mode="overwrite")
        tables.delete_after(spark, path, "hourly", "1998-06", strict)
        found = tables_io.read_observations(spark, path, "hourly")
        return found.select("ec_station_id", F.col("datetime").cast("date").alias("datetime"), F.col("temp").alias("total_precip"))
    return run


QUERIES["delete_after_hourly"] = _deleted_hours(False)
QUERIES["delete_after_hourly_strict"] = _deleted_hours(True)

#: Buckets of the test tables' stored keys.
BUCKETS = 4


def _inserted_by_bucket(spark, sf, kind):
    """A bucketed table after two inserts of the batch that ``insert_daily`` and ``insert_hourly`` insert."""
    rows, stored, as_of, value = {
        "daily": (fx.daily, _stored_daily, "2001-06-01", "total_precip"), "hourly": (fx.hourly, _stored_hourly, "2024-01-25", "temp"),
    }[kind]
    name, folder = f"gaugeworks_{uuid.uuid4().hex}", _new_folder(spark, "bucketed")
    there = stored(spark, sf).distinct().withColumns({"ec_station_id": F.substring("climate_id", 2, 99), "station_name": F.lit("stored")})
    catalog.register(spark, name, f"{folder}/{kind}", kind, BUCKETS)
    catalog.add_rows(there, name)
    tenth = F.col("ec_station_id").cast("int") % 10 == 0
    once = rows(spark, sf).withColumn("climate_id", F.when(~tenth, F.col("climate_id")))
    batch = written(once.unionByName(once.withColumn(value, F.col(value) + 1000).withColumn("year", F.col("year") + 1)), "batch", f"{folder}/batch")
    for _ in range(2):
        catalog.insert_new(batch, name, as_of)
    return spark.table(name).where("station_name is null or station_name <> 'stored'")


@query
def insert_bucketed_daily(spark, sf):
    return _inserted_by_bucket(spark, sf, "daily").select("climate_id", *OBSERVED)


@query
def insert_bucketed_hourly(spark, sf):
    return rounded(_inserted_by_bucket(spark, sf, "hourly").select("climate_id", "ec_station_id", "datetime", "time", "temp"))


@query
def sql_station_months(spark, sf):
    """SQL text over registered tables, with the library's functions: monthly precipitation of stations within 500 km of a place."""
    folder, tag = _new_folder(spark, "registered"), uuid.uuid4().hex
    tables_io.write_observations(fx.daily(spark, sf), f"{folder}/daily", mode="overwrite")
    listed = fx.stations(spark, sf).withColumnsRenamed({"lat": "latitude_dd", "lon": "longitude_dd"})
    none = spark.createDataFrame([], schemas.STATION_SCHEMA)
    union_by_name(none, listed).select(none.columns).write.partitionBy("province").parquet(f"{folder}/stations")
    catalog.register(spark, f"daily_{tag}", f"{folder}/daily", "daily")
    catalog.register_stations(spark, f"stations_{tag}", f"{folder}/stations")
    catalog.register_functions(spark)
    return rounded(spark.sql(f"""
        select s.station_id, s.province, year_month(d.datetime) as month, min(day_index(d.datetime)) as first_index,
               sum(d.total_precip) as total_precip, max(station_distance(s.latitude_dd, s.longitude_dd, 52d, -130d)) as distance
        from daily_{tag} d join stations_{tag} s on s.station_id = d.ec_station_id
        where d.datetime between date'1996-02-01' and date'1997-12-31' and d.obs_year between 1996 and 1997
          and station_distance(s.latitude_dd, s.longitude_dd, 52d, -130d) < 500000
        group by s.station_id, s.province, year_month(d.datetime)"""))


@query
def rep_year_updated(spark, sf):
    """Representative years kept up through three inserts that overlap, by the sums of the inserted rows alone."""
    out = _new_folder(spark, "kept-up")
    daily = written(fx.daily(spark, sf), "daily", f"{out}/arriving")
    for run, before in enumerate(("1997-01-01", "1999-06-01", "2100-01-01")):
        tables.incremental_insert(daily, f"{out}/daily", "daily", before, then=lambda new, run=run: gapfill_jobs.add_to_sums(new, out, str(run)))
        gapfill_jobs.refresh_representative_years(spark, out)
    return rounded(spark.read.parquet(f"{out}/{gapfill_jobs.YEAR}"))


@query
def weights_updated(spark, sf):
    """Stored weights kept up through an insert of the later days of every seventh station."""
    out = _new_folder(spark, "kept-up")
    daily = written(fx.daily(spark, sf), "daily", f"{out}/arriving")
    listed = fx.stations(spark, sf).withColumnsRenamed({"lat": "latitude_dd", "lon": "longitude_dd"})
    none = spark.createDataFrame([], schemas.STATION_SCHEMA)
    union_by_name(none, listed).select(none.columns).write.partitionBy("province").parquet(f"{out}/station_metadata")
    some = F.col("ec_station_id").cast("int") % 7 == 3
    first = daily.where(~some | (F.col("datetime") < "2000-01-01"))
    tables.incremental_insert(first, f"{out}/daily", "daily", "2100-01-01")
    gapfill_jobs.rebuild_representative_years(spark, out)
    gapfill_jobs.rebuild_pairwise_weights(spark, out)
    tables.incremental_insert(daily, f"{out}/daily", "daily", "2100-01-01", then=lambda new: gapfill_jobs.add_to_sums(new, out, "later"))
    changed = spark.read.parquet(f"{out}/{gapfill_jobs.SUMS}/run=later").select(F.col("ec_station_id").alias("station_id")).distinct()
    gapfill_jobs.refresh_representative_years(spark, out)
    gapfill_jobs.refresh_pairwise_weights(spark, out, changed)
    return rounded(spark.read.parquet(f"{out}/{gapfill_jobs.WEIGHTS}").drop("part"))


@query
def stored_extremes(spark, sf):
    """First and last date of a stored table from the files' footers, and its years from its directories."""
    path = _new_folder(spark, "extremes")
    tables_io.write_observations(_with_undated(spark, sf), path, mode="overwrite")
    years = tables_io.years_stored(spark, path)
    return tables_io.date_extremes(spark, path).withColumns({"min_year": F.lit(years[0]), "max_year": F.lit(years[-1])})


@query
def named_records(spark, sf):
    """Filled records as files named by station and dates, read again with their names."""
    path = _new_folder(spark, "named")
    gapfill.write_named_records(_filled(spark, sf), path)
    return rounded(_read_named(spark, path, "ec_station_id string, datetime date, total_precip double, precip_intp_flag string"))


def _read_named(spark, path, columns):
    header = spark.read.option("header", True).csv(path)
    kinds = dict(x.split(" ") for x in columns.split(", "))
    return header.select(F.col("_metadata.file_name").alias("file"), *(F.col(c).cast(t).alias(c) for c, t in kinds.items()))


@query
def named_buckets(spark, sf):
    """Daily rows as files named by their bucket of five years, in three pieces each, read again with their names."""
    path = _new_folder(spark, "named")
    tables.write_named_buckets(fx.daily(spark, sf), path, "daily", 5, pieces=3, piece=F.col("ec_station_id").cast("int"))
    return _read_named(spark, path, "ec_station_id string, datetime date, total_precip double")


@query
def missing_delivered(spark, sf):
    """Planned daily and hourly files that are not among those on disk."""
    return coverage.missing_files(_planned("daily", "hourly")(spark, sf), observations.delivered_files(spark, _written_tree(spark, sf)))


def _bucketed(step):
    def run(spark, sf):
        return tables.with_year_bucket(fx.daily(spark, sf), step).select("ec_station_id", "datetime", "bucket")
    return run


for _step in (2, 3, 5, 10):
    QUERIES[f"year_bucket_{_step}"] = _bucketed(_step)


@query
def keep_newest_3(spark, sf):
    """Months play the snapshots."""
    daily = fx.daily(spark, sf).withColumn("snapshot_date", F.trunc("datetime", "month"))
    return tables.keep_newest(daily, "snapshot_date", 3).select("snapshot_date", *OBSERVED)


# --- stations and coverage -----------------------------------------------------------------------

@query
def province_codes(spark, sf):
    found = stations.with_province_code(fx.stations(spark, sf), fx.provinces(spark, sf))
    return found.select("station_id", "province", "code")


@query
def province_stations(spark, sf):
    found = stations.in_province(fx.stations(spark, sf), fx.provinces(spark, sf), "DD", "IE", "ID", "MC")
    return found.select("station_id", "province")


@query
def active_stations(spark, sf):
    active = stations.active_since(F.col("dly_last_year"), 2001)
    return fx.stations(spark, sf).select("station_id", active.alias("active"))


@query
def station_keys(spark, sf):
    return coverage.station_keys(fx.stations(spark, sf), fx.provinces(spark, sf))


@query
def select_stations(spark, sf):
    found = coverage.select_stations(fx.stations(spark, sf), SELECTORS, fx.provinces(spark, sf))
    return found.select("station_id", "name", "province", "tc_id")


@query
def select_all_stations(spark, sf):
    found = coverage.select_stations(fx.stations(spark, sf), ("7", "all"), fx.provinces(spark, sf))
    return found.select("station_id", "name", "province", "tc_id")


@query
def unmatched_selectors(spark, sf):
    return coverage.unmatched_selectors(fx.stations(spark, sf), SELECTORS, fx.provinces(spark, sf))


@query
def station_info(spark, sf):
    return coverage.station_info(fx.stations(spark, sf), SELECTORS, fx.provinces(spark, sf))


PERIODS = {
    "open": {},
    "start": {"start": "1996-05"},
    "end": {"end": "2000"},
    "range": {"start": "1985", "end": "1996-03"},
    "date": {"date": "2001-03"},
}


def _clipped(period):
    def run(spark, sf):
        return coverage.clip_period(fx.stations(spark, sf), coverage.KINDS, **period)
    return run


for _name, _period in PERIODS.items():
    QUERIES[f"clip_period_{_name}"] = _clipped(_period)


def _planned(*kinds, **period):
    def run(spark, sf):
        return coverage.expand_file_plan(coverage.clip_period(fx.stations(spark, sf), kinds, **period))
    return run


QUERIES["plan_daily"] = _planned("daily")
QUERIES["plan_hourly"] = _planned("hourly", start="1998-11")
QUERIES["plan_files"] = _planned(*coverage.KINDS, end="1999-08")


@query
def missing_files(spark, sf):
    """Months without a shipment of fifty units are months whose hourly file is missing."""
    day = F.col("l_shipdate")
    delivered = fx.table(spark, sf, "lineitem").where(F.col("l_quantity") == 50).select(
        F.col("l_suppkey").cast("string").alias("station_id"), F.lit("hourly").alias("kind"),
        F.year(day).alias("year"), F.month(day).alias("month"),
    )
    return coverage.missing_files(_planned("hourly")(spark, sf), delivered)


# --- raw text ------------------------------------------------------------------------------------

def _raw_numbers(spark, sf):
    whole = F.col("l_quantity").cast("int").cast("string")
    text = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("<"), whole))
        .when(F.col("l_returnflag") == "A", F.concat(whole, F.lit(".5")))
        .when(F.col("l_linestatus") == "O", F.when(F.col("l_linenumber") > 3, F.lit("M")).otherwise(F.lit("")))
        .otherwise(F.when(F.col("l_linenumber") > 3, F.lit("NA")))
    )
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("raw"))


@query
def strip_speed(spark, sf):
    return _raw_numbers(spark, sf).withColumn("speed", tx.number(tx.digits_only(F.col("raw"))))


@query
def strip_speed_strict(spark, sf):
    return _raw_numbers(spark, sf).withColumn("speed", tx.digits_only(F.col("raw"), keep_point=False))


@query
def to_typed(spark, sf):
    raw = F.col("raw")
    return _raw_numbers(spark, sf).select(
        "l_orderkey", "l_linenumber", tx.blank_to_null(raw).alias("text"),
        tx.number(raw).alias("real"), tx.number(raw, "int").alias("whole"),
    )


@query
def clean_names(spark, sf):
    header = F.concat(F.lit(" Stn. "), "p_brand", F.lit(" ("), "p_type", F.lit(") "), "p_name", F.lit(" Flag (%) "))
    return fx.table(spark, sf, "part").select("p_partkey", tx.clean_name(header).alias("column_name"))


@query
def matching_columns(spark, sf):
    """Every column whose name mentions a price or a balance, as whole units; columns in order A to Z."""
    customers = fx.table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = fx.table(spark, sf, "orders").join(customers, "o_custkey")
    orders = orders.select([c for c in orders.columns if dict(orders.dtypes)[c] not in ("timestamp", "timestamp_ntz")])
    changed = tx.transform_matching(orders, "PRICE|bal", lambda c: F.floor(c).cast("long"))
    return tx.sorted_columns(changed)


@query
def parse_dates(spark, sf):
    at, state = F.col("o_orderdate"), F.col("o_orderstatus")
    third = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(at, "yyyyMMdd")).otherwise(F.date_format(at, "dd.MM.yyyy"))
    day = F.when(state == "F", F.date_format(at, "yyyy-MM-dd")).when(state == "O", F.date_format(at, "yyyy/M/d")).otherwise(third)
    minute = F.when(state == "F", F.date_format(at, "yyyy-MM-dd HH:mm")).when(state == "O", F.date_format(at, "yyyy/M/d H:mm:ss")).otherwise(F.lit("noon"))
    month = F.when(state == "F", F.date_format(at, "yyyy")).when(state == "O", F.date_format(at, "yyyy-MM"))
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", cal.to_day(day).alias("day"), cal.to_minute(minute).alias("minute"),
        cal.to_month(F.coalesce(month, F.lit("199x"))).alias("month"),
    )


@query
def update_window(spark, sf):
    first, last = cal.update_window(F.col("o_orderdate").cast("date"))
    return fx.table(spark, sf, "orders").select("o_orderkey", first.alias("first_month"), last.alias("last_month"))


@query
def stack_tables(spark, sf):
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    lines = fx.table(spark, sf, "lineitem").select(F.col("l_tax").alias("tax"), F.col("l_orderkey").alias("id"))
    return union_by_name(orders, lines)


# --- raw files -----------------------------------------------------------------------------------

def daily_files(spark, sf):
    """One file per station and year, as (path, content); header order and columns change in 1998."""
    d = fx.daily(spark, sf)
    q = lambda *parts: F.concat(F.lit('"'), F.concat_ws('","', *parts), F.lit('"'))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    gust = F.concat(F.lit("<"), (F.col("day") + 30).cast("string"))
    old = q(F.col("station_name"), F.col("climate_id"), F.col("datetime").cast("string"), text("year"),
            text("month"), text("day"), text("total_precip"), gust, F.lit("E"))
    new = q(F.col("datetime").cast("string"), text("total_precip"), F.col("climate_id"), text("day"), text("month"),
            text("year"), F.col("station_name"), F.lit("NA"))
    old_header = ('"Station Name","Climate ID","Date/Time","Year","Month","Day","Total Precip (mm)",'
                  '"Spd of Max Gust (km/h)","Spd of Max Gust Flag"')
    new_header = '"Date/Time","Total Precip (mm)","Climate ID","Day","Month","Year","Station Name","Data Quality"'
    is_old = F.col("year") < 1998
    line = F.when(is_old, old).otherwise(new)
    # At most 366 lines of one station and year.
    files = d.groupBy("ec_station_id", "climate_id", "year").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    name = F.concat(F.lit("/raw/"), "ec_station_id", F.lit("/daily/en_climate_daily_"), "climate_id", F.lit("_"),
                    F.col("year").cast("string"), F.lit("_P1D.csv"))
    header = F.when(is_old, F.lit(old_header)).otherwise(F.lit("\ufeff" + new_header))
    return files.select(name.alias("path"), F.concat_ws("\n", header, F.concat_ws("\r\n", "lines")).alias("content"))


def hourly_files(spark, sf):
    """One file per station and month, as (path, content)."""
    h = fx.hourly(spark, sf)
    line = F.concat_ws(",", "climate_id", F.date_format("datetime", "yyyy-MM-dd HH:mm"), F.col("temp").cast("string"),
                       F.lit('"Rain,Fog"'), F.lit(""))
    # At most 744 lines of one station and month.
    files = h.groupBy("ec_station_id", "year", "month").agg(F.collect_list(line).alias("lines"))
    name = F.concat(F.lit("/raw/"), "ec_station_id", F.lit("/hourly/en_climate_hourly_"),
                    F.format_string("%02d-%d", "month", "year"), F.lit("_P1H.csv"))
    header = F.lit("Climate ID,Date/Time (LST),Temp (°C),Weather,Hmdx")
    return files.select(name.alias("path"), F.concat_ws("\n", header, F.concat_ws("\n", "lines")).alias("content"))


@query
def ingest_daily(spark, sf):
    parsed = observations.parse_files(daily_files(spark, sf), "daily")
    return rounded(parsed)


@query
def ingest_hourly(spark, sf):
    parsed = observations.parse_files(hourly_files(spark, sf), "hourly")
    return rounded(parsed)


def _tree(files, root):
    """Write files of (path, content) below ``root``, each under the path that it has."""
    def put(rows):
        import os

        top, made = "/" + root.removeprefix("file:").lstrip("/"), None
        for row in rows:
            place = f"{top}/{row.path.lstrip('/').removeprefix('raw/')}"
            if (folder := os.path.dirname(place)) != made:
                os.makedirs(folder, exist_ok=True)
                made = folder
            with open(place, "wb", buffering=0) as out:
                out.write(row.content.encode())

    files.foreachPartition(put)
    return root


def _written_tree(spark, sf, made=(daily_files, hourly_files)):
    """The raw files of both kinds, or of one, on disk: with preamble, byte order mark, and lines ended by CR."""
    root = f"{scratch_folder(spark)}/raw-{uuid.uuid4().hex}"
    odd, plain = F.crc32(F.col("path").cast("binary")) % 3, F.replace("content", F.lit("\ufeff"), F.lit(""))
    content = F.when(odd == 0, F.concat(F.lit("\ufeff"), plain)).when(
        odd == 1, F.concat(F.lit("made on some date/time\n\n"), plain)).otherwise(F.replace(plain, F.lit("\n"), F.lit("\r")))
    for files in made:
        _tree(files(spark, sf).withColumn("content", content), root)
    return root


@query
def ingest_tree_daily(spark, sf):
    return rounded(observations.read_observation_tree(spark, _written_tree(spark, sf, [daily_files]), "daily"))


@query
def ingest_tree_hourly(spark, sf):
    return rounded(observations.read_observation_tree(spark, _written_tree(spark, sf, [hourly_files]), "hourly"))


@query
def delivered_files(spark, sf):
    """Station, kind and period of the files on disk."""
    return observations.delivered_files(spark, _written_tree(spark, sf))


LISTED = ("name", "province", "climate_id", "station_id", "lat", "lon", "dly_first_year", "dly_last_year")


@query
def station_list(spark, sf):
    """The station list written as text with its preamble, read, stored by province, and read again."""
    folder = f"{scratch_folder(spark)}/stations-{uuid.uuid4().hex}"
    known = {"name": "name", "province": "province", "climate_id": "climate_id", "station_id": "station_id", "latitude_dd": "lat",
             "longitude_dd": "lon", "dly_first_year": "dly_first_year", "dly_last_year": "dly_last_year"}
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(known[f.name]).cast("string"), F.lit("")) if f.name in known else F.lit(""), F.lit('"'))
              for f in schemas.STATION_SCHEMA]
    data = fx.stations(spark, sf).select(F.concat_ws(",", *quoted).alias("value"))
    head = [("Modified Date: 2023-01-01",), ("",), ('"Disclaimers, one, two"',), (",".join(f.name for f in schemas.STATION_SCHEMA),)]
    spark.createDataFrame(head, "value string").unionByName(data).write.text(f"{folder}/list")
    backfill.write_station_tables(spark, f"{folder}/list", folder)
    kept = backfill.read_station_table(spark, folder)
    return rounded(kept.select(*(F.col(c).alias(a) for c, a in known.items())))


@query
def file_periods(spark, sf):
    """Station, year and month read from the names of the files."""
    path = F.col("path")
    days = daily_files(spark, sf).select(path, observations.year_in_name(path, "daily").alias("year"),
                                         F.lit(None).cast("int").alias("month"))
    hours = hourly_files(spark, sf).select(path, observations.year_in_name(path, "hourly").alias("year"),
                                           observations.month_in_name(path).alias("month"))
    return days.unionByName(hours).withColumn("ec_station_id", observations.station_in_path(path))
