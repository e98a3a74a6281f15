"""The jobs from the command line, under ``spark-submit`` or plain Python:

    python -m gaugeworks backfill --raw RAW --out OUT --stations LIST.csv --maxdate 2023-01
    python -m gaugeworks update   --raw RAW --out OUT --stations LIST.csv [--days-back 31] [--years] [--weights]
    python -m gaugeworks truncate --out OUT --maxdate 2023-01 [--kind daily]
    python -m gaugeworks weights  --out OUT [--station 123 ...] [--active-since 2022]
    python -m gaugeworks fill     --out OUT --start 2020-01-01 --end 2020-12-31 --to FILLED [--station 123 ...] [--by ec_station_id | --named]
    python -m gaugeworks gaps     --out OUT --raw RAW --to GAPS --kind daily --kind hourly [--start 2023-01] [--end 2023-06] BC YVR 123
    python -m gaugeworks buckets  --out OUT --to CSV --kind daily [--step 10] [--pieces 16]

``--lang fr`` goes with a French station list. Intermediate tables are removed when a job ends.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from gaugeworks import schemas
from gaugeworks.operators import coverage
from gaugeworks.operators.gapfill import write_interpolated, write_named_records
from gaugeworks.operators.tables import write_named_buckets, write_year_buckets
from gaugeworks.plans import backfill, gapfill, update
from gaugeworks.session import clear_scratch
from gaugeworks.sources.observations import delivered_files
from gaugeworks.sources.tables import PARTITION, read_observations, years_stored

# Years of one piece of the bucketed output.
BUCKET_YEARS = {"daily": 10, "hourly": 5}


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gaugeworks")
    parser.add_argument("job", choices=["backfill", "update", "truncate", "weights", "fill", "gaps", "buckets"])
    parser.add_argument("selectors", nargs="*", help="stations, airports or provinces, or all")
    for name in ("raw", "out", "stations", "to", "date", "start", "end"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--maxdate", default=str(dt.date.today()))
    parser.add_argument("--kind", action="append", choices=coverage.KINDS)
    parser.add_argument("--station", action="append")
    parser.add_argument("--all-weights", action="store_true", help="fill by weights over all stations, not the stored ones")
    parser.add_argument("--named", action="store_true", help="one file per station, named by its days")
    parser.add_argument("--weights", action="store_true", help="keep the stored weights up with the update, too")
    parser.add_argument("--years", action="store_true", help="keep the representative years up with the update")
    parser.add_argument("--by", default=PARTITION, help="column by which filled records are stored")
    parser.add_argument("--lang", default="en", choices=["en", "fr"])
    for name in ("days-back", "active-since", "step", "pieces"):
        parser.add_argument(f"--{name}", type=int)
    args = parser.parse_intermixed_args(argv)
    if args.job in ("fill", "gaps", "buckets") and not args.to:
        parser.error(f"{args.job} needs --to")
    return args


def _targets(spark: SparkSession, args: argparse.Namespace):
    """Stations named one by one or still active; None for all."""
    if args.station:
        return spark.createDataFrame([(s,) for s in args.station], "station_id string")
    return gapfill.active_stations(spark, args.out, args.active_since) if args.active_since else None


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    try:
        _run(spark, args)
    finally:
        clear_scratch(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "backfill":
        backfill.write_station_tables(spark, args.stations, args.out)
        backfill.backfill(spark, args.raw, args.out, args.maxdate)
    elif args.job == "update":
        for row in update.update(spark, args.raw, args.out, dt.date.today(), args.stations, days_back=args.days_back, years=args.years, weights=args.weights):
            print(row)
    elif args.job == "truncate":
        for row in backfill.truncate(spark, args.out, args.maxdate, args.kind or ("daily", "hourly")):
            print(row)
    elif args.job == "weights":
        gapfill.rebuild_representative_years(spark, args.out)
        gapfill.rebuild_pairwise_weights(spark, args.out, _targets(spark, args))
    elif args.job == "fill":
        filled = gapfill.fill(spark, args.out, _targets(spark, args), args.start, args.end, not args.all_weights)
        if args.named:
            write_named_records(filled, args.to)
        else:
            write_interpolated(filled, args.to, args.by)
    elif args.job == "buckets":
        for kind in args.kind or ("daily",):
            table = read_observations(spark, f"{args.out}/{kind}", kind)
            years = years_stored(spark, f"{args.out}/{kind}") or [None]
            span, step = (years[0], years[-1]), args.step or BUCKET_YEARS[kind]
            if args.pieces:
                write_named_buckets(table, f"{args.to}/{kind}", kind, step, PARTITION, span, args.pieces)
            else:
                write_year_buckets(table, f"{args.to}/{kind}", step, PARTITION, span)
    else:
        listed, provinces = backfill.read_station_table(spark, args.out), schemas.provinces(spark, args.lang)
        for row in coverage.unmatched_selectors(listed, args.selectors, provinces).collect():  # of the command line
            print(f"no station for {row.selector} ({row.kind})")
        chosen = coverage.select_stations(listed, args.selectors or ["all"], provinces)
        periods = coverage.clip_period(chosen, args.kind or ("daily", "hourly"), args.date, args.start, args.end)
        gaps = coverage.missing_files(coverage.expand_file_plan(periods), delivered_files(spark, args.raw))
        gaps.write.mode("overwrite").csv(args.to, header=True)


if __name__ == "__main__":
    run(SparkSession.builder.appName("gaugeworks").getOrCreate(), arguments())
