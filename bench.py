"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from gaugeworks.catalogue.queries import QUERIES
from gaugeworks.session import local_session

HEADLINE = (
    "rep_year", "completeness", "nearest_stations", "distance_weight", "pairwise_weights", "station_weights_top",
    "interpolate_precip", "range_scan_both", "insert_daily", "insert_hourly", "truncate_daily", "year_bucket_10",
    "keep_newest_3", "plan_files", "missing_files", "strip_speed", "parse_dates", "ingest_daily", "ingest_hourly",
    "delete_after_daily", "insert_bucketed_daily", "rep_year_updated", "stored_extremes", "named_buckets",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["rep_year"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
