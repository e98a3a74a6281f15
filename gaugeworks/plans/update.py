"""Update: insert what the newest download adds, log the run, and keep a few snapshots."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import tables as upkeep
from gaugeworks.plans import gapfill
from gaugeworks.plans.backfill import write_station_tables
from gaugeworks.session import file_system, staged, written
from gaugeworks.sources import observations


def update(
    spark: SparkSession, raw: str, out: str, as_of: dt.date, station_list: str | None = None,
    kinds=("daily", "hourly"), keep_snapshots: int = 3, days_back: int | None = None,
    years: bool = False, weights: bool = False,
) -> list[dict[str, object]]:
    """Run one update and return its log rows. Running it again inserts nothing.

    ``days_back`` opens only files that by their names hold months from so many days ago up to ``as_of``; without it
    the whole tree is read. ``years`` keeps the representative years up with the daily table, from the inserted rows alone,
    and ``weights`` besides the stored weights that these years have a part in.
    """
    window = {}
    if days_back is not None:
        window = {"first": f"{as_of - dt.timedelta(days=days_back):%Y-%m}", "last": f"{as_of:%Y-%m}"}
    if station_list:
        write_station_tables(spark, station_list, out)
    rows, run = [], uuid.uuid4().hex
    for kind in kinds:
        parsed = observations.read_observation_tree(spark, raw, kind, **window)
        with staged(parsed, f"batch-{kind}") as batch:
            keep_up = (lambda new: gapfill.add_to_sums(new, out, run)) if kind == "daily" and (years or weights) else None
            facts = upkeep.incremental_insert(batch, f"{out}/{kind}", kind, as_of, stage=False, then=keep_up)
            upkeep.append_update_log(spark, f"{out}/update_log", facts, dt.datetime.now())
            if keep_snapshots:
                upkeep.archive_snapshot(batch, f"{out}/archive/{kind}", as_of, keep_snapshots)
        rows.append(facts)
    if (years or weights) and "daily" in kinds:
        files, where = file_system(spark, f"{out}/{gapfill.SUMS}/run={run}/_SUCCESS")
        changed = None
        if files.exists(where):
            added = spark.read.parquet(f"{out}/{gapfill.SUMS}/run={run}").select(F.col("ec_station_id").alias("station_id"))
            changed = written(added.distinct(), "changed-stations")
        gapfill.refresh_representative_years(spark, out)
        if weights and changed is not None:
            gapfill.refresh_pairwise_weights(spark, out, changed)
    return rows
