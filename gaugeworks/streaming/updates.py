"""The update job as a stream over the directory that downloads arrive in.

Each micro-batch of new files goes through the same insert-only step as the batch job. Late data
needs no watermark: a batch is compared with all stored rows of its own date range. A repeated
micro-batch inserts nothing, so a restart after a failure leaves no duplicates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.operators import tables as upkeep
from gaugeworks.sources import observations


def insert_stream(
    rows: DataFrame, out: str, kind: str, checkpoint: str, as_of: Callable[[], dt.date] = dt.date.today,
    once: bool = False,
) -> StreamingQuery:
    """Start inserting a stream of observations into the table ``<out>/<kind>``, logging each batch.

    ``once`` processes what is there and stops; otherwise the query keeps watching. A batch that is run again after a
    failure has one log row, named by the checkpoint and the batch.
    """
    def insert(batch: DataFrame, number: int) -> None:
        facts = upkeep.incremental_insert(batch, f"{out}/{kind}", kind, as_of())
        run = f"{checkpoint}#{number}"
        upkeep.append_update_log(batch.sparkSession, f"{out}/update_log", facts, dt.datetime.now(), run)

    writer = rows.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def stream_updates(
    spark: SparkSession, raw: str, out: str, kind: str, checkpoint: str,
    as_of: Callable[[], dt.date] = dt.date.today, files_per_batch: int = 10_000, once: bool = False,
) -> StreamingQuery:
    """Start inserting raw files of one kind as they appear below ``raw``."""
    files = (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", "*.csv").text(f"{raw}/*/{kind}", wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    )
    return insert_stream(observations.parse_files(files, kind), out, kind, checkpoint, as_of, once)
