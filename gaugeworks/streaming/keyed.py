"""The update job as a stream that remembers the keys it has seen.

:func:`gaugeworks.streaming.updates.insert_stream` compares every micro-batch with the stored rows of its range. Here the
keys lie in a keyed state store instead, as one sorted array for each bucket of stations and year (month, for hours), so a micro-batch
works on the arrays of what it brings and reads no stored row. The state starts with the keys that the table holds when the
checkpoint is new, and is versioned with the stream's own progress. No key is ever forgotten, so data may be as late as they like.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from gaugeworks.operators import tables as upkeep
from gaugeworks.session import file_system, ship_package, staged
from gaugeworks.sources import tables

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Buckets that climate ids are dealt to by a hash. It must stay what it is while a checkpoint is in use.
BUCKETS = 256
#: Bits of a key that tell its place in the span (31 days of microseconds fit); those above tell whose it is.
_PLACES = 42


class Unseen(StatefulProcessor):
    """Lets the rows of a group pass whose ``who_`` and ``at_`` no earlier micro-batch (nor the first state) had.

    A group's state is the names that it has met, each with a number of its own, and the sorted array of its keys.
    """

    def __init__(self, columns: list[str]) -> None:
        self.columns = columns

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "who array<string>, at binary")

    def _known(self) -> tuple[dict[str, int], np.ndarray]:
        who, at = self.seen.get() if self.seen.exists() else ((), b"")
        return {name: k for k, name in enumerate(who)}, np.frombuffer(at, np.int64)

    def _keep(self, who: dict[str, int], known: np.ndarray, at: list[np.ndarray]) -> None:
        self.seen.update((list(who), np.unique(np.concatenate([known, *at])).tobytes()))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803 (names of the interface)
        who, known = self._known()
        stored = [np.asarray(at, np.int64) | who.setdefault(name, len(who)) << _PLACES
                  for name, at in zip(initialState["who_"], initialState["stored_"], strict=True)]
        self._keep(who, known, stored)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        (who, known), new = self._known(), []
        for some in rows:
            place, names = pd.factorize(some["who_"])
            numbers = np.array([who.setdefault(name, len(who)) for name in names], np.int64)
            at = some["at_"].to_numpy(np.int64) | numbers[place] << _PLACES
            spot = np.searchsorted(known, at)
            fresh = np.append(known, -1)[spot] != at
            if fresh.any():
                new.append(np.unique(at[fresh]))
                yield some.loc[fresh, self.columns]
        if new:
            self._keep(who, known, new)

    def close(self) -> None:
        pass


def _keyed(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` with ``bucket_`` and ``span_``, which name a group, and ``who_`` and ``at_``, the row's key in it (names with an
    underscore in front do not reach the processor).

    A group is a bucket's year of days or month of hours, so that a call of the processor has many stations' rows to work on. Rows without
    a climate id are one another's equals, so their days are dealt to the buckets.
    """
    day = F.to_date("datetime")
    span = F.unix_date(F.trunc("datetime", "year" if kind == "daily" else "month"))
    at = (F.unix_date(day) - span).cast("long")
    if kind == "hourly":  # microseconds on the clock, whatever the session's zone
        second = (at * 24 + F.hour("datetime")) * 3600 + F.minute("datetime") * 60
        at = second * 1_000_000 + F.expr("cast(extract(second from datetime) * 1000000 as bigint)")
    none = F.col("climate_id").isNull()
    who = F.when(none, "").otherwise(F.concat(F.lit("="), "climate_id"))
    bucket = F.pmod(F.xxhash64(who, F.when(none, day)), F.lit(BUCKETS)).cast("int")
    return rows.withColumns({"bucket_": bucket, "span_": span, "who_": who, "at_": at})


def unseen(rows: DataFrame, stored: DataFrame, kind: str, as_of: dt.date | str | None = None) -> DataFrame:
    """The stream ``rows`` without those whose key an earlier micro-batch had, or ``stored`` when the stream first began.

    Rows from ``as_of`` on (the day on which the micro-batch runs, if not given) and undated ones are left out and not
    remembered. Several rows of one micro-batch with one new key all pass.
    """
    spark = rows.sparkSession
    ship_package(spark)
    day: Column = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    past = rows.where(F.col("datetime") < day.cast(rows.schema["datetime"].dataType))
    have = _keyed(stored.select("climate_id", "datetime").where("datetime is not null"), kind)
    first = have.groupBy("bucket_", "span_", "who_").agg(F.collect_set("at_").alias("stored_"))
    return _keyed(past, kind).groupBy("bucket_", "span_").transformWithStateInPandas(
        Unseen(rows.columns), rows.schema, "Append", "None", first.groupBy("bucket_", "span_"))


@contextmanager
def _state_on_disk(spark: SparkSession):
    """State lies in RocksDB; a stream keeps the setting of its start, so the session gets its own back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def insert_keyed_stream(
    rows: DataFrame, out: str, kind: str, checkpoint: str, as_of: dt.date | str | None = None, once: bool = False,
) -> StreamingQuery:
    """Start inserting a stream of observations into the table ``<out>/<kind>``, comparing keys with the state alone.

    The first micro-batch after each start may be one that had been written in part before a failure, so that one
    is compared with the stored rows of its range; all others are not. While the stream's checkpoint is in use nothing else
    may insert into the table. In the log ``batch_rows`` counts the rows that the state let pass.
    """
    spark, path = rows.sparkSession, f"{out}/{kind}"
    files, where = file_system(spark, path)
    if not files.exists(where):
        tables.create_table(spark, path, kind)
    started: list[int] = []

    def insert(batch: DataFrame, number: int) -> None:
        # Staged first: each action on the batch itself would run the state's step again.
        with staged(batch, f"batch-{kind}") as new:
            facts = upkeep.insert_rows(new, path, kind, compare=not started)
        started.append(number)
        run = f"{checkpoint}#{number}"
        upkeep.append_update_log(batch.sparkSession, f"{out}/update_log", facts, dt.datetime.now(), run)

    fresh = unseen(rows, tables.read_observations(spark, path, kind), kind, as_of)
    with _state_on_disk(spark):
        writer = fresh.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
