"""Which stations are wanted, which periods they can deliver, and which files are still missing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import calendar as cal

# The four kinds of files, and the prefix of their first/last-year columns.
AVAILABILITY = {"monthly": "mly", "daily": "dly", "hourly": "hly"}
KINDS = ("monthly", "daily", "hourly", "climate")
EVERYTHING = "all"


def station_keys(stations: DataFrame, provinces: DataFrame) -> DataFrame:
    """Every name a station answers to, one row each: (kind, key, station_id).

    Kinds are ``station`` (its id), ``airport`` (a three-letter code) and ``province`` (a code).
    """
    with_code = stations.join(provinces.select("province", "code"), "province", "left")
    names = F.array(
        F.struct(F.lit("station").alias("kind"), F.col("station_id").alias("key")),
        F.struct(F.lit("airport").alias("kind"), F.when(F.length("tc_id") == 3, F.col("tc_id")).alias("key")),
        F.struct(F.lit("province").alias("kind"), F.col("code").alias("key")),
    )
    return with_code.select("station_id", F.inline(names)).where(F.col("key").isNotNull())


def _kind(selector: str) -> str:
    """Which kind of name a selector is, by its shape."""
    if len(selector) == 3 and selector.isalpha():
        return "airport"
    if selector.isdigit():
        return "station"
    return "province" if len(selector) == 2 else "invalid"


def select_stations(stations: DataFrame, selectors: Iterable[str], provinces: DataFrame) -> DataFrame:
    """Stations named by any selector, each once. ``all`` (lower case) means every station.

    The selectors are the caller's short list and become a filter on the station table.
    """
    wanted = set(selectors)
    if EVERYTHING in wanted:
        return stations
    named = {kind: [s for s in wanted if _kind(s) == kind] for kind in ("station", "airport", "province")}
    coded = stations.join(provinces.select("province", "code"), "province", "left")
    keep = (
        F.col("station_id").isin(named["station"])
        | ((F.length("tc_id") == 3) & F.col("tc_id").isin(named["airport"]))
        | F.col("code").isin(named["province"])
    )
    return coded.where(keep).select(*stations.columns)


def unmatched_selectors(stations: DataFrame, selectors: Iterable[str], provinces: DataFrame) -> DataFrame:
    """Selectors that name no station, with the kind of name they look like."""
    wanted = list(dict.fromkeys(selectors))
    rows = [] if EVERYTHING in wanted else [(s, _kind(s)) for s in wanted]
    table = stations.sparkSession.createDataFrame(rows, "selector string, kind string")
    keys = station_keys(stations, provinces).where(F.col("key").isin(wanted))
    return table.join(keys.select("kind", F.col("key").alias("selector")), ["selector", "kind"], "left_anti")


def station_info(stations: DataFrame, selectors: Iterable[str], provinces: DataFrame) -> DataFrame:
    """All fields of the selected stations as (station_id, field, value) rows."""
    chosen = select_stations(stations, selectors, provinces)
    fields = F.array(*(
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in stations.columns
    ))
    return chosen.select("station_id", F.inline(fields))


def _interval(
    first: Column, last: Column, date: dt.date | None, start: dt.date | None, end: dt.date | None
) -> tuple[Column, Column, Column]:
    """(keep, from, to) for availability ``first``..``last`` and the requested period.

    Open ends follow availability. A period given by both ends is taken as it is as soon as it
    touches availability.
    """
    if date:
        return F.lit(date).between(first, last), F.lit(date), F.lit(date)
    keep = F.lit(True)
    if start:
        keep = keep & (F.lit(start) <= last)
    if end:
        keep = keep & (F.lit(end) >= first)
    if start and end:
        return keep, F.lit(start), F.lit(end)
    since = F.when(first > F.lit(start), first).otherwise(F.lit(start)) if start else first
    until = F.when(last < F.lit(end), last).otherwise(F.lit(end)) if end else last
    return keep, since, until


def clip_period(
    stations: DataFrame,
    kinds: Iterable[str] = ("daily",),
    date: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """What each station can deliver of the requested period: (station_id, kind, first_month, last_month).

    Months are ``yyyy-MM``. A station without availability for a kind has no row for it. Climate
    summaries have no period and are always expected.
    """
    period = cal.requested_period(date, start, end)
    parts = []
    for kind in kinds:
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}")
        if kind == "climate":
            keep, since, until = F.lit(True), F.lit(None).cast("date"), F.lit(None).cast("date")
        else:
            years = (F.col(f"{AVAILABILITY[kind]}_{edge}_year") for edge in ("first", "last"))
            first, last = (F.make_date(y, F.lit(m), F.lit(1)) for y, m in zip(years, (1, 12)))
            keep, since, until = _interval(first, last, *period)
            keep = keep & first.isNotNull() & last.isNotNull()
        row = F.struct(
            F.lit(kind).alias("kind"),
            cal.month_text(since).alias("first_month"),
            cal.month_text(until).alias("last_month"),
        )
        parts.append(F.when(keep, row))
    return stations.select("station_id", F.inline(F.array_compact(F.array(*parts))))


def expand_file_plan(periods: DataFrame) -> DataFrame:
    """The files that cover each period: (station_id, kind, year, month).

    One per year for daily, one per month for hourly, and a single one (no year or month) for monthly
    and climate.
    """
    month = F.lit(12) * F.left("first_month", F.lit(4)).cast("int") + F.right("first_month", F.lit(2)).cast("int") - 1
    until = F.lit(12) * F.left("last_month", F.lit(4)).cast("int") + F.right("last_month", F.lit(2)).cast("int") - 1
    none = F.lit(None).cast("int")
    year_of = lambda m: F.floor(m / 12).cast("int")
    steps = (
        F.when((F.col("kind") == "daily") & (year_of(month) <= year_of(until)),
               F.transform(F.sequence(year_of(month), year_of(until)),
                           lambda y: F.struct(y.alias("year"), none.alias("month"))))
        .when((F.col("kind") == "hourly") & (month <= until),
              F.transform(F.sequence(month, until),
                          lambda m: F.struct(year_of(m).alias("year"), (F.pmod(m, F.lit(12)) + 1).alias("month"))))
        .when(F.col("kind").isin("monthly", "climate"),
              F.array(F.struct(none.alias("year"), none.alias("month"))))
    )
    return periods.select("station_id", "kind", F.inline(steps))


def missing_files(plan: DataFrame, delivered: DataFrame) -> DataFrame:
    """Planned files not among the delivered ones; NULL year and month match each other."""
    keys = ("station_id", "kind", "year", "month")
    have = delivered.select(*(F.col(k).alias(f"_have_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_have_{k}")) for k in keys))
    return plan.join(have, same, "left_anti")
