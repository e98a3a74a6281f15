"""Dates, periods and year buckets."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAP_DAY = "2-29"
SLOTS = 365


# Year, month and day, parted by ``-`` or ``/`` (then months and days may have one digit) or by nothing.
_DAY = r"(?:(\d{4})[-/](\d{1,2})[-/](\d{1,2})|(\d{4})(\d{2})(\d{2}))"
_TIME = r"[ T]+(\d{1,2}):(\d{2})(?::\d{2}(?:\.\d+)?)?"


def to_day(text: Column) -> Column:
    """A date written year first (``2001-03-09``, ``2001/3/9``, ``20010309``); anything else is NULL."""
    plain = F.regexp_replace(F.trim(text), f"^{_DAY}$", "$1$4-$2$5-$3$6")
    return F.when(F.trim(text).rlike(f"^{_DAY}$"), plain.try_cast("date"))


def to_minute(text: Column) -> Column:
    """A date as in :func:`to_day` with hours and minutes, as a wall-clock timestamp; seconds are left out."""
    plain = F.regexp_replace(F.trim(text), f"^{_DAY}{_TIME}$", "$1$4-$2$5-$3$6 $7:$8")
    return F.when(F.trim(text).rlike(f"^{_DAY}{_TIME}$"), plain.try_cast("timestamp_ntz"))


def to_month(text: Column) -> Column:
    """``YYYY`` or ``YYYY-MM`` text to the first day it names; anything else is NULL."""
    year = F.when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01")))
    month = F.when(text.rlike(r"^\d{4}-\d{2}$"), F.concat(text, F.lit("-01")))
    return F.coalesce(year, month).try_cast("date")


def month_day(month: Column | str, day: Column | str) -> Column:
    """Calendar day without the year, unpadded: ``2-29``. A missing part gives NULL."""
    text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.concat(text(month), F.lit("-"), text(day))


def slot_of(index: Column) -> Column:
    """Position 0..364 of a ``M-D`` day in a common year."""
    before = F.array(*(F.lit(dt.date(2001, m, 1).timetuple().tm_yday - 1) for m in range(1, 13)))
    month, day = F.substring_index(index, "-", 1), F.substring_index(index, "-", -1)
    return F.get(before, month.cast("int") - 1) + day.cast("int") - 1


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def update_window(as_of: Column, days_back: int = 31) -> tuple[Column, Column]:
    """Default months to fetch in an update: from ``days_back`` days ago to ``as_of``."""
    return month_text(F.date_sub(as_of, days_back)), month_text(as_of)


def year_bucket(year: Column, lo: int, hi: int, step: int) -> Column:
    """Label ``from-to`` of the year's bucket when [lo, hi] is cut into ``step``-year pieces from the top.

    The newest bucket contains ``hi``; every other one ends just before its ``to``. A remainder too
    short for its own bucket joins the oldest one.
    """
    oldest = max(math.ceil((hi - lo + 1) / step) - 2, 0)
    back = F.greatest(F.lit(0), F.ceil((F.lit(hi) - year) / F.lit(step)).cast("int") - 1)
    k = F.least(back, F.lit(oldest))
    start = F.when(k == oldest, F.lit(lo)).otherwise(F.lit(hi) - F.lit(step) * (k + 1))
    label = F.concat_ws("-", start.cast("string"), (F.lit(hi) - F.lit(step) * k).cast("string"))
    return F.when(year.between(lo, hi), label)


def parse_month(text: str) -> dt.date:
    """Argument form of :func:`to_month`; raises ``ValueError`` for other shapes."""
    shapes = {4: "%Y", 7: "%Y-%m"}
    if len(text) not in shapes:
        raise ValueError(f"expected YYYY or YYYY-MM, got {text!r}")
    return dt.datetime.strptime(text, shapes[len(text)]).date()


def requested_period(
    date: str | None = None, start: str | None = None, end: str | None = None
) -> tuple[dt.date | None, dt.date | None, dt.date | None]:
    """Check the period arguments and bring them to one precision.

    A single ``date`` wins over ``start`` and ``end``. When only ``start`` names a month, ``end``
    runs to December of its year.
    """
    if date is not None:
        return parse_month(date), None, None
    first = parse_month(start) if start is not None else None
    last = parse_month(end) if end is not None else None
    if first and last:
        if first > last:
            raise ValueError(f"start {start} is after end {end}")
        if len(start) > len(end):
            last = last.replace(month=12)
    return None, first, last
