"""Date/time parts with the semantics the business questions rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _c(col):
    return F.col(col) if isinstance(col, str) else col


def minute_of_day(ts: str | Column) -> Column:
    t = _c(ts)
    return F.hour(t) * 60 + F.minute(t)


def boundary_minutes(start: str | Column, end: str | Column) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    18:05:02 -> 18:15:01 gives 10 (not the 9 whole minutes that elapsed).
    Built from the calendar date and the hour/minute fields, so a zone-free
    timestamp is never converted through the session time zone (which would
    shift intervals that cross a daylight-saving change).
    """
    days = F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))
    return (days.cast("bigint") * 1440 + minute_of_day(end) - minute_of_day(start)).cast("bigint")


def us_week(d: str | Column) -> Column:
    """Week of year where week 1 holds 1 January and weeks start on Sunday."""
    d = _c(d).cast("date")
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1).cast("int")


def anchored_week(d: str | Column, anchor: str) -> Column:
    """1-based number of the 7-day period starting at ``anchor`` (a date literal)."""
    return (F.floor(F.datediff(_c(d).cast("date"), F.lit(anchor).cast("date")) / 7) + 1).cast("int")


# English day names, Sunday first (dayofweek numbering).
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekday_name(ts: str | Column) -> Column:
    """English day name of the calendar date (zone-free for local timestamps)."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.dayofweek(F.to_date(_c(ts))))


def month_end(d: str | Column) -> Column:
    return F.last_day(_c(d).cast("date"))


def seconds(ts: str) -> Column:
    """Whole seconds since 1970 of a local timestamp, without the session zone."""
    return (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))
