"""Calendar parts, boundary-counting differences and look-back windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def _epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def boundaries_between(unit: str, start: Column, end: Column) -> Column:
    """How many ``unit`` boundaries lie between two timestamps (00:59 to 01:01 crosses two minutes)."""
    if unit == "day":
        return F.datediff(end.cast("date"), start.cast("date")).cast("long")
    width = _SECONDS[unit] * 1_000_000
    return F.floor(_epoch_micros(end) / width).cast("long") - F.floor(_epoch_micros(start) / width).cast("long")


def minutes_between(start: Column, end: Column) -> Column:
    return boundaries_between("minute", start, end)


def as_of_literal(as_of) -> Column:
    """A fixed "now" for reproducible runs, or the clock when none is given."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def within_days(day: Column, days: int, as_of=None) -> Column:
    """True for dates not older than ``days`` before ``as_of``."""
    return day >= F.date_sub(as_of_literal(as_of).cast("date"), days)


def within_hours(ts: Column, hours: int, as_of=None) -> Column:
    return ts >= as_of_literal(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")


def date_parts(day: Column) -> dict[str, Column]:
    """Parts of the date dimension."""
    return {
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "dayofweek": F.weekday(day) + 1,
        "dayofmonth": F.dayofmonth(day),
        "dayofyear": F.dayofyear(day),
        "dayofweekname": F.date_format(day, "EEE"),
        "isweekend": F.weekday(day) >= 5,
    }


def hierarchy_parts(day: Column) -> dict[str, Column]:
    """Year > quarter > month > day columns of a reporting calendar."""
    quarter_no = F.floor((F.month(day) + 2) / 3).cast("int")
    return {
        "year": F.year(day),
        "month_no": F.month(day),
        "month": F.date_format(day, "MMMM"),
        "quarter_no": quarter_no,
        "quarter": F.concat(F.lit("Qtr "), quarter_no.cast("string")),
        "day": F.dayofmonth(day),
    }


def bucket_date(unit: str, day: Column) -> Column:
    """First day of the month or (Monday-based) week."""
    return F.date_trunc(unit, day.cast("timestamp")).cast("date")


def chart_parts(day: Column, season: tuple[int, int] = (6, 11)) -> dict[str, Column]:
    """Year, month number, short month label and in-season flag for a monthly chart."""
    return {
        "year": F.year(day),
        "month_num": F.month(day),
        "label": F.date_format(day, "MMM"),
        "in_season": F.month(day).between(*season),
    }


def one_year_before(day: Column) -> Column:
    return F.add_months(day, -12)
