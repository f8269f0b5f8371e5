"""Dates and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Kolkata"


# Only text that begins like a year is cast: a failing try_cast builds an error object per row.
_YEAR_FIRST = r"^[+-]?[0-9]{4}"


def timestamp_from_text(c: Column) -> Column:
    """Blank or unreadable text gives NULL; callers report unreadable rows apart."""
    t = F.trim(c)
    return F.when(t.rlike(_YEAR_FIRST), t.try_cast("timestamp_ntz"))


def date_from_text(c: Column) -> Column:
    return timestamp_from_text(c).cast("date")


def two_digit_century(d: Column, pivot: int) -> Column:
    """Two-digit years from the pivot on belong to the 1900s."""
    return F.when(F.year(d) >= 2000 + pivot, F.add_months(d, -1200)).otherwise(d)


def date_day_first(c: Column) -> Column:
    """25/12/2024, 25-12-2024, 25.12.24; years 70..99 are in the 1900s."""
    dashed = F.regexp_replace(F.trim(c), r"[/.]", "-")
    short = two_digit_century(F.try_to_date(dashed, "d-M-yy"), 70)
    return F.when(dashed.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), F.try_to_date(dashed, "d-M-yyyy")).when(
        dashed.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$"), short
    )


def date_month_name(c: Column) -> Column:
    """5-jan-24; years 69..99 are in the 1900s."""
    shaped = F.when(c.rlike(r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{2}$"), c)
    return two_digit_century(F.try_to_date(shaped, "d-MMM-yy"), 69)


def weekday_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def attended_on(watched: Column, conducted: Column) -> Column:
    return F.coalesce(watched.cast("date"), conducted.cast("date"))


def as_day(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def is_active(end: Column, as_of: dt.date | None = None) -> Column:
    return F.coalesce(end >= as_day(as_of), F.lit(False))


def academic_year(as_of: dt.date | None = None) -> Column:
    """The academic year begins on 1 July."""
    day = as_day(as_of)
    return F.year(day) - F.when(F.month(day) < 7, 1).otherwise(0)


def start_year(year_of_study: Column, as_of: dt.date | None = None) -> Column:
    return (academic_year(as_of) - (year_of_study - 1)).cast("int")


def end_year(year_of_study: Column, duration: Column, as_of: dt.date | None = None) -> Column:
    return (start_year(year_of_study, as_of) + duration).cast("int")


def local_now(zone: str | Column = LOCAL_ZONE) -> Column:
    """Wall-clock time in the zone (of each row, if it is a column), whatever the session's zone is."""
    return F.convert_timezone(None, F.lit(zone), F.localtimestamp())


def has_fraction(ts: Column) -> Column:
    """True if the text form shows fractional seconds."""
    return ts.cast("string").rlike(r"\.[0-9]+")


def in_window(c: Column, start, end) -> Column:
    """Half-open: start is in, end is out."""
    return (c >= start) & (c < end)
