"""Casts, marks and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Percentage marks per submission status; any other status gives 0.
STATUS_MARKS = {"under review": 30, "reviewed": 100, "rejected": 80}


# Text that is a number, and integers that fit without looking at their value. Casts run only on text
# known to fit: a failing try_cast builds an error object per row.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_SHORT_INTEGER = r"^[+-]?[0-9]{1,9}$"
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def int_from_double(c: Column) -> Column:
    """Half-even, as the SQL database rounds a double; out of range gives NULL."""
    rounded = F.bround(c, 0)
    return F.when(rounded.between(_INT_MIN, _INT_MAX), rounded.cast("int"))


def is_short_integer(c: Column) -> Column:
    return F.trim(c).rlike(_SHORT_INTEGER)


def int_from_text(c: Column) -> Column:
    """A number as an integer, '12.5' rounded like a double; other text gives NULL."""
    t = F.trim(c)
    return F.when(t.rlike(_SHORT_INTEGER), t.cast("int")).when(t.rlike(_NUMBER), int_from_double(t.cast("double")))


def int_from_decimal(c: Column) -> Column:
    """Half away from zero, as the SQL database rounds a numeric."""
    return F.round(c, 0).cast("int")


def marks_for_status(status: Column) -> Column:
    marks = F.lit(0)
    for value, mark in STATUS_MARKS.items():
        marks = F.when(status == value, mark).otherwise(marks)
    return marks.cast("decimal(10,0)")


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; NULL where the whole is 0."""
    exact = part.cast("decimal(20,0)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)") * 100
    return F.round(exact, 2).cast("decimal(12,2)")


def repeat_count(submissions: Column) -> Column:
    return F.greatest(submissions - 1, F.lit(0))


def repeat_pct(submissions: Column) -> Column:
    """Share of submissions after the first; 0 with none or one."""
    return F.when(submissions > 1, share_pct(submissions - 1, submissions)).otherwise(
        F.lit(0).cast("decimal(12,2)")
    )


def year_of_study(text: Column, duration: Column) -> Column:
    """Digits in the text, 1 without any, at most the course duration."""
    digits = F.nullif(F.regexp_replace(text, r"[^0-9]", ""), F.lit(""))
    # More digits than a decimal holds are more than any duration: leading zeros aside, the cap applies.
    number = F.coalesce(F.ltrim(digits, F.lit("0")), F.lit("1"))
    value = F.when(F.length(number) > 38, duration).otherwise(F.coalesce(F.nullif(number, F.lit("")), F.lit("0")).cast("decimal(38,0)"))
    return F.least(value, duration.cast("decimal(38,0)")).cast("int")
