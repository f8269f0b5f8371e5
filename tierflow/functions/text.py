"""Text predicates, normalisers and code builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(c: Column) -> Column:
    """Lower case without surrounding spaces; tabs and line breaks stay."""
    return F.lower(F.trim(c))


def stripped(c: Column) -> Column:
    """Without surrounding whitespace of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def null_if_token(c: Column, tokens: tuple[str, ...] = ("NaN", "nan", "")) -> Column:
    return F.when(~c.isin(*tokens), c)


def has_prefix(c: Column, prefixes: list[str]) -> Column:
    """True if the text starts with any prefix; each test reaches the Parquet scan."""
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])


def is_filled(c: Column, blank_word: str = "NaN") -> Column:
    """Neither blank nor the blank word; NULL stays NULL, so a filter drops it."""
    t = F.trim(c)
    return (t != "") & (t != blank_word)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def is_untrimmed(c: Column) -> Column:
    return c != F.trim(c)


def zero_padded(c: Column, width: int) -> Column:
    """Pad with zeros after a sign, never shorten."""
    sign = F.regexp_extract(c, r"^[+-]", 0)
    digits = F.regexp_replace(c, r"^[+-]", "")
    padded = F.concat(sign, F.lpad(digits, F.lit(width) - F.length(sign), F.lit("0")))
    return F.when(F.length(c) < width, padded).otherwise(c)


# Programme names with their own code prefix; other names give their first three letters.
PROGRAMME_PREFIXES = {"incubator": "INC", "accelerator": "ACC"}


def cohort_code_from_label(label: Column) -> Column:
    """'Incubator 7.0' -> 'INC007'; anything but two words gives NULL."""
    words = F.split(stripped(label), r"(?U)\s+")
    programme, number = F.element_at(words, 1), F.element_at(words, 2)
    prefix = F.upper(F.left(programme, F.lit(3)))
    for name, code in PROGRAMME_PREFIXES.items():
        prefix = F.when(F.lower(programme) == name, code).otherwise(prefix)
    code = F.concat(prefix, zero_padded(F.replace(number, F.lit(".0"), F.lit("")), 3))
    return F.when(F.size(words) == 2, code)


def cohort_code(prefix: Column, number: Column) -> Column:
    """Prefix and the last three digits of the zero-filled number."""
    return F.concat(prefix, F.right(F.concat(F.lit("000"), number.cast("string")), F.lit(3)))


def student_code(start: Column, cohort: Column, student_id: Column) -> Column:
    """Two-digit start year, cohort and seven-digit id; NULL if any part is NULL."""
    year = F.right(F.year(start).cast("string"), F.lit(2))
    return F.concat(year, cohort, F.lpad(student_id.cast("string"), 7, "0"))


def leader_flag(role: Column) -> Column:
    return F.coalesce(F.ilike(role, F.lit("%student leader%")), F.lit(False))


def first_name(full: Column) -> Column:
    dotted = F.trim(F.split_part(full, F.lit("."), F.lit(2)))
    spaced = F.trim(F.regexp_replace(full, r"\s+\S+\z", ""))
    return F.when(full.contains("."), dotted).otherwise(spaced)


def last_name(full: Column) -> Column:
    dotted = F.split_part(full, F.lit("."), F.lit(1))
    return F.when(full.contains("."), dotted).otherwise(F.split_part(full, F.lit(" "), F.lit(-1)))


def synthetic_email(student_id: Column, domain: str) -> Column:
    return F.concat(student_id.cast("string"), F.lit(f"@{domain}"))


def cut(c: Column, n: int) -> Column:
    """Text cast to at most n characters by cutting, where a Spark varchar cast keeps them all."""
    return F.left(c.cast("string"), F.lit(n))


def split_list(c: Column, separator: str = ",") -> Column:
    """Text split at a literal separator; an empty text has no elements."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, f"\\Q{separator}\\E"))
