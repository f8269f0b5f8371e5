"""Small helpers on key columns shared by the other operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def may_be_null(df: DataFrame, keys: list[str]) -> bool:
    return any(df.schema[k].nullable for k in keys)


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in pairs])
