"""Broadcast of look-up sides whose size was measured.

Spark multiplies the sizes of joined inputs when it estimates a join, so a look-up made of two small
tables looks large and would shuffle the fact table. Measuring it costs one small job over the
look-up, never over the facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
_FIXED_BYTES = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values: text by its length, nested values by their text form, others flat."""

    def width(name: str, dtype: str) -> Column:
        c = F.col(f"`{name}`")
        if dtype == "string" or "<" in dtype:
            return F.coalesce(F.octet_length(c.cast("string")), F.lit(0)) + _FIXED_BYTES
        return F.lit(_FIXED_BYTES)

    total = reduce(lambda a, b: a + b, [width(n, d) for n, d in df.dtypes])
    return df.agg(F.coalesce(F.sum(total.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a look-up for broadcast if it measures at most ``limit`` bytes; else Spark decides."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df
