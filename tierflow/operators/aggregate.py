"""Aggregates of the reporting and profile steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the text of one group's list, beyond which the list is a job of its own design, not a cell.
LIST_BYTES = 256 << 20


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def max_where(condition: Column, value: Column) -> Column:
    return F.max(F.when(condition, value))


def joined_distinct(value: Column, separator: str = ", ") -> Column:
    """Sorted distinct values as one text; without any value NULL.

    The set is reduced inside each map task, so only distinct values of a group travel.
    """
    values = F.array_sort(F.collect_set(value.cast("string")))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def distinct_array(value: Column) -> Column:
    """Sorted distinct values as an array; one NULL stays at the end if any value was NULL."""
    values = F.array_sort(F.collect_set(value))
    return F.when(F.bool_or(value.isNull()), F.array_append(values, None)).otherwise(values)


def sorted_lists(df: DataFrame, keys: list[str], value: str, name: str, separator: str | None = ", ", limit: int = LIST_BYTES) -> DataFrame:
    """Sorted distinct values of each group, as one text or (``separator=None``) as an array, where a group may be very large.

    Distinct (group, value) pairs are dealt by both, so a hot group spreads over tasks. They are then sorted over all tasks: what a
    group has in one range partition is a sorted run, listed there, and the group's task only joins its runs, one row for each partition,
    in their order. NULL groups are groups; NULL values are left out, and a group with no other has NULL.
    A list of more than ``limit`` bytes fits no row and fails the job with its group named; take the distinct pairs as rows then.
    """
    text = separator is not None
    held = df.select(*keys, (F.col(value).cast("string") if text else F.col(value)).alias("_value")).distinct()
    ranged = held.repartitionByRange(*keys, "_value").sortWithinPartitions(*keys, "_value")
    runs = ranged.select("*", F.spark_partition_id().alias("_run")).groupBy(*keys, "_run").agg(
        F.array_sort(F.collect_list("_value")).alias("_values"), F.sum(F.octet_length(F.col("_value").cast("string")) + 4).alias("_bytes")
    )
    size = runs.select(*keys, "_run", "_bytes", (F.when(F.size("_values") > 0, F.array_join("_values", separator)) if text else F.col("_values")).alias("_part"))
    grouped = size.groupBy(*keys).agg(F.sum("_bytes").alias("_bytes"), F.array_sort(F.collect_list(F.struct("_run", "_part"))).alias("_runs"))
    parts = F.filter(F.transform("_runs", lambda r: r["_part"]), lambda p: p.isNotNull())
    joined = F.when(F.size(parts) > 0, F.array_join(parts, separator)) if text else F.flatten(parts)
    message = F.concat(F.lit("a list fits no row: group "), F.to_json(F.struct(*keys)))
    whole = F.when(F.col("_bytes") > limit, F.raise_error(message).cast("string" if text else df.select(F.array(value)).schema[0].dataType)).otherwise(joined)
    return grouped.select(*keys, whole.alias(name))
