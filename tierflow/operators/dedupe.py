"""Duplicate reports and removal.

``order_by`` names columns that give a total order; the reference point is an explicit sequence
column set at ingest, never the physical position of a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keyspace import any_null, may_be_null


class DuplicateKeys(ValueError):
    """Raised when keys that must be unique are not."""


def _one_per_key(df: DataFrame, keys: list[str], order_by: list[str], last: bool) -> DataFrame:
    # row_number() = 1 is cut to one row per key inside each map task before the shuffle
    # (WindowGroupLimit in the plan), so a key with a third of all rows stays cheap.
    order = [F.col(c).desc() if last else F.col(c).asc() for c in order_by]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _dedupe(df: DataFrame, keys: list[str], order_by: list[str], null_keys: str, last: bool) -> DataFrame:
    if null_keys not in ("distinct", "equal"):
        raise ValueError(f"null_keys must be 'distinct' or 'equal', not {null_keys!r}")
    if null_keys == "equal" or not may_be_null(df, keys):
        return _one_per_key(df, keys, order_by, last)
    # Rows with a NULL key equal nothing: they skip the shuffle and all stay.
    return _one_per_key(df.filter(~any_null(keys)), keys, order_by, last).unionByName(df.filter(any_null(keys)))


def dedupe_keep_last(
    df: DataFrame, keys: list[str], order_by: list[str], null_keys: str = "distinct"
) -> DataFrame:
    """Keep the last row of each key; by default rows with a NULL key are never duplicates."""
    return _dedupe(df, keys, order_by, null_keys, last=True)


def dedupe_keep_first(
    df: DataFrame, keys: list[str], order_by: list[str], null_keys: str = "equal"
) -> DataFrame:
    """Keep the first row of each key; by default NULL keys equal each other."""
    return _dedupe(df, keys, order_by, null_keys, last=False)


def top_rows(df: DataFrame, keys: list[str], order_by: list, n: int, parts: int = 64, spread_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows of each key in a total order, in two levels, so that no key's rows meet in one task.

    Rows of a key are dealt into ``parts`` by a hash (of ``spread_by``, or of all columns); each part gives its first ``n``, and
    of these the key's first ``n`` are taken: a task reads at most ``n * parts`` rows of a key however many there are. NULL is a key.
    """
    part = F.pmod(F.xxhash64(*(spread_by or df.columns)), F.lit(parts)).alias("_part")
    within = Window.partitionBy(*keys, "_part").orderBy(*order_by)
    some = df.select("*", part).withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= n)
    over_all = Window.partitionBy(*keys).orderBy(*order_by)
    return some.withColumn("_rank", F.row_number().over(over_all)).filter(F.col("_rank") <= n).drop("_part", "_rank")


def duplicate_report(df: DataFrame, keys: list[str], count_name: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def require_unique(df: DataFrame, keys: list[str], null_keys: str = "distinct") -> DataFrame:
    """Return ``df``, or raise with a few examples if a key repeats."""
    keyed = df if null_keys == "equal" else df.filter(~any_null(keys))
    examples = duplicate_report(keyed, keys).limit(5).collect()
    if examples:
        raise DuplicateKeys(f"{keys} repeat, for example {[tuple(r) for r in examples]}")
    return df


def tag_by_max(
    df: DataFrame,
    key: str,
    id_col: str,
    child: DataFrame,
    child_id: str,
    null_keys: str = "keep",
) -> DataFrame:
    """Tag each row ``kept``, ``referenced`` or ``unreferenced`` in a ``disposition`` column.

    Kept are the rows with the largest id of their key. Of the rest, those whose id a child table
    names are ``referenced``. Rows with a NULL key are kept, or treated as duplicates with
    ``null_keys="drop"``. All joins use the row id, which no key value can skew.
    """
    if null_keys not in ("keep", "drop"):
        raise ValueError(f"null_keys must be 'keep' or 'drop', not {null_keys!r}")
    keep = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(id_col).alias(id_col)).select(
        id_col, F.lit(True).alias("_keep"), F.lit(None).cast("boolean").alias("_used")
    )
    used = child.select(F.col(child_id).try_cast(df.schema[id_col].dataType).alias(id_col), F.lit(None).cast("boolean").alias("_keep"), F.lit(True).alias("_used"))
    # Both kinds of ids as one row per id: a task holds these marks of its part, and the rows only stream by, unsorted.
    marks = keep.unionByName(used).filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("_keep").alias("_keep"), F.max("_used").alias("_used"))
    kept = F.col("_keep").isNotNull()
    if null_keys == "keep":
        kept = kept | F.col(key).isNull()
    tag = F.when(kept, "kept").when(F.col("_used").isNotNull(), "referenced").otherwise("unreferenced")
    joined = df.join(marks.hint("shuffle_hash"), id_col, "left")
    return joined.withColumn("disposition", tag).select(*df.columns, "disposition")
