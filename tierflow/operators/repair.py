"""Recoding, flagged updates and deletes with their removed rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stripped
from .merge import update_where
from .sizing import BROADCAST_BYTES, measured_bytes


@dataclass(frozen=True)
class Split:
    """Both sides of a delete: ``kept`` and ``removed`` together are the input; ``in_place``: kept rows lie as the input's rows do."""

    kept: DataFrame
    removed: DataFrame
    in_place: bool = False

    def apply(self, dry_run: bool = False) -> DataFrame:
        """The table after the delete; with ``dry_run`` the table as it was."""
        return self.kept.unionByName(self.removed) if dry_run else self.kept


def resolve_in_order(mapping: dict[str, str]) -> dict[str, str]:
    """Where each value ends when the replacements run one after another."""
    result = {}
    for start in mapping:
        value = start
        for old, new in mapping.items():
            if value.strip(" ") == old:
                value = new
        result[start] = value
    return result


def recode(
    df: DataFrame, column: str, mapping: dict[str, str], normalise: Callable[[Column], Column] = F.trim
) -> DataFrame:
    """Replace values found in a short map; a value outside the map stays as written."""
    final = resolve_in_order(mapping)
    lookup = F.create_map(*[F.lit(x) for kv in final.items() for x in kv])
    found = F.try_element_at(lookup, normalise(F.col(column)))
    return df.withColumn(column, F.coalesce(found, F.col(column)))


def recode_from_table(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    old: str,
    new: str,
    normalise: Callable[[Column], Column] = F.trim,
) -> DataFrame:
    """As ``recode``, with a table of final replacements and unique old values."""
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = df.join(m, normalise(df[column]) == F.col("_old"), "left")
    value = F.coalesce(F.col("_new"), df[column]).alias(column)
    return joined.select(*[value if c == column else df[c] for c in df.columns])


def case_update(df: DataFrame, column: str, by: Column, mapping: dict[str, str]) -> DataFrame:
    """Set ``column`` by the value of another expression, else leave it."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(column, F.coalesce(F.try_element_at(lookup, by), F.col(column)))


@dataclass(frozen=True)
class ListedUpdate:
    updated: DataFrame
    unmatched: DataFrame


def _listed(keys: DataFrame, key: str, normalise) -> DataFrame:
    return keys.select(normalise(F.col(key)).alias("_listed")).filter("_listed is not null").distinct()


def update_listed(
    target: DataFrame,
    target_key: str,
    keys: DataFrame,
    key: str,
    values: dict[str, Column],
    normalise: Callable[[Column], Column] = stripped,
) -> ListedUpdate:
    """Assign in rows whose normalised key is listed; also return listed keys without a row."""
    listed = _listed(keys, key, normalise)
    flagged = target.join(
        listed.withColumn("_hit", F.lit(True)), normalise(target[target_key]) == F.col("_listed"), "left"
    )
    updated = update_where(flagged, F.col("_hit").isNotNull(), values).select(*target.columns)
    present = target.select(normalise(F.col(target_key)).alias("_listed"))
    unmatched = listed.join(present, "_listed", "left_anti").select(F.col("_listed").alias(key))
    return ListedUpdate(updated, unmatched)


def delete_where(df: DataFrame, condition: Column) -> Split:
    """Rows where the condition is true go; where it is false or NULL they stay."""
    hit = F.coalesce(condition, F.lit(False))
    return Split(df.filter(~hit), df.filter(hit), in_place=True)


def delete_listed(
    df: DataFrame,
    column: str,
    listed: DataFrame,
    listed_col: str,
    condition: Column | None = None,
    normalise: Callable[[Column], Column] | None = None,
) -> Split:
    """Delete rows whose value is in the listed column (and that meet the condition).

    Rows that fail the condition do not take part in the join.
    """
    def value(c: Column) -> Column:
        return c if normalise is None else normalise(c)

    # The list takes the column's type, so an id can meet its text form without a failing cast.
    keys = listed.select(F.col(listed_col).try_cast(df.schema[column].dataType).alias("_listed")).filter("_listed is not null")
    # A task holds listed values only, those of its part if they don't fit a broadcast; the rows stream by, unsorted.
    keys = F.broadcast(keys) if measured_bytes(keys) <= BROADCAST_BYTES else keys.distinct().hint("shuffle_hash")
    eligible = df if condition is None else df.filter(F.coalesce(condition, F.lit(False)))
    test = value(F.col(column)) == F.col("_listed")
    kept = eligible.join(keys, test, "left_anti")
    if condition is not None:
        kept = kept.unionByName(df.filter(~F.coalesce(condition, F.lit(False))))
    return Split(kept, eligible.join(keys, test, "left_semi"))


def delete_cascade(tables: dict[str, tuple[DataFrame, str]], ids: DataFrame, id_col: str) -> dict[str, Split]:
    """Delete the same ids from every table, in the given order: children before the parent."""
    return {name: delete_listed(df, column, ids, id_col) for name, (df, column) in tables.items()}
