"""Keyed merges as pure functions ``(target, source) -> new target``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import local_now
from .dedupe import dedupe_keep_last
from .keyspace import any_null, may_be_null, same_keys
from .sizing import broadcast_if_small


@dataclass(frozen=True)
class Audit:
    """Stamp columns of an upsert; rows the source does not touch keep theirs."""

    inserted: str = "inserted_at"
    updated: str = "updated_at"
    now: dt.datetime | None = None

    def stamp(self) -> Column:
        return (local_now() if self.now is None else F.lit(self.now.isoformat(sep=" "))).cast("timestamp_ntz")


#: Copies of a row that are listed at once.
_PIECE = 1 << 16

#: Column of an upsert that tells what became of a row: inserted, updated or NULL.
CHANGE = "_change"


def _salt(df: DataFrame, keys: list[str]) -> Column:
    """0 for complete keys; the row's hash for others, which spreads them and never makes them equal."""
    if not may_be_null(df, keys):
        return F.lit(0).cast("long")
    return F.when(any_null(keys), F.xxhash64(*[F.col(c) for c in df.columns])).otherwise(F.lit(0).cast("long"))


def _last_rows(source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row per key in one pass over the source; rows with a NULL key all stay. ``_salt`` is added.

    Map tasks combine rows of one key first. Equal rows with a NULL key are counted, and listed again in pieces of bounded size.
    """
    # The keys are in the group; a row that is its own order travels once.
    row = F.struct(*([c for c in source.columns if c not in keys] or keys))
    last = F.max(row) if list(order_by) == source.columns else F.max_by(row, F.struct(*order_by))
    grouped = source.withColumn("_salt", _salt(source, keys)).groupBy(*keys, "_salt").agg(last.alias("_row"), F.count(F.lit(1)).alias("_n"))
    # Keys and salt stay the grouped columns, so a join by them finds the rows where they lie.
    counted = grouped.select(*keys, "_salt", "_row", F.when(F.col("_salt") != 0, F.col("_n")).otherwise(1).alias("_n"))
    pieces = counted.select("*", F.explode(F.expr(f"sequence(0L, (_n - 1) div {_PIECE})")).alias("_piece"))
    size = F.least(F.lit(_PIECE), F.col("_n") - F.col("_piece") * _PIECE)
    rows = pieces.select("*", F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_copy"))
    return rows.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in source.columns], "_salt")


def _one_source_row(source: DataFrame, keys: list[str], on_dup: str, order_by: list[str] | None) -> DataFrame:
    """One row per complete key, and all rows with a NULL key; hashed by the key, as the join after it."""
    if on_dup == "unique":
        return source
    if on_dup == "last":
        if may_be_null(source, keys):
            return _last_rows(source, keys, order_by or source.columns)
        return dedupe_keep_last(source, keys, order_by or source.columns, null_keys="equal")
    if on_dup != "raise":
        raise ValueError(f"on_dup must be 'raise', 'last' or 'unique', not {on_dup!r}")
    rank = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*keys))
    message = F.concat(F.lit("merge key occurs twice in the source: "), F.to_json(F.struct(*keys)))
    repeated = (F.col("_rank") > 1) & (F.col("_salt") == 0)
    checked = F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(True)
    return source.withColumn("_salt", _salt(source, keys)).withColumn("_rank", rank).filter(checked).drop("_rank", "_salt")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    on_dup: str = "raise",
    order_by: list[str] | None = None,
    audit: Audit | None = None,
    small_source: bool = False,
    mark_changes: bool = False,
) -> DataFrame:
    """Insert rows with new keys, overwrite ``update_cols`` of rows with known keys.

    Target columns outside ``update_cols`` keep their value on a match; columns the source lacks are
    NULL in inserted rows. A NULL in any key never matches, so such source rows always insert.
    Two source rows with one key fail the job (``on_dup="raise"``), the last by ``order_by`` wins
    (``"last"``), or the caller states they cannot occur (``"unique"``). With ``order_by`` columns
    the target lacks, they only serve the choice.

    Complete keys are unique in the target, as any keyed merge needs, and in the chosen source rows,
    so no key is hot in the join. Rows with a NULL key pass the same join: they equal nothing, and a hash of
    the row as a further join key spreads them. Each input is read once.

    ``mark_changes`` adds ``_change``: inserted, updated, or NULL for rows the source does not touch.

    ``small_source=True`` asks for a left join plus an anti-join instead of one full outer join: a
    source that measures small is broadcast and the target is never shuffled. A larger one still
    gives the same rows, but the full outer join shuffles less.
    """
    unknown = [c for c in (update_cols or []) if c not in source.columns or c not in target.columns]
    if unknown:
        raise ValueError(f"not in both tables: {unknown}")
    stamps = () if audit is None else (audit.inserted, audit.updated)
    if audit is not None:
        for c in stamps:
            target = add_column(target, c, T.TimestampNTZType())
    extra = [c for c in source.columns if c not in target.columns and c not in (order_by or [])]
    if extra:
        raise ValueError(f"source columns the target lacks: {extra}; use add_column first")
    shared = [c for c in source.columns if c in target.columns and c not in keys]
    updated = set(shared if update_cols is None else update_cols)

    rows = _one_source_row(source, keys, on_dup, order_by)
    rows = rows.select(*keys, *shared, "_salt" if "_salt" in rows.columns else _salt(rows, keys).alias("_salt"))
    incoming = rows.select(*[F.col(c).alias(f"_s_{c}") for c in rows.columns], F.lit(True).alias("_in_source"))
    present = target.withColumn("_salt", _salt(target, keys)).withColumn("_in_target", F.lit(True))
    pairs = [(k, f"_s_{k}") for k in keys]
    change = [F.when(F.col("_in_target").isNull(), "inserted").when(F.col("_in_source"), "updated").alias(CHANGE)] * mark_changes

    def merged(c: str) -> Column:
        old, is_new = F.col(c), F.col("_in_target").isNull()
        touched = is_new | F.col("_in_source") if c in updated or (audit and c == audit.updated) else is_new
        if c in keys:
            return F.coalesce(old, F.col(f"_s_{c}").cast(target.schema[c].dataType)).alias(c)
        if c in stamps:
            return F.when(touched, audit.stamp()).otherwise(old).alias(c)
        if c in shared:
            return F.when(touched, F.col(f"_s_{c}").cast(target.schema[c].dataType)).otherwise(old).alias(c)
        return old

    def inserted(df: DataFrame, prefix: str = "") -> DataFrame:
        def value(c: str) -> Column:
            if c in stamps:
                return audit.stamp()
            return F.col(prefix + c) if c in keys or c in shared else F.lit(None)

        return df.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in target.schema])

    if small_source:
        side = broadcast_if_small(incoming)
        kept = present.join(side, same_keys(present, side, pairs), "left")
        result = kept.select(*[merged(c) for c in target.columns], *change)
        # Target keys that the source names: as few as the source has, so the anti-join is small too.
        known = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
        named = known.join(side, same_keys(known, side, [(f"_t_{k}", s) for k, s in pairs]), "left_semi")
        absent = incoming.join(named, same_keys(incoming, named, [(s, f"_t_{k}") for k, s in pairs]), "left_anti")
        new = inserted(absent, "_s_")
        return result.unionByName(new.withColumn(CHANGE, F.lit("inserted")) if mark_changes else new)
    salted = [*pairs, ("_salt", "_s__salt")] if may_be_null(target, keys) or may_be_null(rows, keys) else pairs
    joined = present.join(incoming, same_keys(present, incoming, salted), "full_outer")
    return joined.select(*[merged(c) for c in target.columns], *change)


def upsert_or_delete(target: DataFrame, source: DataFrame, keys: list[str], apart: bool = False, **options) -> DataFrame:
    """``upsert`` of the source rows whose ``_gone`` is false; target rows with the key of a gone one leave. A NULL key names no row.

    ``apart``: a gone row only marks its key, which stays if the source upserts it too; then ``on_dup="last"`` is needed. The mark passes the
    one join of the upsert, and the target is not shuffled for the rows that leave.
    """
    if apart:
        if options.get("update_cols") is not None:
            options["update_cols"] = [*options["update_cols"], "_kept"]
        # First of the columns, so that of the rows of one key a kept one is the last.
        marked = source.select((~F.col("_gone")).alias("_kept"), *[c for c in source.columns if c != "_gone"])
        merged = upsert(target.withColumn("_kept", F.lit(True)), marked, keys, **options)
        return merged.filter("_kept").drop("_kept")
    gone = source.filter("_gone").select(*keys).distinct()
    return upsert(target.join(gone, keys, "left_anti"), source.filter("not _gone").drop("_gone"), keys, **options)


def upsert_in_order(
    target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str], **options
) -> DataFrame:
    """The result of one upsert per source row in order: the last row of a key wins."""
    return upsert(target, source, keys, on_dup="last", order_by=order_by, **options)


def patch_non_null(
    target: DataFrame, patch: DataFrame, key: str, cols: list[str], order_by: list[str]
) -> DataFrame:
    """Overwrite a column only where the patch has a value; per column the last value wins."""
    order = F.struct(*order_by)
    last = patch.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_p_key")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_p_{c}") for c in cols]
    )
    joined = target.join(last, F.col(key) == F.col("_p_key"), "left")
    return joined.select(
        *[F.coalesce(F.col(f"_p_{c}"), target[c]).alias(c) if c in cols else target[c] for c in target.columns]
    )


def fill_null_from_lookup(
    target: DataFrame,
    lookup: DataFrame,
    on: list[tuple[Column, Column]],
    target_col: str,
    lookup_col: str,
) -> DataFrame:
    """Fill NULLs with the smallest look-up value whose key expressions equal the row's.

    Each pair holds an expression over target columns and one over look-up columns. Only rows that
    need a value take part in the join.
    """
    names = [f"_l_{i}" for i in range(len(on))]
    best = lookup.groupBy(*[e.alias(n) for n, (_, e) in zip(names, on)]).agg(F.min(lookup_col).alias("_fill"))
    # Rows that have a value get no key, so they match nothing; their hash spreads them over the join's tasks.
    has = F.col(target_col).isNotNull()
    salt = F.when(has, F.xxhash64(*[F.col(c) for c in target.columns])).otherwise(F.lit(0).cast("long"))
    keyed = target.select("*", *[F.when(~has, e).alias(f"_t{n}") for n, (e, _) in zip(names, on)], salt.alias("_salt"))
    best = best.withColumn("_zero", F.lit(0).cast("long"))
    filled = keyed.join(best, same_keys(keyed, best, [*[(f"_t{n}", n) for n in names], ("_salt", "_zero")]), "left")
    value = F.coalesce(F.col(target_col), F.col("_fill").cast(target.schema[target_col].dataType)).alias(target_col)
    return filled.select(*[value if c == target_col else F.col(c) for c in target.columns])


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Assign in rows where the condition is true; all right sides see the old values."""
    return df.select(
        *[
            F.when(condition, assignments[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in assignments
            else F.col(f.name)
            for f in df.schema
        ]
    )


def add_column(df: DataFrame, name: str, dtype: T.DataType | str, default=None) -> DataFrame:
    """Add a column unless it is there."""
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(dtype))


def fill_from_table(df: DataFrame, id_col: str, column: str, values: DataFrame) -> DataFrame:
    """Set ``column`` from a table ``(id_col, column)`` with unique ids; other rows keep theirs."""
    v = values.select(F.col(id_col).alias("_v_id"), F.col(column).alias("_v"), F.lit(True).alias("_hit"))
    dtype = df.schema[column].dataType
    joined = df.join(v, F.col(id_col) == F.col("_v_id"), "left")
    value = F.when(F.col("_hit"), F.col("_v").cast(dtype)).otherwise(df[column]).alias(column)
    return joined.select(*[value if c == column else df[c] for c in df.columns])


def fill_from_map(df: DataFrame, id_col: str, column: str, values: dict) -> DataFrame:
    """Set ``column`` from a short literal map keyed by id; other rows keep theirs."""
    pairs = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    hit = F.coalesce(F.map_contains_key(pairs, F.col(id_col)), F.lit(False))
    return update_where(df, hit, {column: F.try_element_at(pairs, F.col(id_col))})


def insert_select(
    target: DataFrame, rows: DataFrame, skip_known: list[str] | None = None
) -> DataFrame:
    """Append rows cast to the target's types; missing columns are NULL.

    Re-running appends again, unless ``skip_known`` names the key that makes known rows stay out.
    """
    cast = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    if skip_known:
        cast = cast.join(target.select(*skip_known), skip_known, "left_anti")
    return target.unionByName(cast)
