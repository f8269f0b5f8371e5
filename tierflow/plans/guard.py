"""Declared table rules, applied to rows on their way into a table.

A row that breaks a rule does not enter: it is listed below ``audit/rule_breaks_<table>`` with its reasons. Row rules (required,
domain, length) cost nothing beside the write. Of a reference, distinct values are looked up. Of a unique key, only values that
occur under more than one merge key are joined back, so a value that repeats often costs one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.keyspace import any_null
from ..session import stored
from ..sources import schemas
from ..sources.tables import LayerStore, write_audit


def row_rules(table: str, columns: list[str]) -> list[quality.Rule]:
    """The declared rules that one row can break by itself, for columns that are there."""
    rules = [quality.not_null(c) for c in schemas.REQUIRED.get(table, [])]
    rules += [quality.in_domain(c, values) for c, values in schemas.DOMAINS.get(table, {}).items()]
    rules += [quality.max_length(c, n) for c, n in schemas.LENGTHS.get(table, {}).items()]
    return [r for r in rules if r.column in columns]


def _flag(condition: Column, reason: str) -> Column:
    return F.when(condition, F.lit(reason))


def _lost(rows: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct values of a reference that name nothing."""
    named = rows.filter(F.col(column).isNotNull()).select(F.col(column).alias("_v")).distinct()
    return named.join(parent.select(F.col(key).alias("_p")), F.col("_v") == F.col("_p"), "left_anti")


def owners(rows: DataFrame, target: DataFrame | None, unique: list[str], merge_keys: list[str], order_by: list[str]) -> DataFrame:
    """(_u0.., _owner): for each value of a unique key that several merge keys claim, the merge key that has it.

    The table's own row comes first, then the first of the new rows.
    """
    u = [F.col(c).alias(f"_u{i}") for i, c in enumerate(unique)]
    names = [f"_u{i}" for i in range(len(unique))]
    claim = F.struct(*merge_keys)
    order = F.struct(F.lit(1).alias("source"), F.struct(*order_by).alias("row"))
    claims = rows.filter(~any_null(unique)).select(*u, order.alias("_order"), claim.alias("_claim"))
    if target is not None:
        values = claims.select(*names).distinct()
        first = F.struct(F.lit(0).alias("source"), F.lit(None).cast(rows.select(F.struct(*order_by).alias("row")).schema["row"].dataType).alias("row"))
        held = target.filter(~any_null(unique)).select(*u, first.alias("_order"), claim.cast(claims.schema["_claim"].dataType).alias("_claim"))
        claims = claims.unionByName(held.join(values, names, "left_semi"))
    grouped = claims.groupBy(*names).agg(F.min_by("_claim", "_order").alias("_owner"), F.min("_claim").alias("_a"), F.max("_claim").alias("_b"))
    return grouped.filter("not (_a <=> _b)").select(*names, "_owner")


def with_reasons(
    rows: DataFrame, rules: list[quality.Rule], uniques: list[list[str]] = (), references: list[tuple[str, DataFrame, str]] = (),
    target: DataFrame | None = None, merge_keys: list[str] = (), order_by: list[str] | None = None,
) -> DataFrame:
    """The rows with ``reasons``: the rules each breaks, none for most.

    A unique key that holds the merge key is kept by the merge itself and not looked at.
    """
    reasons = [_flag(r.broken, f"{r.name}:{r.column}") for r in rules]
    tagged = rows
    for i, (column, parent, key) in enumerate(references):
        lost = _lost(rows, column, parent, key).withColumnRenamed("_v", f"_lost{i}")
        tagged = tagged.join(lost, F.col(column) == F.col(f"_lost{i}"), "left")
        reasons.append(_flag(F.col(f"_lost{i}").isNotNull(), f"reference:{column}"))
    for i, unique in enumerate(uniques):
        if not merge_keys or set(merge_keys) <= set(unique) or not set(unique) <= set(rows.columns):
            continue
        owned = owners(rows, target, unique, list(merge_keys), order_by or rows.columns)
        owned = owned.select(*[F.col(f"_u{j}").alias(f"_u{i}_{j}") for j in range(len(unique))], F.col("_owner").alias(f"_owner{i}"))
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_u{i}_{j}") for j, c in enumerate(unique)])
        tagged = tagged.join(owned, same, "left")
        taken = F.col(f"_owner{i}").isNotNull() & ~F.struct(*merge_keys).eqNullSafe(F.col(f"_owner{i}"))
        reasons.append(_flag(taken, f"unique:{','.join(unique)}"))
    found = F.filter(F.array(*reasons), lambda x: x.isNotNull()) if reasons else F.array().cast("array<string>")
    return tagged.select(*rows.columns, found.alias("reasons"))


def guarded(
    store: LayerStore, table: str, rows: DataFrame, run_id: str, merge_keys: list[str], order_by: list[str] | None = None,
    layer: str = "conformed",
) -> DataFrame:
    """Rows that keep the table's declared rules. The others are listed with their reasons, under the run's id.

    Rows are checked against the table as it is, in the write that a merge needs anyway. Tables named by a reference that do not exist
    are not looked at.
    """
    references = [
        (column, store.read("conformed", parent, [key]), key)
        for column, parent, key in schemas.REFERENCES.get(table, [])
        if column in rows.columns and store.exists("conformed", parent)
    ]
    uniques = schemas.UNIQUE.get(table, [])
    columns = sorted({c for u in uniques for c in u} | set(merge_keys))
    target = store.read(layer, table, columns) if uniques and store.exists(layer, table) else None
    tagged = with_reasons(rows, row_rules(table, rows.columns), uniques, references, target, merge_keys, order_by)
    seen = Observation()
    checked = stored(tagged.observe(seen, F.count_if(F.size("reasons") > 0).alias("broken")), "checked")
    if seen.get["broken"]:
        write_audit(checked.filter(F.size("reasons") > 0), f"{store.root}/audit", run_id, f"rule_breaks_{table}")
    return checked.filter(F.size("reasons") == 0).drop("reasons")
