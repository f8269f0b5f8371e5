"""What a job changed: a before/after pair of one table, row by row and counted, as a database tells it of its updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _paired(before: DataFrame, after: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str], Column]:
    """Both states of each key in one grouping, which takes NULL keys as equal; the other columns; and the kind of change."""
    columns = list(dict.fromkeys(c for c in [*before.columns, *after.columns] if c not in keys))

    def tagged(df: DataFrame, side: str) -> DataFrame:
        values = F.array(*[(F.col(c) if c in df.columns else F.lit(None)).cast("string") for c in columns]).cast("array<string>")
        row, none = F.struct(F.lit(True).alias("here"), values.alias("v")), F.lit(None).cast("struct<here: boolean, v: array<string>>")
        return df.select(*keys, (row if side == "_b" else none).alias("_b"), (row if side == "_a" else none).alias("_a"))

    both = tagged(before, "_b").unionByName(tagged(after, "_a"))
    pairs = both.groupBy(*keys).agg(
        F.first("_b", ignorenulls=True).alias("_b"), F.first("_a", ignorenulls=True).alias("_a"), F.count("_b").alias("_nb"), F.count("_a").alias("_na")
    )
    repeated = (F.col("_nb") > 1) | (F.col("_na") > 1)
    message = F.concat(F.lit("a key occurs twice: "), F.to_json(F.struct(*keys)))
    kind = (
        F.when(repeated, F.raise_error(message).cast("string")).when(F.col("_nb") == 0, "inserted").when(F.col("_na") == 0, "deleted")
        .when(F.col("_b.v").eqNullSafe(F.col("_a.v")), "unchanged").otherwise("updated")
    )
    return pairs, columns, kind


def change_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change, column, old, new): a row per changed value, and one per inserted or deleted row without column and values.

    Keys are unique in each state; values are compared and told as text, NULL being a value of its own. A column that one state lacks
    counts as NULL there.
    """
    pairs, columns, kind = _paired(before, after, keys)
    cells = F.filter(
        F.array(*[
            F.when(~F.col("_b.v")[i].eqNullSafe(F.col("_a.v")[i]), F.struct(F.lit(c).alias("column"), F.col("_b.v")[i].alias("old"), F.col("_a.v")[i].alias("new")))
            for i, c in enumerate(columns)
        ]) if columns else F.array().cast("array<struct<column: string, old: string, new: string>>"),
        lambda x: x.isNotNull(),
    )
    told = pairs.withColumn("change", kind).filter("change <> 'unchanged'")
    empty = F.array(F.struct(*[F.lit(None).cast("string").alias(n) for n in ("column", "old", "new")]))
    return told.select(*keys, "change", F.inline(F.when(F.col("change") == "updated", cells).otherwise(empty)))


def change_counts(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(change, column, rows): rows inserted, deleted, updated and unchanged, and rows per updated column, in one pass."""
    pairs, columns, kind = _paired(before, after, keys)
    told = pairs.withColumn("change", kind)
    updated = F.col("change") == "updated"
    kinds = ("inserted", "deleted", "updated", "unchanged")
    counts = [F.count_if(F.col("change") == k).alias(k) for k in kinds]
    counts += [F.count_if(updated & ~F.col("_b.v")[i].eqNullSafe(F.col("_a.v")[i])).alias(f"c{i}") for i in range(len(columns))]
    lines = [F.struct(F.lit(k).alias("change"), F.lit(None).cast("string").alias("column"), F.col(k).alias("rows")) for k in kinds]
    lines += [F.struct(F.lit("updated").alias("change"), F.lit(c).alias("column"), F.col(f"c{i}").alias("rows")) for i, c in enumerate(columns)]
    return told.agg(*counts).select(F.inline(F.array(*lines))).filter("rows > 0 or column is null")
