"""Row rules, key and reference checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import duplicate_report
from .keyspace import any_null


class RuleViolation(ValueError):
    """Raised when a check finds rows that break its rule."""


@dataclass(frozen=True)
class Rule:
    """A row rule: ``broken`` is true for rows that break it."""

    name: str
    column: str
    broken: Column


def not_null(column: str) -> Rule:
    return Rule("not_null", column, F.col(column).isNull())


def in_domain(column: str, values: list[str]) -> Rule:
    """NULL passes, as a nullable column of an enumerated type allows it."""
    return Rule("domain", column, F.coalesce(~F.col(column).isin(*values), F.lit(False)))


def max_length(column: str, n: int) -> Rule:
    return Rule("max_length", column, F.coalesce(F.length(F.col(column)) > n, F.lit(False)))


def castable(column: str, dtype: str) -> Rule:
    c = F.col(column)
    return Rule("castable", column, c.isNotNull() & F.trim(c).try_cast(dtype).isNull())


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Violations per rule, all rules in one pass over the table."""
    counted = df.agg(*[F.count_if(r.broken).alias(f"_{i}") for i, r in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"), F.col(f"_{i}").alias("violations"))
            for i, r in enumerate(rules)
        ]
    )
    return counted.select(F.inline(rows))


def quarantine(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with an array of the broken rules."""
    reasons = F.filter(
        F.array(*[F.when(r.broken, F.lit(f"{r.name}:{r.column}")) for r in rules]), lambda x: x.isNotNull()
    )
    tagged = df.withColumn("reasons", reasons)
    good = tagged.filter(F.size("reasons") == 0).drop("reasons")
    return good, tagged.filter(F.size("reasons") > 0)


def _summary(df: DataFrame, rule: str, column: str, count: Column) -> DataFrame:
    return df.agg(count.alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(column).alias("column"), "violations"
    )


def unique_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys that repeat; keys with a NULL never do."""
    repeated = duplicate_report(df.filter(~any_null(keys)), keys)
    return _summary(repeated, "unique", ",".join(keys), F.count(F.lit(1)))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows that name a parent which does not exist; a NULL reference passes.

    References are reduced to distinct values before the join, so a much-named parent costs nothing.
    """
    named = child.filter(F.col(fk).isNotNull()).select(F.col(fk).alias("_fk")).distinct()
    lost = named.join(parent.select(F.col(pk).alias("_pk")), F.col("_fk") == F.col("_pk"), "left_anti")
    return child.join(lost, child[fk] == lost["_fk"], "left_semi")


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    per_key = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(parent.select(F.col(pk).alias("_pk")), F.col("_fk") == F.col("_pk"), "left_anti")
    return _summary(lost, "reference", fk, F.coalesce(F.sum("_n"), F.lit(0)))


def require_clean(summary: DataFrame) -> None:
    """Raise if any line of a summary (one per rule) counts a violation."""
    bad = summary.filter("violations > 0").collect()
    if bad:
        raise RuleViolation("; ".join(f"{r['rule']}({r['column']}): {r['violations']} rows" for r in bad))
