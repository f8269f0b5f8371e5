"""Joins with a rule of their own beyond plain equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalised, split_list
from .keyspace import same_keys


def normalised_join(
    left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str = "inner"
) -> DataFrame:
    """Equi-join on text without regard to case and surrounding spaces.

    Each side computes its keys once, so Spark plans a hash or sort-merge join on them.
    """
    lk = left.select("*", *[normalised(F.col(a)).alias(f"_lk{i}") for i, (a, _) in enumerate(pairs)])
    rk = right.select("*", *[normalised(F.col(b)).alias(f"_rk{i}") for i, (_, b) in enumerate(pairs)])
    names = [(f"_lk{i}", f"_rk{i}") for i in range(len(pairs))]
    return lk.join(rk, same_keys(lk, rk, names), how).drop(*[n for pair in names for n in pair])


def _level_of(length: Column) -> Column:
    """The least level whose buckets (twice as long from level to level, beginning with one unit) are as long."""
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    point: Column,
    start: Column,
    end: Column,
    bucket_days: int = 32,
) -> DataFrame:
    """Inner join where ``start <= point <= end`` on dates.

    An equi-join with a re-check. Buckets of ``bucket_days`` double in length from level to level; a range is listed
    on the first level whose buckets are as long as itself, so in two buckets at most, however long it is. A point
    is listed once per level that some range uses (a subquery of the plan: no job runs before it, and 20 levels span all
    dates), and meets a range exactly once. Bucket numbers are whole numbers throughout. A bucket with very many points can be
    split by AQE; ``interval_join`` cuts hot times beforehand.
    """
    held = ranges.filter(start <= end).select("*", start.cast("date").alias("_from"), end.cast("date").alias("_to"))
    units = F.floor((F.datediff("_to", "_from") + bucket_days) / F.lit(bucket_days)).cast("long")
    held = held.withColumn("_level", _level_of(units).cast("int"))
    first, last = _bucket(F.col("_from"), bucket_days, "_level"), _bucket(F.col("_to"), bucket_days, "_level")
    spans = held.select("*", F.explode(F.sequence(first, last)).alias("_bucket"))
    levels = held.agg(F.collect_set("_level").alias("levels")).scalar()
    placed = points.select("*", point.cast("date").alias("_point"), F.explode(levels).alias("_level"))
    placed = placed.select("*", _bucket(F.col("_point"), bucket_days, "_level").alias("_bucket"))
    joined = placed.join(spans, ["_level", "_bucket"]).filter(F.col("_point").between(F.col("_from"), F.col("_to")))
    return joined.drop("_level", "_bucket", "_from", "_to", "_point")


def _bucket(day: Column, bucket_days: int, level: str) -> Column:
    """Whole numbers that round down: the day's bucket on level 0, halved ``level`` times."""
    base = F.floor(F.unix_date(day) / F.lit(bucket_days)).cast("long")
    return F.call_function("shiftright", base, F.col(level))


def interval_join(
    points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, buckets: int = 64, hot_share: int = 4
) -> DataFrame:
    """Inner join where ``start <= point <= end`` on any ordered type, for times that are spread unevenly.

    Borders are quantiles of the points and of both ends of the ranges together, so that each bucket holds about the same number of
    both, wherever they crowd; equal borders fall together. Points of one bucket that holds more than ``hot_share`` times its part (many points of one
    time) are dealt into slices by a hash, and the bucket's ranges are listed in each slice. Buckets form a binary tree: a range is listed in
    the few nodes that cover it (two on a level at most), a point on each level above its bucket, and they meet in one node exactly.
    Borders and slices are subqueries of the plan, whole numbers and comparisons; nothing runs on the driver.
    NULLs, and ranges that end before they start, match nothing. Columns of both sides must have different names.
    """
    held = ranges.filter(F.col(start) <= F.col(end))
    ends = points.select(F.col(point).alias("t")).unionByName(held.select(F.explode(F.array(start, end)).alias("t"))).filter("t is not null")
    number = {"date": F.unix_date, "timestamp": F.unix_micros, "timestamp_ntz": lambda c: F.unix_micros(c.cast("timestamp"))}

    def numbered(df: DataFrame, column: str) -> Column:
        kind = df.schema[column].dataType.typeName()
        return number[kind](F.col(column)).cast("long") if kind in number else F.col(column)

    kind = "double" if points.schema[point].dataType.typeName() in ("float", "double", "decimal") else "long"
    borders = ends.select(numbered(ends, "t").alias("t")).agg(
        F.array_distinct(F.percentile_approx("t", [i / buckets for i in range(1, buckets)], 100 * buckets)).cast(f"array<{kind}>").alias("b")
    ).scalar()
    levels = (buckets - 1).bit_length()

    def place(df: DataFrame, column: str) -> Column:
        """The bucket: how many borders lie at or below the value."""
        value = numbered(df, column)
        return F.coalesce(F.size(F.filter("_borders", lambda b: b <= value)), F.lit(0)).cast("long")

    placed = points.filter(F.col(point).isNotNull()).withColumn("_borders", borders).select(*points.columns, place(points, point).alias("_at"))
    counts = placed.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"))  # at most ``buckets`` rows
    part = F.lit(hot_share) * F.greatest(F.sum("_n").over(Window.partitionBy(F.lit(0))) / F.lit(buckets), F.lit(1.0))
    slices = F.map_from_entries(F.collect_list(F.struct("_at", F.ceil(F.col("_n") / F.col("_part")).cast("int").alias("_s"))))
    hot = counts.withColumn("_part", part).filter(F.col("_n") > F.col("_part")).agg(slices.alias("m")).scalar()

    # A point of a hot bucket keeps to the leaf level with a slice; others are listed on every level.
    placed = placed.withColumn("_hot", hot)
    own = F.try_element_at("_hot", F.col("_at"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in points.columns], F.monotonically_increasing_id()), F.coalesce(own, F.lit(1))).cast("int")
    up = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", F.col("_at"), k).alias("node")))
    listed = placed.select("*", F.when(own.isNotNull(), salt).otherwise(0).alias("_slice"), F.explode(up).alias("_n"))
    listed = listed.select(*points.columns, F.col("_n.level").alias("_level"), F.col("_n.node").alias("_node"), "_slice")

    spans = held.withColumn("_borders", borders).select(*ranges.columns, place(held, start).alias("_a"), place(held, end).alias("_b"))
    step = F.sequence(F.lit(0), F.lit(levels))

    def node_at(k: Column) -> Column:
        """Nodes of level k that the cover of [a, b] has: its odd left end and its even right end, as in a segment tree."""
        a = F.call_function("shiftright", F.col("_a") + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k)
        b = F.call_function("shiftright", F.col("_b") + 1, k) - 1
        left = F.when((a <= b) & (a % 2 == 1), F.array(a)).otherwise(F.array().cast("array<bigint>"))
        right = F.when((a <= b) & (b % 2 == 0), F.array(b)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.array_distinct(F.concat(left, right)), lambda n: F.struct(k.alias("level"), n.alias("node")))

    cover = F.flatten(F.transform(step, node_at))
    spans = spans.select(*ranges.columns, F.explode(cover).alias("_c"))
    spans = spans.select(*ranges.columns, F.col("_c.level").alias("_level"), F.col("_c.node").alias("_node"))
    # Slices of the hot buckets below a node: a range is listed once for each.
    spans = spans.withColumn("_hot", hot)
    below = F.filter(F.map_entries("_hot"), lambda e: F.call_function("shiftright", e["key"], F.col("_level")) == F.col("_node"))
    most = F.array_max(F.transform(below, lambda e: e["value"]))
    spans = spans.select(*ranges.columns, "_level", "_node", F.explode(F.sequence(F.lit(0), F.coalesce(most, F.lit(1)) - 1)).alias("_slice"))
    joined = listed.join(spans, ["_level", "_node", "_slice"]).filter(F.col(point).between(F.col(start), F.col(end)))
    return joined.drop("_level", "_node", "_slice")


def interval_totals(
    points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, point_keys: list[str], range_keys: list[str],
    sums: dict[str, str], count_name: str = "n", whole_days: bool = False,
) -> DataFrame:
    """Per group of both sides, the number of pairs of ``interval_join`` and sums of columns of the points over them.

    A total needs no list of all pairs, whose number is the product of both sides. Points of one time and group, and ranges of the same
    two ends and group, are one row each with their number and sums before they are joined, and weigh as much after it.
    ``whole_days``: all ranges begin and end at midnight, so a point is told apart from others by its day and by whether it is
    midnight itself; any later time of the day lies in the same ranges. Rows to join are then bounded by days, whatever the precision of the points.
    """
    kept = points.filter(F.col(point).isNotNull())
    if whole_days:
        day = F.date_trunc("day", point).cast(points.schema[point].dataType)
        kept = kept.withColumn(point, F.when(F.col(point) == day, day).otherwise(day + F.expr("interval 12 hours")))
    held = {c: f"_sum{i}" for i, c in enumerate(sums)}
    p = kept.groupBy(point, *point_keys).agg(F.count(F.lit(1)).alias("_points"), *[F.sum(c).alias(h) for c, h in held.items()])
    r = ranges.groupBy(start, end, *range_keys).agg(F.count(F.lit(1)).alias("_ranges"))
    hits = interval_join(p, r, point, start, end)
    weighed = [F.sum(F.col(h) * F.col("_ranges")).alias(sums[c]) for c, h in held.items()]
    return hits.groupBy(*range_keys, *point_keys).agg(F.sum(F.col("_points") * F.col("_ranges")).alias(count_name), *weighed)


def unnest(df: DataFrame, array_col: str, element: str) -> DataFrame:
    """One row per array element; NULL and empty arrays give none."""
    return df.withColumn(element, F.explode(array_col))


def unnest_text(df: DataFrame, column: str, element: str, separator: str = ",") -> DataFrame:
    """One row per part of a separated text; NULL and empty texts give none."""
    return df.withColumn(element, F.explode(split_list(F.col(column), separator)))


def look_up_one(
    df: DataFrame, lookup: DataFrame, on: tuple[str, str], value: str, name: str, order_by: str | None = None
) -> DataFrame:
    """Left join to one value per key: the one with the smallest ``order_by``, else the smallest."""
    key, lookup_key = on
    pick = F.min(value) if order_by is None else F.min_by(value, order_by)
    one = lookup.groupBy(F.col(lookup_key).alias("_one")).agg(pick.alias(name))
    return df.join(one, df[key] == one["_one"], "left").drop("_one")


def match_split(keys: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Distinct keys with a ``matched`` flag that tells if the table has them, in one pass."""
    present = table.select(*on).distinct().withColumn("_hit", F.lit(True))
    return (
        keys.select(*on).distinct().join(present, on, "left")
        .select(*on, F.col("_hit").isNotNull().alias("matched"))
    )
