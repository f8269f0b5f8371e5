"""Connected components of links between numbers, by alternating star contractions.

Both contractions are a grouped minimum (combined inside map tasks) and one equi-join, so a node with very
many links is never gathered in one place and its join partition can be split. Every round is written below
the shared folder: a lost executor costs one round's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with the least of u and all its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    held = _with_least(down)
    moved = held.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(held.select("u", F.col("least").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Links (u long, v long) to rows (node, root): the least node reachable, for every node with a link.

    Links of a node with itself and repeated links are allowed and change nothing; nodes without a link to
    another node have no row. Runs jobs until nothing changes: a logarithmic number of rounds in practice.
    """
    links = stored(links.where("u <> v").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = stored(_small_star(stored(_large_star(links).distinct(), "links")).distinct(), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    members = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
