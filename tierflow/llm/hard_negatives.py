"""Hard negatives by the threshold algorithm over sorted lists.

Rows are dealt into blocks of bounded size. A block holds, for every dimension, its candidates sorted by that
component. An anchor reads these lists in step, from the greatest components where its own component is positive and
from the least where it is negative; each row met is scored at once (random access, exact integers). The
components at the current depth give the threshold: no row that was not met can score more. A search ends when the
threshold lies strictly below the kth best score of each of its windows, so rows that tie are always met.

There are two searches. Positives: the best rows of the anchor's label, in blocks of that label. Negatives: for each positive
the best rows of other labels whose score lies in the window that the positive's score opens. Blocks answer by themselves
and the answers are merged by rank. A block receives all anchors, one Arrow batch after the other: the anchors are the
stated query set, a hundredth of the rows, and memory holds one block and one batch.

Edge cases: rows with a NULL id, label or vector, or with a NULL, NaN or infinite component take no part. A shorter vector counts as
filled up with zeros. Components beyond the range of a long saturate, scores are exact and saturate likewise.
Rows that repeat an id are one row: the one with the least label, then the least vector. Ties go to the smaller id.
An anchor without positives, or a positive without negatives in its window, has no rows. An empty table gives an empty
result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import small_batches, stored

#: Rows of a block at most on average, and the least worth a block of its own.
BLOCK_ROWS, LEAST_ROWS = 1 << 18, 1 << 11
#: Depth of the first sorted access; each further one goes twice as deep.
FIRST_DEPTH = 16
_LONG = np.iinfo(np.int64)


class SortedLists:
    """A block: ids ascending, labels, integer vectors, and per dimension the places in the order of its components."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list[list[int]]):
        kept: dict[int, tuple] = {}
        for row in zip(ids, labels, vectors):
            if row[0] not in kept or row[1:] < kept[row[0]]:
                kept[row[0]] = row[1:]
        order = sorted(kept)
        width = max((len(kept[i][1]) for i in order), default=0) or 1
        whole = np.zeros((len(order), width), np.int64)
        for at, i in enumerate(order):
            whole[at, : len(kept[i][1])] = kept[i][1]
        self.ids, self.labels = np.array(order, np.int64), np.array([kept[i][0] for i in order], np.int64)
        self.greatest = int(max(abs(int(whole.min(initial=0))), int(whole.max(initial=0))))
        self.rows = whole.astype(np.float32) if self.greatest < 1 << 24 else whole
        self.places = np.argsort(whole, axis=0, kind="stable").T.astype(np.int32)
        self._exact: dict[str, np.ndarray] = {}

    def typed(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and anchor in the narrowest type that keeps their inner products exact."""
        bound = self.greatest * max(abs(int(anchor.min())), abs(int(anchor.max()))) * len(anchor)
        kind = "f4" if bound < 1 << 24 else "f8" if bound < 1 << 53 else "O"
        if kind not in self._exact:
            self._exact[kind] = self.rows.astype(np.int64).astype(object) if kind == "O" else self.rows.astype(kind)
        return self._exact[kind], anchor.astype(object) if kind == "O" else anchor.astype(kind)


def threshold_search(
    block: SortedLists, vector: list[int], allowed: np.ndarray, windows: list[tuple[float, float]], k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of allowed rows, among them the ``k`` best of each window (low, high), both inclusive."""
    width, n = block.places.shape
    wide = vector[:width] + [0] * (width - len(vector))  # components beyond the block's meet zeros
    rows, anchor = block.typed(np.array(wide, np.int64))
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    if not up.size and not down.size:
        up = np.array([0])  # all rows score zero: one list reaches them
    met, depth, step = np.zeros(n, bool), 0, FIRST_DEPTH
    found, scores = [], []
    floors = [low for low, _ in windows]
    tops = [np.zeros(0, rows.dtype) for _ in windows]
    while depth < n:
        deeper = min(n, depth + step)
        fresh = np.zeros(n, bool)
        fresh[block.places[up, n - deeper : n - depth]] = True
        fresh[block.places[down, depth:deeper]] = True
        fresh &= ~met
        met |= fresh
        at = np.flatnonzero(fresh & allowed)
        if at.size:
            got = rows[at] @ anchor
            found.append(at)
            scores.append(got)
            for w, (low, high) in enumerate(windows):
                best = np.concatenate((tops[w], got[(got >= low) & (got <= high)]))
                tops[w] = np.sort(best)[-k:]
                if len(tops[w]) == k:
                    floors[w] = tops[w][0]
        threshold = anchor[up] @ rows[block.places[up, n - deeper], up] + anchor[down] @ rows[block.places[down, deeper - 1], down]
        if all(threshold < floor for floor in floors) or met.all():
            break
        depth, step = deeper, step * 2
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    exact = np.concatenate(scores)
    if exact.dtype == object:
        exact = np.clip(exact, _LONG.min, _LONG.max)
    return np.concatenate(found), exact.astype(np.int64)


def best_of(block: SortedLists, at: np.ndarray, scores: np.ndarray, low: float, high: float, k: int) -> np.ndarray:
    """Positions of the ``k`` best of a window, by score, then by id (places are in the order of ids)."""
    inside = np.flatnonzero((scores >= low) & (scores <= high))
    return inside[np.lexsort((at[inside], ~scores[inside]))][:k]  # ~x falls as x rises and, unlike -x, never overflows


def _searched(rows: DataFrame, answer: Callable[[SortedLists, tuple], list[tuple]], schema: str, names: list[str]) -> DataFrame:
    """Rows (shard, asks, vec_id, label, v, positives): a shard's candidates come before its anchors, which are answered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, parts = None, None, ([], [], [])
        for batch in batches:
            out: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            for key, asks, vec_id, label, v, positives in zip(*columns):
                if key != shard:
                    shard, block, parts = key, None, ([], [], [])
                if not asks:
                    for part, value in zip(parts, (vec_id, label, v)):
                        part.append(value)
                elif parts[0]:
                    if block is None:
                        block = SortedLists(*parts)
                    out += answer(block, (vec_id, label, v, positives))
            got = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in got], names)

    return rows.repartition("shard").sortWithinPartitions("shard", "asks").mapInArrow(run, schema)


def integer_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, v): rows that take part, each component as floor(scale * x)."""
    v = F.col(vector_col)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & usable).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), whole.alias("v")
    )


def blocks_for(rows: int, parallel: int) -> int:
    """Blocks of bounded size, as many as can run at once where rows suffice."""
    return max(-(-rows // BLOCK_ROWS), min(parallel, -(-rows // LEAST_ROWS)), 1)


def mined(
    df: DataFrame, anchors: Callable[[Column], Column], id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Runs jobs.

    ``anchors`` tells by the id which rows ask. A window holds the scores from ``low_percent`` to ``high_percent`` of the
    positive's score; below zero it is empty, since the first bound then exceeds the second.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = stored(integer_rows(df, id_col, vector_col, label_col, scale), "vectors")
    blocks = blocks_for(rows.count(), 2 * spark.sparkContext.defaultParallelism)
    asking = stored(
        rows.where(anchors(F.col("vec_id"))).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v"),
        "anchors",
    )
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("long")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    pairs = "array<struct<id: bigint, score: bigint>>"

    def shards(key: Callable[[Column], Column], queries: DataFrame, asked: Column) -> DataFrame:
        held = rows.select(key(block).alias("shard"), F.lit(False).alias("asks"), "vec_id", "label", "v", F.lit(None).cast(pairs).alias("positives"))
        to_all = queries.withColumn("block", every)
        return held.unionByName(to_all.select(key(F.col("block")).alias("shard"), F.lit(True).alias("asks"), "vec_id", "label", "v", asked.alias("positives")))

    def same_label(lists: SortedLists, query: tuple) -> list[tuple]:
        vec_id, label, v, _ = query
        at, scores = threshold_search(
            lists, v, (lists.labels == label) & (lists.ids != vec_id), [(float("-inf"), float("inf"))], positives
        )
        best = best_of(lists, at, scores, float("-inf"), float("inf"), positives)
        return [(vec_id, int(lists.ids[at[i]]), int(scores[i])) for i in best]

    def other_labels(lists: SortedLists, query: tuple) -> list[tuple]:
        vec_id, label, v, wanted = query
        windows = [(-(-low_percent * p["score"] // 100), high_percent * p["score"] // 100) for p in wanted]
        at, scores = threshold_search(lists, v, lists.labels != label, windows, negatives)
        return [
            (vec_id, p["id"], p["score"], int(lists.ids[at[i]]), int(scores[i]))
            for p, (low, high) in zip(wanted, windows) for i in best_of(lists, at, scores, low, high, negatives)
        ]

    def ranked(found: DataFrame, group: list[str], row_id: str, score: str, k: int) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc(score), row_id)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # A shard of the first search is one label of one block.
    by_label = shards(lambda b: F.xxhash64("label", b), asking, F.lit(None).cast(pairs))
    best = ranked(
        _searched(by_label, same_label, "anchor_id long, positive_id long, positive_score long", ["anchor_id", "positive_id", "positive_score"]),
        ["anchor_id"], "positive_id", "positive_score", positives,
    )
    chosen = best.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    queries = stored(asking.join(chosen, asking["vec_id"] == chosen["anchor_id"]).select("vec_id", "label", "v", "positives"), "windows")
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = _searched(shards(lambda b: b, queries, F.col("positives")), other_labels, ", ".join(f"{n} long" for n in names), names)
    return ranked(found, ["anchor_id", "positive_id"], "negative_id", "negative_score", negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
