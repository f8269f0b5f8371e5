"""Toxicity as ordered severity grades by a cumulative-link model over sparse text features.

Features are hashed letter n-grams (five and six characters, case folded, words set off by blanks). A screening
pass keeps those that occur clearly more often in graded texts above zero. The model has one weight per feature,
shared by all thresholds: P(grade <= k) = sigmoid(threshold[k] - w.x), thresholds in ascending order by
construction. It returns the expected severity, the sum over k of P(grade >= k).

The fit uses at most ``PER_GRADE`` labelled rows of each label, those with the smallest hash of their id; the
screening counts have one number per hash value, and the driver sees only the screened features of those rows.
Scoring is one pass over whole texts with weights of a fixed size.

Edge cases: NULL and empty texts have no features and the grade the thresholds give to none. Without labelled
rows above zero all grades are 0. NULL labels are not used; a document with several labels has the largest.
Repeated rows get equal grades. Other columns pass through if asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tierflow.llm.common import small_batches, stored

WIDTH = 1 << 18
PER_GRADE, FEATURES = 4000, 3000
#: A screened feature occurs in so many graded texts at least, and so many times more often than in others.
LEAST_TEXTS, LEAST_RATIO = 4, 8.0
_GAP = re.compile(r"[\W\d_]+")


def grams(text: str | None) -> np.ndarray:
    """Hashes of all five- and six-character runs of a text."""
    plain = " " + _GAP.sub(" ", (text or "").lower()).strip() + " "
    c = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(c) < 5:
        return np.zeros(0, np.int64)
    h = np.zeros(len(c) - 4, np.uint32)
    for i in range(5):
        h = h * np.uint32(2654435761) + c[i : len(c) - 4 + i]
    six = h[:-1] * np.uint32(2654435761) + c[5:]
    both = np.concatenate((h, six))
    both ^= both >> np.uint32(15)
    both *= np.uint32(2246822519)
    return (both >> np.uint32(14)).astype(np.int64)


def sampled(labels: DataFrame, id_col: str, label_col: str, per_label: int = PER_GRADE) -> DataFrame:
    """(id, label) of at most ``per_label`` ids of each label value, by hash of the id."""
    one = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    order = Window.partitionBy("label").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    return one.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label).drop("place")


def screened(texts: DataFrame, features: int = FEATURES) -> np.ndarray:
    """Feature numbers that tell rows with label above 0 from the others. ``texts``: (text, label). Runs a job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean, graded = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
        rows = [0, 0]
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                present = np.unique(grams(text))
                (graded if label > 0 else clean)[present] += 1
                rows[label > 0] += 1
        seen = np.flatnonzero(graded)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(graded[seen], rows[1])), pa.array(np.append(clean[seen], rows[0]))],
            ["feature", "graded", "clean"],
        )
        # Clean counts of features that this task has in clean rows only may matter with another task's rows.
        rest = np.flatnonzero((graded == 0) & (clean > 0))
        yield pa.RecordBatch.from_arrays([pa.array(rest), pa.array(np.zeros(len(rest), np.int64)), pa.array(clean[rest])], ["feature", "graded", "clean"])

    counted = texts.select("text", "label").mapInArrow(run, "feature long, graded long, clean long")
    sums = counted.groupBy("feature").agg(F.sum("graded").alias("graded"), F.sum("clean").alias("clean"))
    table = sums.where((F.col("graded") >= LEAST_TEXTS) | (F.col("feature") < 0)).toArrow()  # WIDTH + 1 rows at most
    f, g, c = (table.column(i).to_numpy() for i in range(3))
    all_g, all_c = int(g[f < 0].sum()), int(c[f < 0].sum())
    ratio = ((g + 0.5) / (all_g + 1)) / ((c + 0.5) / (all_c + 1))
    keep = (f >= 0) & (ratio >= LEAST_RATIO)
    order = np.lexsort((f[keep], -g[keep] * np.log(ratio[keep])))
    return np.sort(f[keep][order][:features])


@dataclass
class CumulativeLink:
    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def values(self, text: str | None) -> np.ndarray:
        """log(1 + count) of each screened feature."""
        if self.__dict__.get("_place") is None:  # built once per worker: the number of a hash among the features
            self._place = np.full(WIDTH, -1, np.int32)
            self._place[self.features] = np.arange(len(self.features))
        place = self._place[grams(text)]
        return np.log1p(np.bincount(place[place >= 0], minlength=len(self.features)))

    def at_least(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return _sigmoid(x @ self.weights - self.thresholds)


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def fit_link(x: np.ndarray, grade: np.ndarray, penalty: float = 1e-3, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by gradient steps with adapted rates; every grade weighs the same."""
    top = int(grade.max(initial=0))
    share = 1 / np.bincount(grade, minlength=top + 1)[grade] / (top + 1)
    w, low, gaps = np.zeros(x.shape[1]), np.zeros(1), np.zeros(max(top - 1, 0))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, low, gaps)]
    for t in range(1, steps + 1):
        theta = np.concatenate((low, low + np.cumsum(np.exp(gaps))))
        z = (x @ w.astype(x.dtype)).astype(float)  # one precision, or every step would copy x
        # Density of a grade: difference of neighbouring cumulative probabilities.
        cumulative = np.column_stack((np.zeros(len(z)), _sigmoid(theta[None, :] - z[:, None]), np.ones(len(z))))
        p = np.maximum(cumulative[np.arange(len(z)), grade + 1] - cumulative[np.arange(len(z)), grade], 1e-9)
        slope = cumulative * (1 - cumulative)
        upper, lower = slope[np.arange(len(z)), grade + 1], slope[np.arange(len(z)), grade]
        dz = share * (upper - lower) / p
        dtheta = np.zeros(top)
        for k in range(top):
            dtheta[k] = -(share / p * upper)[grade == k].sum() + (share / p * lower)[grade == k + 1].sum()
        after = np.cumsum(dtheta[::-1])[::-1]
        gradients = (x.T @ dz.astype(x.dtype) + penalty * w, np.array([after[0]]), after[1:] * np.exp(gaps))
        for parameter, gradient, (m, v) in zip((w, low, gaps), gradients, moments):
            m += 0.1 * (gradient - m)
            v += 0.001 * (gradient**2 - v)
            parameter -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w, np.concatenate((low, low + np.cumsum(np.exp(gaps))))


def texts_of(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, label) of a bounded sample of ids, written once."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return stored(rows.join(F.broadcast(stored(sample, "sample")), "id").select("text", "label"), "sample-texts")


def fit(texts: DataFrame, grade_of=None) -> CumulativeLink:
    """Fit on (text, label) rows of a bounded sample. ``grade_of(label, counts)`` may refine the labels. Runs jobs.

    ``counts``: per row the summed screened features; by default the label is the grade.
    """
    small_batches(texts.sparkSession)
    model = CumulativeLink(screened(texts), np.zeros(0), np.zeros(1))

    def run(batches):
        for batch in batches:
            rows = [model.values(t) for t in batch.column(0).to_pylist()]
            places = [np.flatnonzero(r).astype(np.int32) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1), pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array([r[p].astype(np.float32).tobytes() for r, p in zip(rows, places)], pa.binary()),
                ],
                ["label", "places", "values"],
            )

    rows = texts.select("text", "label").mapInArrow(run, "label int, places binary, values binary").toArrow()
    label = rows.column("label").to_numpy().astype(np.int64)
    if not len(label) or not label.max() or not len(model.features):
        return CumulativeLink(np.zeros(0, np.int64), np.zeros(0), np.array([40.0]))
    x = np.zeros((len(label), len(model.features)), np.float32)
    for i, (p, v) in enumerate(zip(rows.column("places").to_pylist(), rows.column("values").to_pylist())):
        x[i, np.frombuffer(p, np.int32)] = np.frombuffer(v, np.float32)
    order = np.lexsort((x.sum(axis=1), label))  # row order must not depend on how tasks ended
    x, label = x[order], label[order]
    grade = label if grade_of is None else grade_of(label, x.sum(axis=1))
    model.weights, model.thresholds = fit_link(x, grade)
    return model


def halves(label: np.ndarray, amount: np.ndarray) -> np.ndarray:
    """Grades from a yes/no label: 0, 1 for the weaker half of the labelled rows, 2 for the stronger half."""
    labelled = amount[label > 0]
    middle = np.median(labelled)
    strong = amount > middle if (labelled > middle).any() else amount >= middle
    return np.where(label == 0, 0, np.where(strong, 2, 1))


def with_severity(df: DataFrame, model: CumulativeLink, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add grade (most probable), expected_severity and p_toxic = P(grade >= 1)."""
    spark = df.sparkSession
    small_batches(spark)
    kept, added = df.columns if keep is None else keep, ["grade", "expected_severity", "p_toxic"]
    if clash := set(added) & set(kept):
        raise ValueError(f"columns {sorted(clash)} exist already")
    shared = spark.sparkContext.broadcast(model)  # a fixed number of features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        link = shared.value
        for batch in batches:
            tails = np.array([link.at_least(link.values(t)) for t in batch.column(len(kept)).to_pylist()]).reshape(-1, len(link.thresholds))
            chances = -np.diff(np.hstack((np.ones((len(tails), 1)), tails, np.zeros((len(tails), 1)))), axis=1)
            out = [pa.array(chances.argmax(axis=1).astype(np.int32)), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0].copy())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *out], [*kept, *added])

    fields = [df.schema[c] for c in kept] + [
        T.StructField("grade", T.IntegerType()), T.StructField("expected_severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())
    ]
    return df.select(*kept, df[text_col].alias("__text")).mapInArrow(run, T.StructType(fields))
