"""Language identification in two steps: family first, then one-versus-one support vector machines inside it.

A text becomes the square roots of its hashed letter n-gram shares (one to three letters, case folded, all
non-letters one blank), over the whole text. One linear machine per family decides the family. Inside it each
pair of languages has a machine of its own; the language with most votes wins, ties by summed margins.

Machines are fitted on at most ``PER_LANGUAGE`` labelled rows a language, those with the smallest hash of their id;
rows are hashed in tasks, so the driver holds that many sparse rows at most. Weights have a fixed size per
machine and travel with the task.

Edge cases: a NULL text, and one without any letter, is ``und`` with score 0. Without labelled rows all texts
are ``und``. With one learned language every text with a letter has it. A language outside ``FAMILIES`` is a
family of its own. Repeated rows and ties get equal answers. Other columns pass through if asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tierflow.llm.common import small_batches, stored

# Language codes by family.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca"],
    "slavic": ["ru", "uk", "pl", "cs", "bg", "sr"],
}
UNDETERMINED = "und"
#: Labelled rows a language that are fitted at most, and hashed features.
PER_LANGUAGE, WIDTH = 800, 4096
_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])


def counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of a text; None without a letter."""
    if text is None or not _LETTER.search(text):
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = codes < 0x10000
    c = np.where(low & _IS_LETTER[np.where(low, codes, 0)] | ~low, codes, 32).astype(np.uint32)
    c = np.concatenate(([32], c, [32])).astype(np.uint32)
    one = c * np.uint32(2654435761)
    two = one[:-1] * np.uint32(31) + c[1:] * np.uint32(2246822519)
    three = two[:-1] * np.uint32(31) + c[2:] * np.uint32(3266489917)
    total = np.zeros(WIDTH, np.int64)
    for h in (one, two, three):
        total += np.bincount((h ^ (h >> np.uint32(15))) & np.uint32(WIDTH - 1), minlength=WIDTH)
    return total


def features(text: str | None) -> np.ndarray | None:
    n = counts(text)
    return None if n is None else np.sqrt(n / n.sum()).astype(np.float32)


def support_vector_machine(x: np.ndarray, y: np.ndarray, penalty: float = 30.0, steps: int = 150) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss, by accelerated gradient steps; y is +1 or -1.

    Both sides weigh the same however many rows they have.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = previous = np.zeros(x.shape[1], np.float32)
    rate = 1.0 / (1.0 + 4.0 * penalty)  # rows have norm sqrt(2) at most
    for t in range(1, steps + 1):
        at = w + (t - 1) / (t + 2) * (w - previous)
        lack = np.maximum(0, 1 - y * (x @ at))
        gradient = at - 2 * penalty * ((share * lack * y) @ x)
        previous, w = w, at - rate * gradient
    return w


@dataclass
class Machines:
    families: list[list[str]]
    family_weights: np.ndarray  # features + 1 by families
    pairs: list[tuple[str, str]]
    pair_weights: np.ndarray

    def predict(self, x: np.ndarray | None) -> tuple[str, float]:
        if x is None or not self.families:
            return UNDETERMINED, 0.0
        score, place = 1.0, 0
        if len(self.families) > 1:
            margins = x @ self.family_weights[:-1] + self.family_weights[-1]
            order = np.argsort(-margins, kind="stable")
            place = int(order[0])
            score *= _sigmoid(2 * (margins[order[0]] - margins[order[1]]))
        languages = self.families[place]
        if len(languages) == 1:
            return languages[0], score
        votes, sums, sure = dict.fromkeys(languages, 0), dict.fromkeys(languages, 0.0), {}
        for k, (a, b) in enumerate(self.pairs):
            if a in votes and b in votes:
                m = float(x @ self.pair_weights[:-1, k] + self.pair_weights[-1, k])
                votes[a if m >= 0 else b] += 1
                sums[a] += m
                sums[b] -= m
                sure.setdefault(a, []).append(_sigmoid(2 * m))
                sure.setdefault(b, []).append(_sigmoid(-2 * m))
        best = max(languages, key=lambda v: (votes[v], sums[v]))
        return best, float(score * np.mean(sure[best]))


def _sigmoid(v: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(v, -50, 50))))


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE) -> Machines:
    """Fit on rows with a label, at most ``per_language`` of each language. Runs a job."""
    small_batches(labelled.sparkSession)
    order = [F.xxhash64(F.col(id_col).cast("string")), F.col(id_col)]
    ranked = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.row_number().over(Window.partitionBy(lang_col).orderBy(*order)).alias("place"),
    )
    chosen = stored(ranked.where(F.col("place") <= per_language).select("id", "lang").distinct(), "fit-rows")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, x) for lang, x in zip(batch.column(1).to_pylist(), map(features, batch.column(0).to_pylist())) if x is not None]
            places = [np.flatnonzero(x).astype(np.int16) for _, x in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, _ in rows], pa.string()),
                    pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array([x[p].tobytes() for (_, x), p in zip(rows, places)], pa.binary()),
                ],
                ["lang", "places", "shares"],
            )

    texts = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = (
        texts.join(chosen, ["id", "lang"], "left_semi").select("text", "lang")
        .mapInArrow(sparse, "lang string, places binary, shares binary").toArrow()
    )
    lang = np.array(rows.column("lang").to_pylist(), dtype=object)
    x = np.zeros((len(lang), WIDTH), np.float32)
    for i, (p, v) in enumerate(zip(rows.column("places").to_pylist(), rows.column("shares").to_pylist())):
        x[i, np.frombuffer(p, np.int16)] = np.frombuffer(v, np.float32)
    learned = sorted(set(lang))
    known = {code: name for name, codes in FAMILIES.items() for code in codes}
    grouped: dict[str, list[str]] = {}
    for code in learned:
        grouped.setdefault(known.get(code, code), []).append(code)
    families = [grouped[k] for k in sorted(grouped)]
    machine = lambda keep, plus: support_vector_machine(x[keep], np.where(plus[keep], 1, -1).astype(np.float32))
    everything = np.ones(len(lang), bool)
    of_family = [machine(everything, np.isin(lang, f)) for f in families] if len(families) > 1 else []
    pairs = [p for f in families for p in combinations(f, 2)]
    of_pair = [machine(np.isin(lang, p), lang == p[0]) for p in pairs]
    stack = lambda w: np.stack(w, axis=1) if w else np.zeros((WIDTH + 1, 0), np.float32)
    return Machines(families, stack(of_family), pairs, stack(of_pair))


def with_language(
    df: DataFrame, machines: Machines, text_col: str = "text", keep: list[str] | None = None,
    lang_out: str = "lang_pred", score_out: str = "score",
) -> DataFrame:
    """Add the predicted language and its score; only the text is looked at."""
    spark = df.sparkSession
    small_batches(spark)
    kept = df.columns if keep is None else keep
    if clash := {lang_out, score_out} & set(kept):
        raise ValueError(f"columns {sorted(clash)} exist already")
    shared = spark.sparkContext.broadcast(machines)  # a fixed number of weights per machine

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [shared.value.predict(features(t)) for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                [*kept, lang_out, score_out],
            )

    added = [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]
    return df.select(*kept, df[text_col].alias("__text")).mapInArrow(run, T.StructType([*[df.schema[c] for c in kept], *added]))
