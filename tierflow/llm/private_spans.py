"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Spans of four kinds are proposed from whole texts: first the fixed base patterns, then wider ones that find
what the base rules skip (a number glued to another one, a phone number without a country code, an address
written with words for its signs). Labelers of three sorts vote yes, no or nothing on every proposal: format
regexes and check digits, gazetteers of endings and prefixes, and the context around it. Votes are
conditionally independent given the truth; expectation-maximisation estimates the reliability of each
labeler per kind from counts of vote patterns. The resulting probabilities train a logistic span classifier
on shape features of the proposals, and a proposal with probability one half or more is a span.

Proposals of all documents are reduced to counts of (votes, features) inside tasks; both have a fixed number
of values, so what reaches the driver has a bound that does not depend on the data, and no row is left out.
Base spans always stay. Wider proposals that overlap a base span or an earlier accepted one are dropped.

Edge cases: a NULL text counts as empty and has no span (a redacted NULL stays NULL). Places are code points,
ends exclusive. Very long texts take time in proportion to their length. Without proposals no classifier is
fitted and base spans alone are returned. Other columns pass through if asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits starts a match at its own start or nowhere, so the look-behind changes no match.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY_DIGIT = re.compile(r"[0-9]")

# Wider proposals.
_CARD_RUN = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])")
_PHONE_SHAPE = re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SPELT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{2,63}(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z]{2,63})+")

# Gazetteers: fixed values.
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn in br ru ch at be".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "6011", "65", "35", "30", "36", "38")
KEYWORDS = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"),
}
AGAINST = ("version", "password", "key", "token", "id", "order", "invoice")


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the base pattern: the run of local characters before each @, then the longest domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and non-overlapping per kind; failing matches are dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _ANY_DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def wider_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further proposals that touch no base span and, per kind, no earlier proposal."""
    out, taken = [], [(a, b) for _, a, b in base]
    found = []
    if "[" in text or "(" in text:
        found += [("email", *m.span()) for m in _SPELT.finditer(text)]
    if _ANY_DIGIT.search(text):
        found += [("card", *m.span()) for m in _CARD_RUN.finditer(text)]
        found += [("phone", *m.span()) for m in _PHONE_SHAPE.finditer(text)]
    for kind, a, b in found:
        if not any(a < y and x < b for x, y in taken):
            out.append((kind, a, b))
            taken.append((a, b))
    return out


#: Number of labelers; each votes 1 (yes), 0 (nothing) or -1 (no).
LABELERS = ("format", "check", "gazetteer", "border", "keyword")


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    span, number = text[start:end], digits(text[start:end])
    left, right = text[start - 1 : start], text[end : end + 1]
    around = text[max(0, start - 24) : start].lower()
    if kind == "email":
        name, _, domain = span.rpartition("@")
        last = re.split(r"[^A-Za-z0-9]+", span.rstrip("])"))[-1].lower()
        shape = 1 if name and re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", span) else 0
        check = 1 if last.isalpha() and 2 <= len(last) <= 6 else -1
        listed = 1 if last in ENDINGS else 0
    elif kind == "ip":
        parts = span.split(".")
        shape = 1 if all(p == "0" or p[0] != "0" for p in parts) else -1
        check = 1 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        listed = -1 if parts[0] in ("0", "127", "255") else 1
    elif kind == "card":
        shape = 1 if re.fullmatch(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}", span) else 0
        check = 1 if luhn(number) else -1
        listed = 1 if number.startswith(CARD_PREFIXES) else -1
    else:
        shape = 1 if re.fullmatch(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}", span) else 0
        check = 1 if 10 <= len(number) <= 13 else 0 if 9 <= len(number) <= 15 else -1
        listed = 1 if span.startswith("+") or "(" in span else 0
    border = 1 if not (left.isalnum() or right.isalnum() or left in "=_/" and left or right in "=_/" and right) else -1
    keyword = 1 if any(k in around for k in KEYWORDS[kind]) else -1 if any(k + "=" in around or k + ":" in around for k in AGAINST) else 0
    return shape, check, listed, border, keyword


def shape_features(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Bucketed features for the classifier; every one has a fixed number of values."""
    span = text[start:end]

    def side(c: str) -> int:
        return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4

    marks = sum(not c.isalnum() for c in span)
    return (
        KINDS.index(kind), min(len(span) // 4, 9), min(len(digits(span)) // 2, 9), min(marks, 7),
        side(text[start - 1 : start]), side(text[end : end + 1]), int(kind == "card" and luhn(digits(span))),
    )


_FEATURE_SIZES = (4, 10, 10, 8, 5, 5, 2)


# What is believed of a labeler before any data: chances of (no, nothing, yes) if true and if false, and how many
# rows that belief is worth as a share of all. Check digits and number ranges are known to be dependable.
_BELIEF = {"check": ((0.001, 0.04, 0.959), (0.75, 0.10, 0.15), 5.0)}
_OTHER = ((0.10, 0.30, 0.60), (0.50, 0.30, 0.20), 0.1)


def estimate(patterns: dict[tuple[int, ...], float], rounds: int = 60) -> dict[tuple[int, ...], float]:
    """Probability of truth for each vote pattern of one kind, by EM over the labelers' reliabilities.

    A labeler answers yes, nothing or no with chances that depend on the truth alone.
    """
    keys = list(patterns)
    answers, weight = np.array(keys) + 1, np.array([patterns[k] for k in keys], float)
    beliefs = [_BELIEF.get(name, _OTHER) for name in LABELERS]
    chances = [(np.array(t), np.array(f)) for t, f, _ in beliefs]
    prior = 0.5
    for _ in range(rounds):
        score = np.full(len(keys), np.log(prior) - np.log1p(-prior))
        for j, (yes, no) in enumerate(chances):
            score += np.log(yes[answers[:, j]]) - np.log(no[answers[:, j]])
        truth = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        prior = (weight @ truth + 1) / (weight.sum() + 2)
        for j, (true, false, share) in enumerate(beliefs):
            worth, updated = 5 + share * weight.sum(), []
            for belief, side in ((true, truth), (false, 1 - truth)):
                seen = worth * np.array(belief) + np.bincount(answers[:, j], weight * side, minlength=3)
                updated.append(seen / seen.sum())
            chances[j] = tuple(updated)
    return dict(zip(keys, truth.tolist()))


@dataclass
class SpanClassifier:
    """Logistic weights over one-hot shape features, per kind."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @staticmethod
    def places(f: tuple[int, ...]) -> list[int]:
        out, start = [], 1
        for value, size in zip(f[1:], _FEATURE_SIZES[1:]):
            out.append(start + value)
            start += size
        return [f[0] * start + p for p in [0, *out]]

    @classmethod
    def width(cls) -> int:
        return _FEATURE_SIZES[0] * (1 + sum(_FEATURE_SIZES[1:]))

    def probability(self, f: tuple[int, ...]) -> float:
        if not self.weights.size:
            return 0.0
        return float(1 / (1 + np.exp(-self.weights[self.places(f)].sum())))

    @classmethod
    def fit(cls, rows: list[tuple[tuple[int, ...], float, float]], steps: int = 400, rate: float = 0.5) -> SpanClassifier:
        """rows: features, weight, probability of truth. Full gradient over all counts."""
        if not rows:
            return cls()
        x = np.zeros((len(rows), cls.width()))
        for i, (f, _, _) in enumerate(rows):
            x[i, cls.places(f)] = 1
        weight = np.array([w for _, w, _ in rows])
        target, w = np.array([t for _, _, t in rows]), np.zeros(cls.width())
        kind_total = np.bincount([f[0] for f, _, _ in rows], weight, minlength=len(KINDS))
        share = weight / kind_total[[f[0] for f, _, _ in rows]]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w -= rate * (x.T @ (share * (p - target)) + 1e-4 * w)
        return cls(w)


def fit(df: DataFrame, text_col: str = "text") -> SpanClassifier:
    """Train on the proposals of all documents. Runs a job that returns counts of vote and feature values."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    base = base_spans(text)
                    for s in [*base, *wider_spans(text, base)]:
                        key = (*votes(text, *s), *shape_features(text, *s))
                        seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(map(list, seen)), pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())], ["key", "n"]
        )

    counted = df.select(text_col).mapInArrow(run, "key array<int>, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    k, patterns = len(LABELERS), [{} for _ in KINDS]
    for row in counted:
        by = patterns[row["key"][k]]
        by[tuple(row["key"][:k])] = by.get(tuple(row["key"][:k]), 0) + row["n"]
    truth = [estimate(p) if p else {} for p in patterns]
    return SpanClassifier.fit(
        sorted((tuple(r["key"][k:]), float(r["n"]), truth[r["key"][k]][tuple(r["key"][:k])]) for r in counted)
    )


def spans(text: str | None, classifier: SpanClassifier) -> tuple[list, list]:
    """(base spans, all spans) by kind as listed, then start."""
    if not text:
        return [], []
    order = lambda s: (KINDS.index(s[0]), s[1])
    base = base_spans(text)
    more = [s for s in wider_spans(text, base) if classifier.probability(shape_features(text, *s)) >= 0.5]
    return sorted(base, key=order), sorted(base + more, key=order)


SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())
]))
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def redacted(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """The text with each span replaced by its kind's label; of overlapping spans the first start wins."""
    if not found:
        return text
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], LABELS[kind]]
        at = max(at, b)
    return "".join([*out, text[at:]])


def with_spans(
    df: DataFrame, classifier: SpanClassifier, text_col: str = "text", keep: list[str] | None = None, redact_as: str | None = None
) -> DataFrame:
    """Add ``base_spans`` and ``all_spans``, and the redacted text under the name ``redact_as``."""
    small_batches(df.sparkSession)
    kept = df.columns if keep is None else keep
    added = ["base_spans", "all_spans", *([redact_as] if redact_as else [])]
    if clash := set(added) & set(kept):
        raise ValueError(f"columns {sorted(clash)} exist already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_rows = lambda found: [{"kind": k, "start": a, "end": b} for k, a, b in found]
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            out = [spans(t, classifier) for t in texts]
            arrays = [pa.array([as_rows(o[i]) for o in out], _SPAN_TYPE) for i in (0, 1)]
            if redact_as:
                arrays.append(pa.array([redacted(t, o[1]) for t, o in zip(texts, out)], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *arrays], [*kept, *added])

    fields = [df.schema[c] for c in kept] + [T.StructField("base_spans", SPAN), T.StructField("all_spans", SPAN)]
    if redact_as:
        fields.append(T.StructField(redact_as, T.StringType()))
    return df.select(*kept, df[text_col].alias("__text")).mapInArrow(run, T.StructType(fields))
