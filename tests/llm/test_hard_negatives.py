"""Hard negatives against brute force, with ties, repeats, odd vectors and unusable rows."""

import math
import random

import numpy as np
from conftest import values

from tierflow.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score double, shard string, anchor_id long"


def brute(data, is_anchor, k=5, n=10):
    rows = {}
    for i, v, label, *_ in data:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        rows[i] = min(rows.get(i, row), row)
    out = []
    for a, (label, av) in rows.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, other) for i, (other, v) in rows.items() if i != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:k]:
            inside = [(s, i) for s, i, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p]
            out += [(a, pid, rank + 1, i, -p, -s) for rank, (s, i) in enumerate(inside[:n])]
    return sorted(out)


def mined(rows, data, **options):
    return hard_negatives.mined(rows(SCHEMA, *data), lambda i: i % 3 == 0, **options)


def sample(seed, n, dims, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) + 0.5 for _ in range(dims)], r.randrange(3), 1.0, "x", 7) for i in range(n)]


def test_equal_to_brute_force(rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 16)  # several blocks
    monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", 2)
    for seed, n, dims in ((1, 90, 6), (2, 60, 1)):
        data = sample(seed, n, dims)
        assert values(mined(rows, data)) == values(rows("a long, b long, c int, d long, e long, f long", *brute(data, lambda i: i % 3 == 0)))


def test_ties_repeats_and_unusable_rows(rows):
    same = [(i, [0.5, 0.25], 0 if i < 6 else 1, None, None, None) for i in range(30)]  # all scores tie
    odd = [
        (31, None, 1, None, None, None), (32, [1.0, None], 1, None, None, None), (33, [float("nan"), 1.0], 0, None, None, None),
        (34, [float("inf"), 1.0], 0, None, None, None), (None, [1.0, 1.0], 0, None, None, None), (36, [1.0, 1.0], None, None, None, None),
        (39, [], 0, None, None, None), (42, [0.1], 1, None, None, None), (45, [0.1, 0.3, 5.0], 0, None, None, None), (48, [-1.0, 0.0], 0, None, None, None),
        (51, [3e30, -3e30], 1, None, None, None),  # saturates
        (6, [0.5, 0.25], 1, None, None, None), (6, [0.5, 0.25], 2, None, None, None), (9, [0.9, 0.1], 1, None, None, None),
    ]
    data = [*same, *odd]
    assert mined(rows, data).count() > 0
    plain = [r for r in data if r[0] != 51]
    filled = [(i, v if v is None else v + [0.0] * (3 - len(v)), label) for i, v, label, *_ in plain]
    assert values(mined(rows, plain)) == values(rows("a long, b long, c int, d long, e long, f long", *brute(filled, lambda i: i % 3 == 0)))


def test_scores_beyond_doubles_are_exact(rows):
    data = [(0, [float(2**24), 1 / 256], 0), (1, [float(2**14), 1 / 256], 0), (2, [float(2**13), 3 / 256], 1), (3, [float(2**13), 2 / 256], 1)]
    data = [(*d, None, None, None) for d in data]
    got = [tuple(r) for r in hard_negatives.mined(rows(SCHEMA, *data), lambda i: i == 0).collect()]
    assert got and sorted(got) == brute(data, lambda i: i == 0)


def test_empty_table_and_no_anchor(rows):
    assert mined(rows, []).count() == 0
    assert hard_negatives.mined(rows(SCHEMA, *sample(3, 9, 2)), lambda i: i < 0).count() == 0


def test_search_stops_before_the_end():
    r = np.random.default_rng(5)
    vectors = (r.normal(size=(4000, 3)) * 100).astype(int)
    block = hard_negatives.SortedLists(list(range(4000)), [0] * 4000, vectors.tolist())
    at, scores = hard_negatives.threshold_search(block, [3, -2, 0], np.ones(4000, bool), [(-math.inf, math.inf)], 5)
    exact = vectors @ np.array([3, -2, 0])
    assert len(at) < 2000 and sorted(scores.tolist())[-5:] == sorted(exact.tolist())[-5:]
