"""The shingle join against brute force: near copies, families, shared passages, sizes at the bound, odd rows."""

import random
from itertools import combinations

import numpy as np
import pytest
from conftest import values

from tierflow.llm import shingle_join

SCHEMA = "doc_id long, text string, node long, size int, shingle string, key long, count long"


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(texts, k=5, percent=80):
    sets = [shingles(t, k) for _, t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc, _) in enumerate(texts):
        groups.setdefault(find(i), []).append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(doc, len(sets[i]), least[find(i)] if sets[i] else doc) for i, (doc, _) in enumerate(texts)]


def joined(rows, texts, **options):
    out = shingle_join.jaccard_components(rows(SCHEMA, *[(d, t, 1, 2, "x", 3, 4) for d, t in texts]), **options)
    return values(out.select("doc_id", "n_shingles", "component_id"))


def agree(rows, texts, **options):
    k, percent = options.get("shingle_words", 5), options.get("percent", 80)
    want = sorted(brute(texts, k, percent), key=lambda r: [(v is None, str(v)) for v in r])
    assert joined(rows, texts, **options) == want


def changed(r, words, n):
    out = list(words)
    for _ in range(n):
        out[r.randrange(len(out))] = f"x{r.randrange(10**6)}"
    return out


def corpus(seed):
    """Families of near copies about the bound, shared passages, tiny texts."""
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for family in range(12):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([6, 9, 14, 30, 80, 200]))]
        for _ in range(r.choice([1, 2, 3, 6])):
            texts.append(" ".join(changed(r, base, r.randrange(0, max(2, len(base) // 40 + 2)))))
            texts.append(" ".join(base[: len(base) - r.randrange(0, max(1, len(base) // 5))]))
    for _ in range(40):  # two thirds shared, a third their own: not similar
        texts.append(" ".join(passage + [f"u{r.randrange(10**6)}" for _ in range(30)]))
    for _ in range(40):  # more shared: similar
        texts.append(" ".join(passage + [f"u{r.randrange(10**6)}" for _ in range(r.randrange(0, 9))]))
    texts += ["one", "One", "one two three four", "one two three four five", "", " \n ", None, None]
    return [(i, t) for i, t in enumerate(texts)]


def test_equal_to_brute_force(rows):
    agree(rows, corpus(1))


@pytest.mark.parametrize("percent", [60, 80, 93])
def test_large_groups_in_chunks(rows, monkeypatch, percent):
    monkeypatch.setattr(shingle_join, "SMALL_GROUP", 1)
    monkeypatch.setattr(shingle_join, "GROUP_ROWS", 8)
    monkeypatch.setattr(shingle_join, "NUMBER_ROWS", 64)
    monkeypatch.setattr(shingle_join, "HELD_PAIRS", 100)
    monkeypatch.setattr(shingle_join, "FIRST_ROUND", 1)
    monkeypatch.setattr(shingle_join, "ROUND_GROWTH", 2)
    agree(rows, corpus(percent), percent=percent)


def test_one_large_family_and_a_chain(rows):
    r = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    family = [" ".join(changed(r, base, 2)) for _ in range(150)]
    chain = [" ".join(f"c{j}" for j in range(i, i + 100)) for i in range(0, 200, 8)]
    agree(rows, list(enumerate(family + chain)))


def test_odd_ids_and_repeated_rows(rows):
    text = "a b c d e f g h i j k l m n o p"
    agree(rows, [(None, text), (7, text), (7, text), (3, text + " q"), (3, "other words are here now"), (None, "only null ids here ok"), (5, None), (5, "")])


def test_empty_table_and_text_ids(spark, rows):
    assert joined(rows, []) == []
    named = rows("doc_id string, text string", ("b", "x y z u v w"), ("a", "X y z u v w"), ("c", None))
    assert values(shingle_join.jaccard_components(named)) == [("a", 2, "a"), ("b", 2, "a"), ("c", 0, "c")]


def test_very_long_texts(rows):
    words = [f"l{i}" for i in range(30_000)]
    near = list(words)
    for i in range(0, 30_000, 50):  # 600 changes touch 3,000 of 29,996 shingles: a similarity of 0.818
        near[i] = "x"
    agree(rows, [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:20_000]))])


def test_pigeonhole_for_pairs_at_the_bound():
    """Whatever the costs, the larger set's probes meet the other's index."""
    r, bands = random.Random(8), shingle_join.Bands(80)
    costs = shingle_join.Costs([r.randrange(-(2**62), 2**62) for _ in range(50)], [5] * 50, 1000)
    for _ in range(400):
        a = r.choice([4, 5, 7, 11, 30, 90, 400])
        one = np.array([r.randrange(2**63) for _ in range(a)], np.uint64)
        gone, new = r.randrange(0, a // 5 + 1), r.randrange(0, a // 4 + 1)
        two = np.concatenate((one[gone:], np.array([r.randrange(2**63) for _ in range(new)], np.uint64)))
        shared, union = a - gone, a + new
        if gone + new == 0 or 100 * shared < 80 * union:
            continue
        costs.keys = np.sort(r.sample(one.tolist(), min(a, 50)))
        costs.keys, costs.counts = np.array(costs.keys, np.uint64), np.arange(1, len(costs.keys) + 1) * 7
        large, small = (one, two) if len(one) >= len(two) else (two, one)
        (k1, r1), (k2, r2) = (shingle_join.entries(np.unique(s), bands, costs) for s in (large, small))
        assert set(k1[r1 & np.uint64(2) > 0].tolist()) & set(k2[r2 & np.uint64(1) > 0].tolist())


def test_first_shingles_of_pairs_at_the_bound_meet():
    r, bands = random.Random(9), shingle_join.Bands(80)
    for _ in range(400):
        a = r.choice([1, 4, 5, 7, 11, 30, 90, 400])
        one = [r.randrange(2**63) for _ in range(a)]
        gone, new = r.randrange(0, a // 5 + 1), r.randrange(0, a // 4 + 1)
        two = one[gone:] + [r.randrange(2**63) for _ in range(new)]
        if 100 * (a - gone) < 80 * (a + new):
            continue
        costs = shingle_join.Costs([], [], 1000)
        costs.keys = np.sort(np.array(r.sample(one, min(a, 50)), np.uint64))
        costs.counts = np.array([r.randrange(2, 9) for _ in costs.keys])
        (k1, r1), (k2, r2) = (shingle_join.first_shingles(np.unique(np.array(s, np.uint64)), bands, costs) for s in (one, two))
        assert set(k1.tolist()) & set(k2.tolist()) and set(r1.tolist()) == set(r2.tolist()) == {shingle_join.INDEX | shingle_join.PROBE}
        assert len(k1) <= a // 5 + 1


def test_sketches_bound_the_difference():
    r = np.random.default_rng(4)
    for n in (3, 70, 900, 9000):
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate((a[n // 3 :], r.integers(0, 2**63, n).astype(np.uint64)))
        one, two = shingle_join.parity(a), shingle_join.parity(b)
        words = min(len(one), len(two))
        apart = int(np.bitwise_count(shingle_join.folded(one, words) ^ shingle_join.folded(two, words)).sum())
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))
        assert (shingle_join.folded(one, 1) == shingle_join.parity_words(a, 1)).all()


def test_lossy_counts_never_lose_a_frequent_shingle(monkeypatch):
    monkeypatch.setattr(shingle_join, "BUFFER", 50)
    counter = shingle_join.FrequentShingles(0.1)
    for i in range(200):
        counter.add(shingle_join.shingle_sets([f"a b c d e {i} f g h i j k l" if i % 5 == 0 else f"{i} {i}x y z u v w"], 5)[0])
    counter.prune()
    common = shingle_join.shingle_sets(["a b c d e"], 5)[0][0]
    assert common in counter.keys and counter.counts[counter.keys == common][0] >= 20
