"""Phrases against brute force, with tiny tries that burst and spill, filters, ties and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import values

from tierflow.llm import phrase_trie

SCHEMA = "text string, lang string, phrase string, rank int, ids long, f long, n string"


def brute(data, longest=5, least=100, top=2000):
    out = []
    by_lang = {}
    for text, lang in data:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            by_lang.setdefault("und" if lang is None else lang, []).append(re.findall(r"[^\x20\x09]+", piece))
    for lang, pieces in by_lang.items():
        f = Counter(tuple(w[i : i + k]) for w in pieces for k in range(1, longest + 1) for i in range(len(w) - k + 1))
        n, listed = sum(c for p, c in f.items() if len(p) == 1), []
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in some.items():
            if any(b >= a for q, b in some.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, cut = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            listed.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(listed)[:top])]
    return sorted(out)


def mined(rows, data, **options):
    return phrase_trie.mined(rows(SCHEMA, *[(t, lang, "x", 1, 2, 3, "y") for t, lang in data]), **options)


def corpus(seed, n=60):
    r = random.Random(seed)
    phrases = ["New York city", "of the", "in the very Long run", "a\tb", "état é", "x y x y x"]
    out = []
    for _ in range(n):
        words = [r.choice(phrases) if r.random() < 0.4 else f"w{int(r.paretovariate(0.6)) % 300}" for _ in range(r.randrange(0, 80))]
        text = "".join(w + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ", "\x1c"]) for w in words)
        out.append((text, r.choice(["en", "en", "de", None, "und"])))
    return [*out, (None, "en"), ("", None), (" . ,", "de"), ("same same same same same same", "one")]


@pytest.mark.parametrize("least,top", [(4, 2000), (2, 7), (9, 30)])
def test_equal_to_brute_force(rows, least, top):
    data = corpus(least)
    assert values(mined(rows, data, least=least, top=top)) == [tuple(r) for r in sorted(brute(data, least=least, top=top), key=lambda r: [(False, str(v)) for v in r])]


def test_tries_that_burst_and_spill(rows, monkeypatch):
    monkeypatch.setattr(phrase_trie, "LIMIT", 50)
    monkeypatch.setattr(phrase_trie, "BUFFER", 40)
    monkeypatch.setattr(phrase_trie, "BATCH_TEXTS", 3)
    monkeypatch.setattr(phrase_trie, "LEAST_PARTS", 3)
    monkeypatch.setattr(phrase_trie.HatTrie.__init__, "__defaults__", (4,))
    data = corpus(11)
    got = mined(rows, data, least=3, longest=4)
    assert values(got) == sorted(brute(data, 4, 3), key=lambda r: [(False, str(v)) for v in r])


def test_a_trie_keeps_its_counts():
    r = random.Random(1)
    trie, want = phrase_trie.HatTrie(4, burst=3), Counter()
    for _ in range(3000):
        p = tuple(r.randrange(6) for _ in range(4))
        want[p] += 2
        trie.add(p[0], [b"".join(i.to_bytes(8, "little") for i in p[1:])], [2])
    assert trie.held == len(want)
    got = Counter()
    for keep in (200, 10, 0):
        ids, counts = trie.spill(keep)
        assert trie.held <= keep and sum(trie.sizes.values()) == trie.held
        got.update(dict(zip(map(tuple, ids.tolist()), counts.tolist())))
    assert got == want


def test_counts_beyond_64_bits(rows, monkeypatch):
    """Products of counts are decimals: billions of repeated words would overflow a long."""
    many = 3_000_000_000
    spark_words = rows("id long, lang string, word string, f long", (1, "en", "a", many), (2, "en", "b", many))
    phrases = rows("ids array<long>, f long", ([1, 2], many - 1))
    totals = rows("lang string, n long", ("en", 9 * many))
    monkeypatch.setattr(phrase_trie, "counted_phrases", lambda *_: (spark_words, phrases, totals))
    assert values(mined(rows, [])) == [("en", 1, "a b", many - 1, many, many, 9 * many, 1000 * (many - 1) * 9 * many // (many * many))]


def test_empty_table_and_no_phrase(rows):
    assert mined(rows, []).count() == 0
    assert mined(rows, [(None, None), ("a b", "en")]).count() == 0


def test_a_very_long_text_and_ties(rows):
    data = [("q r s t " * 20_000, "en"), ("k l. m n. " * 150, "de")]
    got = values(mined(rows, data))
    assert got == sorted(brute(data), key=lambda r: [(False, str(v)) for v in r])
    assert [r[2] for r in got if r[0] == "de"] == ["k l", "m n"]


def test_filter_has_no_misses(rows):
    ids = np.random.default_rng(2).integers(-(2**62), 2**62, 3000)
    held = phrase_trie.filter_of(rows("hash long", *[(int(i),) for i in ids]))
    other = np.random.default_rng(3).integers(-(2**62), 2**62, 3000)
    assert held.holds(ids.view(np.uint64)).all() and held.holds(other.view(np.uint64)).mean() < 0.05
