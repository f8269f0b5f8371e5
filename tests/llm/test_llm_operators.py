"""Edge cases and brute-force comparisons of the training-data operators on small rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations
from math import comb, log10

import numpy as np
import pytest
import xxhash
from conftest import values
from pyspark.sql import functions as F

from tierflow.llm import (
    backoff_automaton,
    components,
    language_families,
    private_spans,
    quality_rules,
    quotation_links,
    sentence_pieces,
    severity_grades,
    shingle_join,
    simhash_trees,
    spaced_seeds,
    warc_bundles,
)
from tierflow.llm.queries import tokenizer_path

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


# --- WARC -----------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, record_type string"


def read_back(spark, pages, **options):
    catalogue = warc_bundles.write_bundles(warc_bundles.planned_records(pages, "page_id", "url", "html"), **options)
    return catalogue, {(r["record_id"], r["payload_digest"]): r for r in warc_bundles.read_bundles(spark, catalogue).collect()}


def test_warc_records_come_back(spark, rows):
    pages = rows(
        PAGES, (3, "u3", "same", "x"), (1, None, "same", None), (2, "a\r\nb", None, "x"), (4, "u4", "", "x"), (5, "ü", "é" * 70_000, "x"), (None, "n", "same", "x"),
    )
    catalogue, got = read_back(spark, pages, frame_bytes=1000, bundle_bytes=4000)
    by_id = {k[0]: r for k, r in got.items()}
    assert (by_id["1"]["record_type"], by_id["3"]["record_type"], by_id["3"]["refers_to"]) == ("response", "revisit", "1")
    assert (by_id["2"]["record_type"], by_id["4"]["refers_to"], by_id["4"]["payload_bytes"]) == ("response", "2", 0)
    assert by_id[None]["record_type"] == "revisit" and by_id["2"]["target_uri"] == "a%0D%0Ab"
    assert bytes(by_id["5"]["payload"]).decode() == "é" * 70_000 and by_id["5"]["payload_bytes"] == 140_000
    # Random access by the catalogue gives the record it names, and the footer knows every frame.
    for entry in catalogue.collect():
        header, _ = warc_bundles.read_record(entry.asDict())
        assert header["WARC-Record-ID"] in ("<urn:row:null>", f"<urn:page:{entry['record_id']}>")
        assert (entry["frame_offset"], entry["frame_bytes"]) in [s[:2] for s in warc_bundles.seek_table(entry["bundle"])]


def test_warc_frames_are_plain_zstandard(spark, rows):
    catalogue, _ = read_back(spark, rows(PAGES, *[(i, "u", prose(i, 50), "x") for i in range(20)]), frame_bytes=2000)
    path = catalogue.first()["bundle"]
    with open(path.removeprefix("file:"), "rb") as f:
        whole = f.read()
    joined = b"".join(warc_bundles.plain_frame(path, at, n) for at, n, _ in warc_bundles.seek_table(path))
    assert whole.startswith(b"\x28\xb5\x2f\xfd") and joined.count(b"WARC/1.1\r\n") == catalogue.filter(F.col("bundle") == path).count()


def test_warc_small_payloads_and_empty_table(spark, rows):
    planned = warc_bundles.planned_records(rows(PAGES, (1, "u", "ab", ""), (2, "u", "ab", "")), "page_id", "url", "html", min_revisit_bytes=3)
    assert [r["record_type"] for r in planned.collect()] == ["response"] * 2
    assert read_back(spark, rows(PAGES))[1] == {}


# --- Quality rules ----------------------------------------------------------------------------------


def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(rows):
    texts = [None, "", " \t\n", "a b", "a b c a b c", "x " * 40, "l1\nl1\n \nl2\nl1", "# a|b <é> \U0001f600\x0bz", prose(1, 300) + " " + prose(1, 30), "a b c d a b c e b c d"]
    got = quality_rules.with_counts(rows("i int, text string, n_words string", *[(i, t, "x") for i, t in enumerate(texts)]), keep=["i"])
    assert [r[1:] for r in values(got, "i", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")] == [
        brute_counts(t) for t in texts
    ]


def test_binomial_tail(rows):
    df = rows("k long, n long", (0, 10), (3, 10), (10, 10), (5, 4000))
    got = df.select(quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01)).collect()
    want = [sum(comb(n, j) * 0.01**j * 0.99 ** (n - j) for j in range(k + 1)) for k, n in ((0, 10), (3, 10), (10, 10), (5, 4000))]
    assert [r[0] for r in got] == pytest.approx(want)


def test_cutoffs_are_certified_per_stratum(spark, rows):
    good, bad = prose(3, 60), " ".join(w + "#" * (i % 2) for i, w in enumerate(prose(4, 60).split()))
    # Stratum a has holdouts enough, b too few to certify anything; c has none, and NULL is a stratum too.
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, bad).otherwise(good).alias("text"),
        F.when(F.col("id") < 900, "a").when(F.col("id") < 950, "b").when(F.col("id") < 990, "c").alias("lang"),
    )
    labels = spark.range(950).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, 0).otherwise(1).alias("quality"), F.lit(1).alias("lang"))
    cuts = quality_rules.certified_cutoffs(quality_rules.with_counts(docs), labels, "doc_id", "lang", "quality")
    # Of the cutoffs that reject all bad holdouts and no good one the loosest is taken.
    assert ("a", "symbols", 0.4, 810, 0, 90) in values(cuts, "stratum", "rule", "cutoff", "holdouts", "rejected_good", "rejected_bad")
    assert {r[0] for r in values(cuts, "stratum")} == {"a"} and all(p[0] <= 0.05 / 10 for p in values(cuts, "p_value"))
    kept = quality_rules.judged(docs, labels)
    assert {tuple(r) for r in kept.groupBy("lang", "kept").count().collect()} == {
        ("a", True, 810), ("a", False, 90), ("b", True, 50), ("c", True, 40), (None, True, 10)
    }
    assert quality_rules.judged(docs.limit(0), labels.limit(0)).count() == 0


# --- SimHash --------------------------------------------------------------------------------------------


def brute_components(prints, radius):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("radius,shard_nodes", [(3, 16_384), (3, 8), (1, 4)])
def test_linked_fingerprints(spark, radius, shard_nodes):
    r = random.Random(radius * shard_nodes)
    centres = [r.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    prints = list({c ^ sum(1 << b for b in r.sample(range(64), r.randrange(5))) for c in centres for _ in range(12)})
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "print long")
    roots = {x["node"]: x["root"] for x in simhash_trees.linked(df, radius, shard_nodes).collect()}
    classes, want = defaultdict(set), defaultdict(set)
    for s, b in zip(signed, brute_components(prints, radius)):
        classes[roots.get(s, s)].add(s)
        want[b].add(s)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))


def test_trees_agree_with_each_other():
    r = random.Random(5)
    prints = np.array([r.getrandbits(64) & 0xFFF for _ in range(300)], np.uint64)
    places = np.arange(len(prints))
    for links, more in (
        simhash_trees.tree_links(prints.tolist(), 2, True), simhash_trees.array_tree_links(prints, places, places, 2, True),
    ):
        assert more and all(a != b and (int(prints[a]) ^ int(prints[b])).bit_count() <= 2 for a, b in more)
        assert all((int(prints[a]) ^ int(prints[b])).bit_count() <= 2 for a, b in links)
        groups = simhash_trees._Groups(len(prints))
        for a, b in links:
            groups.join(a, b)
        assert [groups.find(i) for i in range(300)] == brute_components(prints.tolist(), 2)


def test_near_groups_edge_cases(rows):
    long = prose(9, 30_000)
    df = rows(
        "doc_id long, text string, component_id string, fingerprint string",
        (5, None, "", ""), (4, "", "", ""), (7, " \n", "", ""), (3, "One two", "", ""), (2, "ONE  two", "", ""), (9, long, "", ""), (8, long, "", ""), (8, long, "", ""), (None, "one two", "", ""),
    )
    got = simhash_trees.near_groups(df)
    assert values(got, "doc_id", "component_id") == [(2, 2), (3, 2), (4, 4), (5, 4), (7, 4), (8, 8), (8, 8), (9, 8), (None, 2)]
    assert {r["fingerprint"] for r in got.filter("doc_id in (4, 5, 7)").collect()} == {0}
    one = int(np.uint64(xxhash.xxh64_intdigest(b"one two", 42)).astype(np.int64))
    assert {r["fingerprint"] for r in got.filter("doc_id in (2, 3)").collect()} == {one}
    assert simhash_trees.near_groups(df.limit(0)).count() == 0


def jaccard(a, b, k=5):
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


@pytest.mark.parametrize("shard_nodes", [16_384, 6])
def test_near_duplicates_by_similarity(rows, shard_nodes):
    r, texts = random.Random(3), []
    for g in range(6):
        base = prose(100 + g, 120).split()
        for n in range(8):
            copy = list(base)
            for _ in range(n % 4):
                copy[r.randrange(len(copy))] = "changed" + str(r.randrange(10**6))
            texts.append(" ".join(copy))
    texts += ["", None, prose(999, 40)]
    data = [(i, t) for i, t in enumerate(texts)]
    r.shuffle(data)
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *data), shard_nodes=shard_nodes), "doc_id", "component_id"))
    parent = {i: i for i, _ in data}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in data:
        for j, b in data:
            if i < j and ((a or "") == (b or "") or jaccard(a or "", b or "") >= 0.8):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in got}


def test_repeated_passages_do_not_hide_copies(rows):
    data = []
    for g in range(12):
        words = prose(300 + g, 200).split()
        data += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[:100] + words[80:100] * 30 + words[100:]))]
    assert all(jaccard(a[1], b[1]) >= 0.95 for a, b in zip(data[::2], data[1::2]))
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *data)), "doc_id", "component_id"))
    assert got == {i: i - i % 2 for i in got}


def test_wide_radius_misses_few_pairs():
    def differs(shared, left, right):  # the chance that the majority of shared + left coins differs from that of shared + right
        def over(x, more):
            return sum(comb(more, y) for y in range(more + 1) if 2 * (x + y) > shared + more) / 2**more

        return sum(comb(shared, x) / 2**shared * (over(x, left) + over(x, right) - 2 * over(x, left) * over(x, right)) for x in range(shared + 1))

    chance = max(differs(s, n - m, m) for s in range(4, 40) for n in [s // 4] for m in range(n // 2 + 1))
    assert sum(comb(64, k) * chance**k * (1 - chance) ** (64 - k) for k in range(simhash_trees.WIDE_RADIUS + 1, 65)) < 1 / 20_000


def test_texts_of_equal_fingerprint_are_checked(rows, monkeypatch):
    # Every text gets the same fingerprint, so that only the check on the sets tells them apart.
    monkeypatch.setattr(simhash_trees, "majority", lambda hashes: 7)
    common, a, b = prose(80, 60), prose(81, 80), prose(82, 80)
    data = [(1, f"{common} {a}"), (2, f"{common} {b}"), (3, f"{common} {b} end"), (4, f"{common} {a} end"), (5, f"{common} {a}")]
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *data)), "doc_id", "component_id"))
    assert got == {1: 1, 4: 1, 5: 1, 2: 2, 3: 2}


def test_large_families_are_linked_by_their_only_link(rows):
    # Families of near copies of one template, 0.76 or less apart; one member of the first is at 0.8 to one of the second.
    r, base, texts = random.Random(12), prose(600, 300).split(), []
    for f in range(3):
        own = [*base[:100], *prose(700 + f, 36).split(), *base[136:]] if f else base
        family = [list(own) for _ in range(40)]
        for i, words in enumerate(family[1:]):
            words[r.choice([*range(10, 90), *range(150, 290)])] = f"changed{f}x{i}"
        if f == 0:
            family.append([*base[:100], *prose(701, 36).split()[:10], *base[110:]])
        texts += [" ".join(w) for w in family]
    sets = [{" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    assert len({find(i) for i in parent}) == 2
    order = list(enumerate(texts))
    r.shuffle(order)
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *order)), "doc_id", "component_id"))
    assert got == {i: find(i) for i in got}


def test_bands_of_the_fingerprint_key_shards(rows, monkeypatch):
    # No two texts share a minimal hash, so that only the fingerprint's own shards bring near copies together.
    monkeypatch.setattr(simhash_trees, "shard_keys", lambda hashes: hashes[-1:] if hashes.size else np.zeros(1, np.uint64))
    monkeypatch.setattr(simhash_trees, "shingle_hashes", lambda text, k: np.arange(2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(int(text)))
    monkeypatch.setattr(simhash_trees, "_similar", lambda links, *_: links)
    monkeypatch.setattr(simhash_trees, "majority", lambda hashes: 7 if hashes.min() % 2 else 5 << 40)
    data = [(i, str(i)) for i in range(1, 5)]
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *data)), "doc_id", "component_id"))
    prints = {i: min(int(x) for x in np.arange(2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(i)) % 2 for i in got}
    assert got == {i: min(j for j in prints if prints[j] == prints[i]) for i in got}


def test_rows_of_near_duplicates_grow_with_texts_not_pairs(rows, monkeypatch):
    # A family in which every pair is close, though none is at 0.8: no table may hold its pairs.
    base, n = prose(900, 300).split(), 80
    data = [(i, " ".join([*base[:100], *prose(901 + i, 40).split(), *base[140:]])) for i in range(n)]
    assert 0.6 < jaccard(data[0][1], data[1][1]) < 0.8
    written, stored = {}, simhash_trees.stored

    def counted(df, label):
        out = stored(df, label)
        written[label] = max(written.get(label, 0), out.count())
        return out

    monkeypatch.setattr(simhash_trees, "stored", counted)
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *data)), "doc_id", "component_id"))
    assert got == {i: i for i in range(n)}
    assert max(written.values()) <= simhash_trees.BINS // simhash_trees.PER_KEY * n, written


def test_links_within_a_shard_agree_with_brute_force():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 32, 60, dtype=np.uint32)
    sets = [np.unique(np.concatenate((base[r.random(60) < 0.93], r.integers(0, 1 << 32, r.integers(0, 9), dtype=np.uint32)))) for _ in range(70)]
    n = len(sets)
    want = [(i, j) for i in range(n) for j in range(i) if len(x := np.intersect1d(sets[i], sets[j])) >= 0.8 * (len(sets[i]) + len(sets[j]) - len(x))]
    for side in (np.zeros(n, np.int8), np.array([0] * 50 + [1] * 20, np.int8), np.array([1] * 35 + [2] * 35, np.int8)):
        groups, brute = simhash_trees._Groups(n), simhash_trees._Groups(n)
        links = simhash_trees.set_links(side, np.zeros(n, np.uint64), np.arange(n), [s.view(np.int32) for s in sets], 25, 0.8)
        assert all(groups.join(i, j) for i, j in links) and {tuple(sorted(x, reverse=True)) for x in links} <= set(want)
        for i, j in want:
            if (side[i] != 1 and side[j] != 2) or (side[j] != 1 and side[i] != 2):
                brute.join(i, j)
        assert [groups.find(i) for i in range(n)] == [brute.find(i) for i in range(n)]


def test_pairs_without_a_common_shard_key_are_linked(rows):
    data = []
    for n, seed in enumerate((4782, 26244, 47694)):  # of 60,000 such pairs these have no key in common and differ in over three bits
        r = random.Random(seed)
        words = [f"w{r.randrange(10**6)}" for _ in range(60)]
        data += [(2 * n, " ".join(words)), (2 * n + 1, " ".join([*words[:20], "other", *words[21:58]]))]
        one, two = (np.unique(simhash_trees.shingle_hashes(t, 5)) for _, t in data[-2:])
        assert jaccard(data[-2][1], data[-1][1]) >= 0.8 and not set(simhash_trees.shard_keys(one)) & set(simhash_trees.shard_keys(two))
        assert (simhash_trees.majority(one) ^ simhash_trees.majority(two)).bit_count() > simhash_trees.RADIUS
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *data)), "doc_id", "component_id"))
    assert got == {i: i - i % 2 for i in got}


def test_no_link_is_lost_if_the_trees_find_nothing(rows, monkeypatch):
    # Fingerprints of near copies are far apart, so only what follows the trees is left; groups of more than two members are looked at again.
    monkeypatch.setattr(simhash_trees, "majority", simhash_trees.set_hash)
    monkeypatch.setattr(shingle_join, "SMALL_GROUP", 2)
    r, texts = random.Random(31), []
    for family in range(8):
        base = prose(1100 + family, r.choice([9, 30, 120])).split()
        for n in range(6):
            words = list(base)
            for _ in range(n % 4 * len(base) // 60):
                words[r.randrange(len(words))] = f"changed{r.randrange(10**6)}"
            texts.append(" ".join(words[: len(words) - r.randrange(0, 1 + len(base) // 12)]))
    got = dict(values(simhash_trees.near_duplicates(rows("doc_id long, text string", *enumerate(texts))), "doc_id", "component_id"))
    parent = list(range(len(texts)))
    for i, j in combinations(parent[:], 2):
        if jaccard(texts[i], texts[j]) >= 0.8:
            low, high = sorted((parent[i], parent[j]))
            parent = [low if x == high else x for x in parent]
    assert got == dict(enumerate(parent))


def test_one_row_stays_per_group(rows):
    df = rows("doc_id long, text string, n string", (2, "a b", "x"), (1, "a b", "y"), (1, "a b", "y"), (3, "c", "z"), (None, None, "n"))
    kept = simhash_trees.one_per_group(df, simhash_trees.near_duplicates(df))
    assert values(kept) == [(1, "a b", "y"), (3, "c", "z"), (None, None, "n")]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 100), (5, 5)] + [(300, 300 + i) for i in range(1, 40)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), 100: 100, 200: 100, **dict.fromkeys(range(300, 340), 300)}
    assert components.components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


# --- Quotations --------------------------------------------------------------------------------------------------


def test_quotations(rows):
    df = rows(
        "conv_id long, turn long, text string, body string",
        (1, 0, "First line.\nSecond line, here!", ""), (1, 1, "> first LINE\n> second line here\nAnswer one", ""),
        (1, 2, ">> First line.\n> Answer one\n\nAnswer two\n", ""), (1, 3, "> > Answer one\n> Answer two\n> unknown\nAnswer three", ""),
        (1, 4, "> nobody wrote this", ""), (1, 5, None, ""), (1, 6, "First line.", ""), (1, 7, "> First line.", ""),
        (2, 1, "> First line.\nother thread", ""), (None, 1, "> First line.", ""), (3, None, "> First line.", ""),
    )
    got = {(r["conv_id"], r["turn"]): r for r in quotation_links.reply_ordered(df).collect()}
    assert [got[1, t]["parent_turn"] for t in range(8)] == [None, 0, 1, 2, None, None, None, 0]
    assert [got[1, t]["thread_root"] for t in range(8)] == [0, 0, 0, 0, 4, 5, 6, 0]
    assert [got[1, t]["depth"] for t in range(8)] == [0, 1, 2, 3, 0, 0, 0, 1]
    assert [got[1, t]["body"] for t in range(6)] == ["First line.\nSecond line, here!", "Answer one", "Answer two", "Answer three", "", ""]
    assert (got[1, 3]["n_passages"], got[1, 3]["max_level"], got[2, 1]["parent_turn"], got[None, 1]["body"]) == (2, 2, None, "")
    assert quotation_links.reply_ordered(df.limit(0)).count() == 0


def test_long_reply_chain(spark):
    df = spark.createDataFrame([(7, n, (f"> line {n - 1}\n" if n else "") + f"line {n}") for n in range(70)], "conv_id long, turn long, text string")
    got = values(quotation_links.reply_ordered(df), "turn", "thread_root", "depth")
    assert sorted(got) == [(n, 0, n) for n in range(70)]


# --- Personal data ------------------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    valid = {
        "email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 13 <= len(digits(s)) <= 19 and private_spans.luhn(digits(s)), "phone": lambda s: 9 <= len(digits(s)) <= 15,
    }
    return [(k, *m.span()) for k, p in BASE.items() for m in re.finditer(p, text) if valid[k](m.group())]


def test_base_spans_match_the_patterns():
    r, alphabet = random.Random(11), "a0129.@+-_% ()é4.25@x"
    fixed = ["a@b", "a@b.c@d.e", "@a.b", "a..b@-.-", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.2.3.0004", "+1 (555) 123-4567", "4111 1111 1111 1111", "٣٣٣" * 5]
    for text in [*fixed, *["".join(r.choice(alphabet) for _ in range(r.randrange(1, 60))) for _ in range(4000)]]:
        assert private_spans.base_spans(text) == brute_spans(text), text


def test_reliabilities_and_classifier():
    good, bad = (1, 1, 1, 1, 0), (1, -1, 1, 1, 0)
    truth = private_spans.estimate({good: 500.0, bad: 200.0, (0, 0, 0, -1, -1): 50.0})
    assert truth[good] > 0.95 and truth[bad] < 0.5 and truth[(0, 0, 0, -1, -1)] < 0.5
    model = private_spans.SpanClassifier.fit([((2, 4, 8, 0, 1, 1, 1), 500.0, 0.99), ((2, 4, 8, 0, 1, 1, 0), 200.0, 0.02)])
    assert model.probability((2, 4, 8, 0, 1, 1, 1)) > 0.5 > model.probability((2, 4, 8, 0, 1, 1, 0))
    assert private_spans.SpanClassifier.fit([]).probability((0, 0, 0, 0, 0, 0, 0)) == 0.0


def test_private_spans_on_rows(rows):
    card = "4111111111111111"
    texts = [f"mail me.{i}@x.com now {card} or +1 (555) 123-45{i:02d}" for i in range(40)] + [f"glued +1 (555) 123-4567 {card} end", f"{card} {card}", None, "", "x" * 200_000 + " a@b.cc"]
    df = rows("doc_id long, text string, spans string", *[(i, t, "s") for i, t in enumerate(texts)])
    model = private_spans.fit(df)
    got = {r["doc_id"]: r for r in private_spans.with_spans(df, model, redact_as="clean").collect()}
    assert got[0]["clean"] == "mail [EMAIL] now [CARD] or [PHONE]" and got[0]["spans"] == "s"
    assert {(s["kind"], s["start"], s["end"]) for s in got[40]["all_spans"]} == {("card", 24, 40), ("phone", 6, 23)} and got[40]["base_spans"] == []
    assert len(got[41]["all_spans"]) == 2 and got[42]["clean"] is None and got[43]["clean"] == "" and got[44]["clean"].endswith(" [EMAIL]")
    assert private_spans.with_spans(df.limit(0), private_spans.fit(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        private_spans.with_spans(df, model, redact_as="text")


# --- Languages ----------------------------------------------------------------------------------------------------

TALK = {
    "en": "the of and with that this for thing which there would their", "de": "der die und nicht sich auch werden einer über schon ich",
    "fr": "les des est une dans pour avec être été même leur où", "xx": "qoppa zzurt vrrak qqel wuxxa kvozz jjurx",
}


def talk(lang, seed, n=40):
    r = random.Random(seed)
    return " ".join(r.choice(TALK[lang].split()) for _ in range(n))


def test_languages(rows):
    data = [(i, talk(lang, i), lang) for i, lang in enumerate(list(TALK) * 40)]
    data += [(900, None, "en"), (901, "12 34 !!", "de"), (902, "", None), (None, talk("fr", 5), None), (903, talk("de", 6, 20_000), "en")]
    df = rows("doc_id long, text string, lang string", *data)
    machines = language_families.fit(df.filter("doc_id < 900"), "doc_id", "text", "lang", per_language=20)
    assert sorted(map(sorted, machines.families)) == [["de", "en"], ["fr"], ["xx"]]
    got = {r["doc_id"]: r for r in language_families.with_language(df, machines, keep=["doc_id"]).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in data if i is not None and i < 900)
    assert [got[i]["lang_pred"] for i in (900, 901, 902, None, 903)] == ["und", "und", "und", "fr", "de"]
    assert got[900]["score"] == 0.0 and all(0 <= r["score"] <= 1 for r in got.values())
    none = language_families.fit(df.limit(0), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in language_families.with_language(df, none).collect()} == {"und"}
    one = language_families.fit(df.filter("lang = 'fr'"), "doc_id", "text", "lang")
    assert dict(values(language_families.with_language(df, one), "doc_id", "lang_pred"))[1] == "fr"


# --- Severity -----------------------------------------------------------------------------------------------------


def test_severity(rows, spark):
    insult = "vilebeast"
    data = [(i, prose(i, 40) + f" {insult}" * (i % 3) * (1 + 3 * (i % 3 == 2)), min(i % 3, 1)) for i in range(150)]
    docs = rows("doc_id long, text string, grade string", *[(i, t, "g") for i, t, _ in data], (900, None, ""), (901, "", ""), (901, "", ""))
    labels = rows("doc_id long, toxic int", *[(i, y) for i, _, y in data], (0, None), (7777, 1))
    sample = severity_grades.sampled(labels, "doc_id", "toxic", 200)
    model = severity_grades.fit(severity_grades.texts_of(docs, sample, "doc_id", "text"), severity_grades.halves)
    assert model.thresholds[0] < model.thresholds[1]
    got = {r["doc_id"]: r for r in severity_grades.with_severity(docs, model, keep=["doc_id"]).collect()}
    assert all(got[i]["grade"] == i % 3 for i in range(150)) and got[900]["grade"] == got[901]["grade"] == 0
    assert got[2]["expected_severity"] > got[1]["expected_severity"] > got[0]["expected_severity"]
    none = severity_grades.fit(severity_grades.texts_of(docs, severity_grades.sampled(labels.limit(0), "doc_id", "toxic"), "doc_id", "text"))
    assert {r["grade"] for r in severity_grades.with_severity(docs, none, keep=["doc_id"]).collect()} == {0}
    with pytest.raises(ValueError):
        severity_grades.with_severity(docs, model)


# --- Sentence pieces ----------------------------------------------------------------------------------------------


def test_pieces_equal_the_library(rows):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library, r = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(2)
    alphabet = "aeinrst  THE.,\n\té漢\U0001f600▁0129<s>"
    texts = ["", None, " ", "   ", "▁", "\n\n", "a" * 5000, " " * 300, "<s></s><unk>", prose(1, 3000), *["".join(r.choice(alphabet) for _ in range(r.randrange(80))) for _ in range(300)]]
    df = rows("doc_id long, text string, n string", *[(i, t, "x") for i, t in enumerate(texts)])
    got = {x["doc_id"]: x for x in sentence_pieces.with_pieces(df, path).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert (list(got[i]["piece_ids"]), got[i]["decoded"]) == (ids, library.decode(ids)), t
    assert got[3]["n"] == "x" and sentence_pieces.with_pieces(df.limit(0), path).count() == 0
    with pytest.raises(ValueError):
        sentence_pieces.with_pieces(df, path, ids_col="n")


def test_pieces_are_forgotten_in_generations():
    model = sentence_pieces.PieceModel(tokenizer_path("piece_bpe_32k.model"), remembered=5)
    text = prose(4, 60)
    assert all(model.encode([text]) == [model.library.encode(text)] for _ in range(3)) and len(model.old) > 0


# --- Backoff automaton --------------------------------------------------------------------------------------------


def test_scores_equal_brute_force(spark):
    r = random.Random(8)
    data = [(i, " ".join(r.choice("a b c d e F g the THE of".split()) for _ in range(r.randrange(60)))) for i in range(60)]
    data += [(100, None), (101, ""), (102, "never seen words"), (102, "never seen words"), (None, "a b")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    train = F.col("doc_id") % 3 != 0
    got = sorted(map(tuple, backoff_automaton.scored(df, train, state_share=0.05, block_rows=4).collect()), key=str)
    used = [backoff_automaton.tokens(t) for i, t in data if i is not None and i % 3]
    c, b = Counter(w for d in used for w in d), Counter(p for d in used for p in zip(d, d[1:]))
    n, v = sum(c.values()), len(c)
    states = {w for w in c if c[w] >= max(2, n * 0.05)}
    arcs = {p: k for p, k in b.items() if k >= 2 and set(p) <= states}
    left = {s: 1 - sum(k - 0.75 for (a, _), k in arcs.items() if a == s) / c[s] for s in states}
    want = []
    for i, t in data:
        read, base, score, last = backoff_automaton.tokens(t), 0.0, 0.0, None
        for w in read:
            p = (c[w] + 1) / (n + v + 1)
            base += log10(p)
            score += log10(left[last] * p + (arcs[last, w] - 0.75) / c[last] if (last, w) in arcs else left[last] * p) if last in states else log10(p)
            last = w
        want.append((i, len(read), sum(c[w] > 0 for w in read), n, base, score))
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:])
    # A state's arcs and its failure arc make up all probability.
    for s in states:
        total = sum(left[s] * (c[w] + 1) / (n + v + 1) + (arcs.get((s, w), 0.75) - 0.75) / c[s] for w in c) + left[s] / (n + v + 1)
        assert total == pytest.approx(1)


def test_rare_words_are_states_too(spark):
    r = random.Random(9)
    names = [f"{a}{b}" for a in "k\u00e9x" for b in range(40)]
    data = [(i, " ".join(r.choice([f"{(n := r.choice(names))} {n}z", "the", "of the"]) for _ in range(r.randrange(40)))) for i in range(60)]
    df = spark.createDataFrame([*data, (90, None), (93, "unseen k1 k1z")], "doc_id long, text string").repartition(3)
    train = F.col("doc_id") % 3 != 0
    got = values(backoff_automaton.scored(df, train, block_rows=4, numbered_share=0.02))
    used = [backoff_automaton.tokens(t) for i, t in data if i % 3]
    c, b = Counter(w for d in used for w in d), Counter(p for d in used for p in zip(d, d[1:]))
    n, v = sum(c.values()), len(c)
    arcs = {p: k for p, k in b.items() if k >= 2}
    assert sum(c[a] < 0.02 * n for a, _ in arcs) > 50  # arcs from words that have no number
    left = {s: 1 - sum(k - 0.75 for (a, _), k in arcs.items() if a == s) / c[s] for s in c}
    for i, *_, score in got:
        want, last = 0.0, None
        for w in backoff_automaton.tokens(dict([*data, (90, None), (93, "unseen k1 k1z")])[i]):
            p = (c[w] + 1) / (n + v + 1)
            want += log10((arcs[last, w] - 0.75) / c[last] + left[last] * p if (last, w) in arcs else left.get(last, 1) * p)
            last = w
        assert score == pytest.approx(want)


def test_words_and_pairs_travel_packed(spark, monkeypatch):
    r = random.Random(10)
    data = [(i, " ".join(r.choice("abcdefgh") + str(r.randrange(40)) for _ in range(r.randrange(80)))) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    train, tables = F.col("doc_id") % 3 != 0, {}
    want = values(backoff_automaton.scored(df, train))
    write = backoff_automaton.stored
    monkeypatch.setattr(backoff_automaton, "stored", lambda rows, label: tables.setdefault(label, write(rows, label)))
    for name, size in (("PART_WORDS", 300), ("PART_PAIRS", 500), ("BLOCK_TOKENS", 400)):
        monkeypatch.setattr(backoff_automaton, name, size, raising=False)
    got = values(backoff_automaton.scored(df, train))
    for g, w in zip(got, want, strict=True):  # whatever the blocks and parts
        assert g[:4] == w[:4] and g[4:] == pytest.approx(w[4:])
    # A row per block and part, not per word or pair of a block.
    blocks, words, pairs = tables["blocks"].count(), tables["words"], tables["pairs"]
    parts = words.select("part").distinct().count()
    assert 3 < blocks < 12 and parts > 3 and words.count() <= blocks * parts
    assert pairs.where("part is null").count() <= blocks * pairs.select("pair_part").distinct().count()


def test_packed_numbers_come_back():
    for some in ([], [0], [5, 5, 300, 70000], [1 << 40, 3, 1 << 62]):
        for rising in (False, True):
            assert backoff_automaton.unpacked(backoff_automaton.packed(np.array(some, np.int64), rising), rising).tolist() == some


def test_scores_without_training(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert values(backoff_automaton.scored(df, F.lit(False))) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert backoff_automaton.scored(df.limit(0), F.lit(True)).count() == 0


# --- Spaced seeds -------------------------------------------------------------------------------------------------


def test_substituted_passages_are_found(rows):
    item, other = prose(50, 30), prose(51, 14)
    w = item.split()
    changed = [x if i not in (4, 11, 20) else "other" for i, x in enumerate(w)]
    docs = rows(
        "doc_id long, text string, item_id string",
        (1, prose(1, 40) + " " + item.upper() + ". " + prose(2, 10), ""), (2, " ".join(changed), ""), (3, prose(3, 200), ""),
        (4, " ".join(w[:16]), ""), (5, None, ""), (6, "", ""), (7, " ".join(w[:6]) + " " + prose(9, 60), ""), (8, other + " " + item + " " + item, ""),
        (None, item, ""), (2, prose(4, 30), ""),
    )
    benchmark = rows("item_id long, text string", (10, item), (11, other), (12, "too short"), (13, None), (10, item))
    got = spaced_seeds.contaminated(docs, benchmark)
    assert values(got, "doc_id", "item_id", "matched_words") == [(1, 10, 30), (2, 10, 27), (4, 10, 16), (8, 10, 30), (8, 11, 14), (None, 10, 30)]
    assert values(spaced_seeds.without_contaminated(docs, benchmark), "doc_id") == [(3,), (5,), (6,), (7,)]
    assert spaced_seeds.contaminated(docs.limit(0), benchmark).count() == 0 and spaced_seeds.contaminated(docs, benchmark.limit(0)).count() == 0


def test_every_placement_of_substitutions_is_found(rows):
    data, items, want = [], [], set()
    for n in (8, 10, 12, 13, 15):
        w = prose(800 + n, n).split()
        items.append((n, " ".join(w)))
        for k in range(5):
            for at in combinations(range(n), k) if n <= 13 else [r for r in combinations(range(n), k) if k < 3]:
                text = ["other" if i in at else x for i, x in enumerate(w)]
                data.append((len(data), " ".join(["before", *text, "after"])))
                # Brute force: some window of 13 places (or the whole item) has three differing words at most.
                size = min(n, 13)
                if min(sum(a <= i < a + size for i in at) for a in range(n - size + 1)) <= 3:
                    want.add((data[-1][0], n))
    items += [(3, "one two three"), (5, "red green blue black white")]
    data += [(-1, "x one two three y"), (-2, "x one four three y"), (-3, "red green blue black white"), (-4, "red green blue black grey")]
    want |= {(-1, 3), (-3, 5)}
    got = spaced_seeds.contaminated(rows("doc_id long, text string", *data), rows("item_id long, text string", *items))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_large_benchmarks_are_not_broadcast(rows, monkeypatch):
    monkeypatch.setattr(spaced_seeds, "BROADCAST_ROWS", 0)
    item = prose(60, 20)
    got = spaced_seeds.contaminated(rows("doc_id long, text string", (1, "x " + item), (2, "y")), rows("item_id long, text string", (1, item)))
    assert values(got, "doc_id", "item_id") == [(1, 1)]
