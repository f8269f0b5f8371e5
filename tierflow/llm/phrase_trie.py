"""Phrases of words that stand together, counted in HAT-tries.

A trie leads from word id to word id; below its nodes lie hash containers with the rest of a phrase and its count. A container that
outgrows ``BURST`` becomes a node whose containers lack one more word, while words remain. When a task's trie holds more than
``LIMIT`` phrases its largest subtrees are spilled whole: as sorted runs, one for each prefix partition (a hash of the two leading words),
packed in columns. Spark brings the runs of a prefix partition together, and a task merges one partition at a time. The number of
partitions follows the number of words, so a partition is of bounded size, and no word or phrase is one task's burden.

There are three passes, each over all texts: words; pairs of words that are both frequent; phrases of three to five words all of whose
neighbouring pairs are frequent. A phrase cannot be more frequent than its parts, so nothing is lost. What is frequent comes as a
bit filter of at most ``FILTER_BITS``: a false hit costs a count that the merge drops again, never a wrong result.

A word id is the 64-bit XXH64 of the word, seeded by the language, so phrases of different languages never meet. Scores, containment and
ranks are joins and windows over the frequent phrases, in exact decimals.

Edge cases: a NULL language counts as ``und``, a NULL text as empty. Empty and word-less texts add nothing. Repeated rows count as often as they
stand there. Ties in score and count go by the phrase's bytes. An empty table gives an empty result. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import small_batches, stored

UNDETERMINED = "und"
#: Entries of a container before it bursts, entries of a trie before it spills, and phrases counted before they enter the trie.
BURST, LIMIT, BUFFER = 4096, 1 << 20, 1 << 21
#: Words for each prefix partition, the least number of partitions, and bits of the widest filter.
WORDS_PER_PART, LEAST_PARTS, FILTER_BITS = 1 << 19, 64, 1 << 26
BATCH_TEXTS = 4096
#: What ends a piece, as one byte; a word cannot hold it.
BREAK = b"."
_FOLD = bytes.maketrans(b",;:!?\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", BREAK * 9 + b"abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chained(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of each row of word ids."""
    out = mix(columns[0])
    for c in columns[1:]:
        out = mix(out + c)
    return out


def tokens(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case, with a ``BREAK`` between pieces and at the end."""
    return text.encode().translate(_FOLD).replace(BREAK, b" . ").split() + [BREAK]


def word_ids(texts: list[str], lang: str) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(place of each token in the words, the words, their ids); breaks are the id zero."""
    import xxhash

    listed = pa.array([t for text in texts for t in tokens(text)], pa.binary()).dictionary_encode()
    seed = xxhash.xxh64_intdigest(lang.encode())
    words = listed.dictionary.to_pylist()
    ids = np.array([0 if w == BREAK else xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)
    return listed.indices.to_numpy(), words, ids


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """The texts (column 1) of each language (column 0)."""
    found: dict[str, list[str]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        found.setdefault(lang, []).append(text)
    yield from found.items()


class HatTrie:
    """Counts of phrases of ``length`` word ids. A container maps the bytes of a phrase's remaining ids to its count."""

    def __init__(self, length: int, burst: int = BURST):
        self.length, self.burst = length, burst
        self.subtrees: dict[int, dict] = {}
        self.sizes: dict[int, int] = {}
        self.held = 0

    def add(self, first: int, rests: list[bytes], counts: list[int]) -> None:
        """Count phrases that begin with one id."""
        subtree = self.subtrees.setdefault(first, {})
        added = self._add(subtree, rests, counts, self.length - 1)
        self.sizes[first] = self.sizes.get(first, 0) + added
        self.held += added

    def _add(self, at: dict, rests: list[bytes], counts: list[int], left: int) -> int:
        """``at`` is a container, or under the key None has the containers of a node by their next id."""
        if None in at:
            return sum(self._add(at[None].setdefault(rest[:8], {}), [rest[8:]], [n], left - 1) for rest, n in zip(rests, counts))
        before, get = len(at), at.get
        for rest, n in zip(rests, counts):
            at[rest] = get(rest, 0) + n
        added = len(at) - before
        if len(at) > self.burst and left > 1:
            below: dict[bytes, dict] = {}
            for rest, n in at.items():
                below.setdefault(rest[:8], {})[rest[8:]] = n
            at.clear()
            at[None] = below
        return added

    def _rows(self, at: dict, lead: bytes) -> Iterator[tuple[bytes, int]]:
        if None in at:
            for next_id, child in at[None].items():
                yield from self._rows(child, lead + next_id)
        else:
            for rest, n in at.items():
                yield lead + rest, n

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take the largest subtrees out, whole, until ``keep`` entries are left: ids (rows x length) and counts."""
        keys, counts = [], []
        for first in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.held <= keep:
                break
            self.held -= self.sizes.pop(first)
            for key, n in self._rows(self.subtrees.pop(first), first.to_bytes(8, "little")):
                keys.append(key)
                counts.append(n)
        return np.frombuffer(b"".join(keys), "<u8").reshape(-1, self.length), np.array(counts, np.int64)


def aggregated(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows with their counts, ascending by leading ids."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    if not len(order):
        return columns, np.zeros(0, np.int64)
    fresh = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in columns], axis=0)))
    lead = np.flatnonzero(fresh)
    n = np.diff(np.append(lead, len(order))) if counts is None else np.add.reduceat(counts[order], lead)
    return [c[lead] for c in columns], n


def runs(ids: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """Sorted runs of phrases, one row (part, length, keys, counts) for each prefix partition."""
    part = (chained([ids[:, 0], ids[:, 1]]) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort([*ids.T[::-1], part])
    part, ids, counts = part[order], ids[order], counts[order]
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(starts[1:], len(part))
    cut = list(zip(starts.tolist(), ends.tolist()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(part[starts], pa.int64()), pa.array([ids.shape[1]] * len(cut), pa.int64()),
            pa.array([np.ascontiguousarray(ids[a:b].T).tobytes() for a, b in cut], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in cut], pa.binary()),
        ],
        ["part", "length", "ids", "counts"],
    )


class Counter:
    """Counts phrases of the given lengths in tries of one task."""

    def __init__(self, lengths: range, parts: int):
        self.parts, self.waiting, self.held = parts, {k: [] for k in lengths}, 0
        self.tries = {k: HatTrie(k) for k in lengths}

    def count(self, length: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.waiting[length].append(columns)
        self.held += len(columns[0])
        if self.held > BUFFER:
            yield from self._enter()

    def _enter(self) -> Iterator[pa.RecordBatch]:
        for length, waiting in self.waiting.items():
            if not waiting:
                continue
            columns, counts = aggregated([np.concatenate(c) for c in zip(*waiting)])
            waiting.clear()
            if not len(counts):
                continue
            trie, width = self.tries[length], 8 * (length - 1)
            flat = np.ascontiguousarray(np.stack(columns[1:], axis=1)).tobytes()
            rests = [flat[i : i + width] for i in range(0, len(flat), width)]
            lead = np.flatnonzero(np.concatenate(([True], columns[0][1:] != columns[0][:-1])))
            firsts, ends, counts = columns[0][lead].tolist(), np.append(lead[1:], len(counts)).tolist(), counts.tolist()
            for first, a, b in zip(firsts, lead.tolist(), ends):
                trie.add(first, rests[a:b], counts[a:b])
        self.held = 0
        total = sum(t.held for t in self.tries.values())
        if total > LIMIT:
            for trie in self.tries.values():
                yield from self._spilled(trie, trie.held // 2)

    def _spilled(self, trie: HatTrie, keep: int) -> Iterator[pa.RecordBatch]:
        ids, counts = trie.spill(keep)
        if len(counts):
            yield runs(ids, counts, self.parts)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._enter()
        for trie in self.tries.values():
            yield from self._spilled(trie, 0)


class Filter:
    """Two bits for each hash of a set; false hits are rare, misses impossible."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(64 * len(words) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for shift in (0, 32):
            bit = (hashes >> np.uint64(shift)) & self.mask
            out &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
        return out


def filter_of(hashes: DataFrame) -> Filter:
    """The filter of rows (hash): the driver gets at most ``FILTER_BITS`` / 64 numbers."""
    bits = min(FILTER_BITS, max(1 << 12, 1 << (16 * hashes.count()).bit_length()))
    mask = F.lit(bits - 1).cast("long")
    places = F.explode(F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(mask) for s in (0, 32)]))
    words = hashes.select(places.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    ).toArrow()
    held = np.zeros(bits // 64, np.uint64)
    held[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return Filter(held)


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(df[lang_col].cast("string"), F.lit(UNDETERMINED))
    return df.select(lang.alias("lang"), F.coalesce(df[text_col], F.lit("")).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, id, word, f) of all words of rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}

        def told() -> pa.RecordBatch:
            langs, ids = zip(*held) if held else ((), ())
            words, counts = zip(*held.values()) if held else ((), ())
            arrays = [
                pa.array(langs, pa.string()), pa.array(np.array(ids, np.uint64).view(np.int64)),
                pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, ["lang", "id", "word", "f"])

        for batch in batches:
            for lang, found in by_language(batch):
                places, words, ids = word_ids(found, lang)
                for word, i, n in zip(words, ids.tolist(), np.bincount(places, minlength=len(words)).tolist()):
                    if i:
                        held.setdefault((lang, i), [word, 0])[1] += n
            if len(held) > LIMIT // 2:
                yield told()
        yield told()

    found = texts.mapInArrow(run, "lang string, id long, word string, f long")
    return found.groupBy("lang", "id", "word").agg(F.sum("f").alias("f"))


def _counted(texts: DataFrame, lengths: range, parts: int, known: Filter, pairs: bool) -> DataFrame:
    """Runs of phrases whose words (or with ``pairs`` neighbouring pairs) pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(lengths, parts)
        for batch in batches:
            for lang, found in by_language(batch):
                places, _, ids = word_ids(found, lang)
                if pairs:
                    row = ids[places]
                    good = (row[:-1] != 0) & (row[1:] != 0)  # whether a frequent pair starts at a place
                    at = np.flatnonzero(good)
                    good[at] = known.holds(chained([row[at], row[at + 1]]))
                else:
                    row, single = ids[places], (known.holds(ids) & (ids != 0))[places]
                    good = single[:-1] & single[1:]
                for k in lengths:
                    together = good[: max(0, len(good) - (k - 2))].copy()
                    for i in range(1, k - 1):
                        together &= good[i : len(good) - (k - 2) + i]
                    at = np.flatnonzero(together)
                    yield from counter.count(k, [row[at + i] for i in range(k)])
        yield from counter.end()

    return texts.mapInArrow(run, "part long, length long, ids binary, counts binary")


def _merged(spilled: DataFrame, least: int) -> DataFrame:
    """Merge the runs of each prefix partition: (ids array<long>, f) of phrases with ``least`` occurrences or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}

        def flush() -> Iterator[pa.RecordBatch]:
            for length, parts in held.items():
                flat, counts = zip(*parts)
                columns, n = aggregated([np.concatenate(c) for c in zip(*flat)], np.concatenate(counts))
                kept = n >= least
                rows = np.stack([c[kept] for c in columns], axis=1).view(np.int64)
                offsets = np.arange(0, rows.size + 1, length, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(rows.ravel())), pa.array(n[kept])], ["ids", "f"])

        for batch in batches:
            for part, length, ids, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if part != current:
                    yield from flush()
                    current, held = part, {}
                columns = np.frombuffer(ids, "<u8").reshape(length, -1)
                held.setdefault(length, []).append((list(columns), np.frombuffer(counts, np.int64)))
        yield from flush()

    return spilled.repartition("part").sortWithinPartitions("part").mapInArrow(run, "ids array<long>, f long")


def counted_phrases(df: DataFrame, text_col: str, lang_col: str, longest: int, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, lang, word, f) of frequent words, (ids, f) of frequent phrases of two words or more, and (lang, n). Runs jobs."""
    spark = df.sparkSession
    small_batches(spark, BATCH_TEXTS)
    texts = _texts(df, text_col, lang_col)
    all_words = stored(word_counts(texts), "words")
    totals = stored(all_words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = stored(all_words.where(F.col("f") >= least).select("id", "lang", "word", "f"), "frequent")
    n = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(LEAST_PARTS, -(-n // WORDS_PER_PART))
    phrases = stored(_merged(_counted(texts, range(2, 3), parts, filter_of(words.select(F.col("id").alias("hash"))), False), least), "pairs")
    if longest > 2:
        known = filter_of(stored(_hashes(phrases), "hashes"))
        longer = stored(_merged(_counted(texts, range(3, longest + 1), parts, known, True), least), "phrases")
        phrases = phrases.unionByName(longer)
    small_batches(spark)
    return words, phrases, totals


def _hashes(pairs: DataFrame) -> DataFrame:
    """(hash) of rows (ids) of two, as the tasks that count compute it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy().view(np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(chained([rows[:, 0], rows[:, 1]]).view(np.int64))], ["hash"])

    return pairs.select("ids").mapInArrow(run, "hash long")


def mined(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, least: int = 100, inside_percent: int = 100, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two to ``longest`` words. Runs jobs.

    A phrase that occurs ``least`` times or more (a) is cut where floor(1000 * a * n / (l * r)) is lowest, l and r being the counts of its
    sides and n that of all words. It is dropped if a longer one contains it with ``inside_percent`` of its count or more.
    """
    words, phrases, totals = counted_phrases(df, text_col, lang_col, longest, least)
    known = phrases.unionByName(words.select(F.array("id").alias("ids"), "f"))
    cuts = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("cut"))
    sides = cuts.select(
        "ids", "a", "cut", F.expr("slice(ids, 1, cut)").alias("left"), F.expr("slice(ids, cut + 1, size(ids))").alias("right")
    )
    sides = sides.join(known.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left").join(
        known.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right"
    )
    lang = words.select(F.col("id").alias("first"), "lang").join(totals, "lang")
    scored = sides.withColumn("first", F.col("ids")[0]).join(lang, "first").withColumn(
        "score",
        F.expr("(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) * 1000BD) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"),
    )
    best = scored.groupBy("ids", "a", "lang", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    best = best.select("ids", "a", "lang", "n", "b.l", "b.r", "b.score")

    # Every shorter phrase inside a longer one, with the greatest count of such a longer one.
    inside = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), k -> transform(sequence(1, size(ids) - k + 1), i -> slice(ids, i, k))))"
    )
    held = phrases.where(F.size("ids") > 2).select(F.explode(inside).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("longer"))
    free = best.join(held, "ids", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))

    # Texts of phrases are needed for ties alone: first cut to what may be listed, then spell and rank.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = stored(free.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("longer", "place"), "listed")
    spelled = near.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "word"), "id").groupBy("ids").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = near.join(spelled, "ids").withColumn("rank", F.row_number().over(final).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
