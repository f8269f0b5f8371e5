"""Jaccard join of word-shingle sets by a partition of the universe and the pigeonhole principle.

Two sets of a and b shingles with a Jaccard similarity of ``percent`` / 100 or more differ in at most
``H = floor((a + b) * (100 - percent) / (100 + percent))`` shingles. Sizes fall into bands, and each band hashes the universe of shingles
into segments of its own. If the larger set gives every segment an allowance of 0, 1 or 2 that sums to ``H + 1``, then in one
segment the two sets differ by less than its allowance: with 1 their parts of the segment are equal, with 2 they are equal
or differ by one shingle, so that a part of one equals a part of the other with one shingle left out.

*Index.* A set lists the hash of its part of each segment of its own band, and for the wide segments (the first few of a
band) also the hashes with each one shingle left out. *Probe.* A set asks its own band for sets not larger than itself, and the band below
if that may hold similar ones. It allocates the ``H + 1`` allowances where they cost least: a part costs as many sets as may share it,
by the document counts of its shingles, so that empty parts and parts of passages that many documents share are
avoided, and an allowance of 2 costs one look-up for each shingle left out as well. Counts of frequent shingles come from all documents
by lossy counting in tasks; they steer costs only, and the join is exact whatever they are.

*Candidates.* One shuffle by (band, segment, part) brings probes to their index rows. A small group proposes its pairs. A
larger one proposes a star, and is looked at again when the links found so far are components: then only pairs of different
components are compared, in the task, and the nearest few of each two components are proposed, in rounds that go on until no pair is left.
Groups beyond ``GROUP_ROWS`` are cut into pairs of chunks. Whatever is proposed must first agree in size and parity sketch (the bits in which
two sketches differ are a lower bound of the difference of their sets); what does is verified on whole sets. So links are exact, and no
link between components is lost.

Documents of equal sets are one node. A shingle is known by a 64-bit hash of its words' XXH64.

Edge cases: a text with fewer words than a shingle is one shingle; a NULL or word-less text has none, and is a component by
itself. A NULL id takes part in links but names a component only if all its ids are NULL. Repeated rows are copies. An empty table gives
an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import small_batches, stored
from tierflow.llm.components import components
from tierflow.llm.simhash_trees import SEED, set_hash

#: A band ends where sizes are half as large again; one segment in so many is wide, and two of a band at least.
GROWTH, WIDE_SHARE = 1.5, 16
#: Members of a group up to which all its pairs are proposed, and rows of a group (or chunk) compared in one task.
SMALL_GROUP, GROUP_ROWS = 8, 8_192
#: Share of documents from which a shingle counts as frequent, hashes between two prunings, and most entries of the cost table.
FREQUENT, BUFFER, COST_ENTRIES = 0.001, 1 << 21, 1 << 16
#: Rows of an Arrow batch of plain numbers, pairs held before repeated ones are dropped, and bits of the widest filter.
NUMBER_ROWS, HELD_PAIRS, FILTER_BITS = 1 << 15, 1 << 20, 1 << 26
#: Pairs of each two components of a group that the first further round proposes, and growth from one round to the next.
FIRST_ROUND, ROUND_GROWTH = 64, 16
INDEX, PROBE = 1, 2
#: Texts to their sets of shingles, each ascending; and a set to its keys with their roles.
Shingles = Callable[[list], list[np.ndarray]]
Keys = Callable[[np.ndarray, "Bands", "Costs"], tuple[np.ndarray, np.ndarray]]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], shingle_words: int) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending; of the whole sequence of words if it is shorter."""
    import xxhash

    words = [(t or "").encode().lower().split() for t in texts]  # bytes.lower() and split() know ASCII only
    listed = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w, SEED) for w in listed.dictionary.to_pylist()], np.uint64)
    ids = known[listed.indices.to_numpy()] if len(listed) else known

    def chained(of: np.ndarray, n: int) -> np.ndarray:
        out = np.full(max(0, len(of) - n + 1), n, np.uint64)
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + of[i : i + len(out)]
        return mix(out)

    hashes, out, at = chained(ids, shingle_words), [], 0
    for ws in words:
        n = len(ws)
        found = np.sort(hashes[at : at + n - shingle_words + 1] if n >= shingle_words else chained(ids[at : at + n], n) if n else ids[:0])
        out.append(found[np.concatenate(([True], found[1:] != found[:-1]))] if n else found)
        at += n
    return out


class Bands:
    """Size bands of a similarity, with the segments of each."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent), int(np.ceil(edges[-1] * GROWTH))))
        self.edges = np.array(edges, np.int64)

    def bound(self, total: int) -> int:
        """How many shingles similar sets of ``total`` shingles together may differ in."""
        return total * (100 - self.percent) // (100 + self.percent)

    def near(self, a, b):
        """Whether sets of these sizes can be similar."""
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, side="right")) - 1

    def segments(self, band: int) -> tuple[int, int]:
        """(segments, wide ones) of a band, enough for the largest difference of any pair that it serves; none if that is zero."""
        largest = int(self.edges[band + 1]) - 1
        most = self.bound(largest + largest * 100 // self.percent)
        return (most + 1, min(most + 1, max(2, (most + 1) // WIDE_SHARE))) if most else (0, 0)


class Costs:
    """Document counts of frequent shingles; other shingles count one."""

    def __init__(self, shingles: list[int], counts: list[int], documents: int):
        keys = np.array(shingles, np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.counts, self.documents = keys[order], np.array(counts, np.int64)[order], max(documents, 1)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.counts[at], 1)


def allocated(first: np.ndarray, second: np.ndarray, units: int) -> np.ndarray:
    """Allowance of each segment: the ``units`` cheapest, where a wide segment's second one costs no less than its first."""
    order = np.argsort(np.concatenate((first, np.maximum(second, first[: len(second)]))), kind="stable")[:units]
    return np.bincount(np.where(order < len(first), order, order - len(first)), minlength=len(first))


class Parts:
    """The parts of one set in the segments of a band: their hashes, costs, and hashes with one shingle left out."""

    def __init__(self, hashes: np.ndarray, frequency: np.ndarray, band: int, segments: int, wide: int, documents: int):
        self.band, self.segments, self.wide = band, segments, wide
        spread = mix(hashes + np.uint64((band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        self.segment = (spread % np.uint64(segments)).astype(np.int64)
        self.spread, self.sums = spread, np.zeros(segments, np.uint64)
        np.add.at(self.sums, self.segment, spread)
        self.first = np.full(segments, documents, np.int64)
        np.minimum.at(self.first, self.segment, frequency)
        self.in_wide = np.flatnonzero(self.segment < wide)
        at, cost = self.segment[self.in_wide], frequency[self.in_wide]
        # Leaving out the rarest shingle of a part leaves the second rarest one; leaving out others keeps the rarest.
        order = np.lexsort((cost, at))
        at, cost = at[order], cost[order]
        lead = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at
        sizes = np.bincount(at, minlength=wide)
        second = np.full(wide, documents, np.int64)
        several = lead[sizes[at[lead]] > 1] if len(lead) else lead
        second[at[several]] = cost[several + 1]
        rarest = self.first[:wide]
        self.second = 2 * rarest + np.maximum(sizes - 1, 0) * rarest + second + sizes

    def _keys(self, sums: np.ndarray, segment: np.ndarray) -> np.ndarray:
        return mix(sums ^ mix(segment.astype(np.uint64) + np.uint64(self.band << 32)))

    def whole(self) -> np.ndarray:
        return self._keys(self.sums, np.arange(self.segments))

    def left_out(self, of: np.ndarray) -> np.ndarray:
        """Keys of the given wide segments' parts with one shingle left out."""
        at = self.in_wide[of[self.segment[self.in_wide]]]
        return self._keys(self.sums[self.segment[at]] - self.spread[at], self.segment[at])


def entries(hashes: np.ndarray, bands: Bands, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set and the role of each."""
    size, keys, roles = len(hashes), [], []
    band, frequency = bands.of(size), costs.of(hashes)

    def add(found: np.ndarray, role) -> None:
        keys.append(found)
        roles.append(role if isinstance(role, np.ndarray) else np.full(len(found), role, np.uint64))

    def probes(parts: Parts, largest_other: int) -> np.ndarray:
        allowance = allocated(parts.first, parts.second, bands.bound(size + largest_other) + 1)
        add(parts.left_out(allowance[: parts.wide] > 1), PROBE)
        return allowance > 0

    segments, wide = bands.segments(band)
    if segments:
        own = Parts(hashes, frequency, band, segments, wide, costs.documents)
        add(own.left_out(np.ones(wide, bool)), INDEX)
        asked = probes(own, size)
        add(own.whole(), np.where(asked, np.uint64(INDEX | PROBE), np.uint64(INDEX)))
    below = int(bands.edges[band]) - 1
    if band and 100 * below >= bands.percent * size:
        segments, wide = bands.segments(band - 1)
        if segments:
            lower = Parts(hashes, frequency, band - 1, segments, wide, costs.documents)
            asked = probes(lower, below)
            add(lower.whole()[asked], PROBE)
    return (np.concatenate(keys), np.concatenate(roles)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def first_shingles(hashes: np.ndarray, bands: Bands, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """In place of ``entries``: the shingles of a set that come first by count, then hash; every one is listed and asks.

    Similar sets share ``percent`` of the larger one's shingles or more. So the first of the shared ones, the same in both since the order
    is, stands before all that either set may keep of them: one more of its shingles than it may lack in the other.
    """
    n = len(hashes) - -(-len(hashes) * bands.percent // 100) + 1
    order = np.argsort(costs.of(hashes), kind="stable")[:n]  # a set's hashes ascend
    return hashes[order], np.full(len(order), INDEX | PROBE, np.uint64)


def node_of(distinct: np.ndarray) -> int:
    """The name of a set; its two lowest bits are free for a role."""
    return set_hash(distinct) & ~3


class FrequentShingles:
    """Lossy counting: shingles in a share of the documents or more are never lost, memory stays bounded."""

    def __init__(self, share: float):
        self.share, self.documents, self.held = share, 0, 0
        self.keys, self.counts, self.fresh = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def add(self, distinct: np.ndarray) -> None:
        self.documents += 1
        self.fresh.append(distinct)
        self.held += len(distinct)
        if self.held > BUFFER:
            self.prune()

    def prune(self) -> None:
        if not self.fresh:
            return
        fresh = np.sort(np.concatenate(self.fresh))
        lead = np.flatnonzero(np.concatenate(([True], fresh[1:] != fresh[:-1]))) if len(fresh) else np.zeros(0, np.int64)
        keys, counts = fresh[lead], np.diff(np.append(lead, len(fresh)))
        if len(self.keys) and len(keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            counts[known] += self.counts[at[known]]
            unseen = np.ones(len(self.keys), bool)
            unseen[at[known]] = False
            keys, counts = np.concatenate((keys, self.keys[unseen])), np.concatenate((counts, self.counts[unseen]))
        kept = counts >= max(2, self.share * self.documents / 2)
        order = np.argsort(keys[kept])
        self.keys, self.counts, self.fresh, self.held = keys[kept][order], counts[kept][order], [], 0


def sketched(df: DataFrame, id_col: str, text_col: str, shingles: Shingles) -> DataFrame:
    """Rows (id, node, size, sketch) of documents, node NULL without shingles, and (shingle, count) of a task's frequent shingles.

    Of equal sets in a task the first has the sketch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen = FrequentShingles(FREQUENT), set()
        kind, names = None, [id_col, "node", "size", "sketch", "shingle", "count"]
        for batch in batches:
            kind, nodes, sizes, sketches = batch.column(0).type, [], [], []
            for distinct in shingles(batch.column(1).to_pylist()):
                node = node_of(distinct) if len(distinct) else None
                fresh = node is not None and node not in seen
                if fresh:
                    seen.add(node)
                    frequent.add(distinct)
                nodes.append(node if node is None else node - (1 << 64) * (node >> 63))
                sizes.append(len(distinct))
                sketches.append(parity(distinct).tobytes() if fresh else None)
            empty = pa.nulls(len(nodes), pa.int64())
            told = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *told, empty, empty], names)
        frequent.prune()
        if len(frequent.keys):
            none = pa.nulls(len(frequent.keys), pa.int64())
            told = [pa.array(frequent.keys.view(np.int64)), pa.array(frequent.counts)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(none), kind), none, none, pa.nulls(len(none), pa.binary()), *told], names)

    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("node", T.LongType()), T.StructField("size", T.LongType())]
    fields += [T.StructField("sketch", T.BinaryType()), T.StructField("shingle", T.LongType()), T.StructField("count", T.LongType())]
    return df.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def _listed(df: DataFrame, text_col: str, shingles: Shingles, keys_of: Keys, bands: Bands, costs: Costs) -> DataFrame:
    """Rows (key, tag) of all sets; a tag is a node with a role. A task lists equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            keys, tags, held = [], [], 0
            for distinct in shingles(batch.column(0).to_pylist()):
                node = node_of(distinct)
                if not len(distinct) or node in seen:
                    continue
                seen.add(node)
                found, roles = keys_of(distinct, bands, costs)
                keys.append(found)
                tags.append(roles | np.uint64(node))
                held += len(found)
                if held > NUMBER_ROWS:
                    yield _numbers(["key", "tag"], np.concatenate(keys), np.concatenate(tags))
                    keys, tags, held = [], [], 0
            if held:
                yield _numbers(["key", "tag"], np.concatenate(keys), np.concatenate(tags))

    return df.select(text_col).mapInArrow(run, "key long, tag long")


def _numbers(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names)


class _Pairs:
    """Unordered pairs, without repeats within what is held."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.parts.append(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1))
        self.held += len(a)
        if self.held > HELD_PAIRS:
            self._squeeze()

    def _squeeze(self) -> None:
        both = np.concatenate(self.parts)
        both = both[both[:, 0] != both[:, 1]]
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        if len(both):
            both = both[np.concatenate(([True], (both[1:] != both[:-1]).any(axis=1)))]
        self.parts, self.held = [both], len(both)

    def full(self) -> bool:
        return self.held > HELD_PAIRS

    def taken(self) -> np.ndarray:
        if self.parts:
            self._squeeze()
        out = self.parts[0] if self.parts else np.zeros((0, 2), np.uint64)
        self.parts, self.held = [], 0
        return out


def _members(tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes that probe, and that are listed."""
    nodes = tags & ~np.uint64(3)
    return np.unique(nodes[tags & np.uint64(PROBE) > 0]), np.unique(nodes[tags & np.uint64(INDEX) > 0])


class _Groups:
    """Proposals of groups of tags in the order of keys, probing ones first; a group may come in parts."""

    def __init__(self):
        self.pairs, self.open_key, self.star = _Pairs(), None, (None, None)

    def twos(self, a: np.ndarray, b: np.ndarray) -> None:
        """Groups of two rows each: a pair if one asks and the other is listed."""
        asks, listed = np.uint64(PROBE), np.uint64(INDEX)
        pair = ((a & asks > 0) & (b & listed > 0)) | ((b & asks > 0) & (a & listed > 0))
        nodes = ~np.uint64(3)
        self.pairs.add(a[pair] & nodes, b[pair] & nodes)

    def part(self, key: int, tags: np.ndarray, goes_on: bool) -> bool:
        """Propose pairs of a part: all of a small whole group, else a star. Whether its rows need another look."""
        probing, listed = _members(tags)
        if key != self.open_key:
            self.open_key, self.star = None, (None, None)
            if not len(probing) or not (len(listed) or goes_on):
                if goes_on:
                    self.open_key = key  # probing rows come first: there are none
                return False
            if not goes_on and len(probing) <= SMALL_GROUP and len(listed) <= SMALL_GROUP:
                self.pairs.add(np.repeat(probing, len(listed)), np.tile(listed, len(probing)))
                return False
        elif self.star[0] is None:
            return False
        if goes_on:
            self.open_key = key
        first_probing, first_listed = self.star
        if first_probing is None:
            first_probing = probing[0]
        if first_listed is None and len(listed):
            first_listed = listed[0]
        self.star = (first_probing, first_listed)
        if first_listed is not None:
            self.pairs.add(probing, np.full(len(probing), first_listed))
        self.pairs.add(listed, np.full(len(listed), first_probing))
        return True


def _proposed(listed: DataFrame) -> DataFrame:
    """Rows (key, tag) to proposals (NULL, u, v) and, of groups that need another look, their rows (key, tag, NULL)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, rest_keys, rest_tags = _Groups(), np.zeros(0, np.uint64), np.zeros(0, np.uint64)

        def answer(key, u, v) -> pa.RecordBatch:
            none = pa.nulls(len(u), pa.int64())
            arrays = [none if c is None else pa.array(c.view(np.int64)) for c in (key, u, v)]
            return pa.RecordBatch.from_arrays(arrays, ["key", "u", "v"])

        def told(keys: np.ndarray, tags: np.ndarray, goes_on: bool) -> Iterator[pa.RecordBatch]:
            """Whole groups; with ``goes_on`` a part of one."""
            if len(keys):
                starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                ends = np.append(starts[1:], len(keys))
                asked = np.add.reduceat((tags & np.uint64(PROBE) > 0).astype(np.int64), starts) > 0
                wanted = (asked & (ends - starts > 1)) | goes_on
                wanted[0] |= keys[0] == groups.open_key
                if not goes_on:  # most groups are two rows: all of these at once
                    two = wanted & (ends - starts == 2) & (keys[starts] != groups.open_key if groups.open_key is not None else True)
                    groups.twos(tags[starts[two]], tags[starts[two] + 1])
                    wanted &= ~two
                for a, b in zip(starts[wanted].tolist(), ends[wanted].tolist()):
                    if groups.part(keys[a], tags[a:b], goes_on):
                        yield answer(keys[a:b], tags[a:b], None)
            if groups.pairs.full():
                yield from proposals()

        def proposals() -> Iterator[pa.RecordBatch]:
            out = groups.pairs.taken()
            yield answer(None, out[:, 0].copy(), out[:, 1].copy())

        for batch in batches:
            keys, tags = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            if not len(keys):
                continue
            keys, tags = np.concatenate((rest_keys, keys)), np.concatenate((rest_tags, tags))
            cut = int(np.searchsorted(keys.view(np.int64), keys.view(np.int64)[-1]))  # the last group may go on
            yield from told(keys[:cut], tags[:cut], False)
            rest_keys, rest_tags = keys[cut:], tags[cut:]
            if len(rest_keys) > GROUP_ROWS:
                yield from told(rest_keys, rest_tags, True)
                rest_keys, rest_tags = rest_keys[:0], rest_tags[:0]
        yield from told(rest_keys, rest_tags, False)
        yield from proposals()

    silent = F.col("tag").bitwiseAND(F.lit(PROBE).cast("long")) == 0
    return listed.repartition("key").sortWithinPartitions("key", silent).mapInArrow(run, "key long, u long, v long")


def parity_words(hashes: np.ndarray, words: int) -> np.ndarray:
    """Parities of how many shingles fall on each bit of ``words`` words of 64 bits, a power of two."""
    counts = np.bincount((mix(hashes) & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set: four to eight bits for each shingle, up to 32 KB."""
    return parity_words(hashes, 1 << min(12, (len(hashes) // 16).bit_length()))


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same set with fewer words."""
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


class _Nearest:
    """The ``n`` pairs of each two components that differ least, and whether there were more."""

    def __init__(self, n: int):
        self.n, self.rows, self.held, self.cut = n, [], 0, False

    def add(self, roots_a: np.ndarray, roots_b: np.ndarray, apart: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        low, high = np.minimum(roots_a, roots_b), np.maximum(roots_a, roots_b)
        ends = [np.minimum(a, b).view(np.int64), np.maximum(a, b).view(np.int64)]
        self.rows.append(np.stack([low, high, apart, *ends], axis=1))
        self.held += len(a)
        if self.held > HELD_PAIRS:
            self._squeeze()

    def _squeeze(self) -> None:
        rows = np.concatenate(self.rows)
        rows = rows[np.lexsort(rows.T[::-1])]
        rows = rows[np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))] if len(rows) else rows
        lead = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))) if len(rows) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(lead, len(rows)))
        kept = np.arange(len(rows)) - np.repeat(lead, sizes) < self.n
        self.cut |= not kept.all()
        self.rows, self.held = [rows[kept]], int(kept.sum())

    def taken(self) -> np.ndarray:
        if self.rows:
            self._squeeze()
        return self.rows[0][:, 3:] if self.rows else np.zeros((0, 2), np.int64)


def crossing_pairs(
    nodes: np.ndarray, roots: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, probing: np.ndarray, listed: np.ndarray,
    bands: Bands, n: int,
) -> tuple[np.ndarray, bool]:
    """Pairs of probing and listed members of different components that size and sketch allow to be similar: the ``n`` nearest of each
    two components, and whether there are more."""
    names, counts = np.unique(roots, return_counts=True)
    main, nearest = roots == names[counts.argmax()], _Nearest(n)

    def compare(left: np.ndarray, right: np.ndarray) -> None:
        if not len(left) or not len(right):
            return
        step = max(1, (1 << 21) // len(right))
        for at in range(0, len(left), step):
            a = left[at : at + step]
            i, j = np.nonzero((roots[a][:, None] != roots[right]) & bands.near(sizes[a][:, None], sizes[right]))
            for k in range(0, len(i), 1 << 14):
                x, y = a[i[k : k + (1 << 14)]], right[j[k : k + (1 << 14)]]
                apart = np.bitwise_count(sketches[x] ^ sketches[y]).sum(axis=1, dtype=np.int64)
                ok = apart <= bands.bound(sizes[x] + sizes[y])
                nearest.add(roots[x[ok]], roots[y[ok]], apart[ok], nodes[x[ok]], nodes[y[ok]])

    asks, is_listed = np.flatnonzero(probing), np.flatnonzero(listed)
    compare(asks[~main[asks]], is_listed)
    compare(asks[main[asks]], is_listed[~main[is_listed]])
    return nearest.taken(), nearest.cut


def _crossing(rows: DataFrame, bands: Bands, n: int) -> DataFrame:
    """Rows (cell, key, tag, root, size, sketch) to proposals (NULL, u, v), and (key, NULL, NULL) of groups that have more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if not group:
                return
            keys, tags, roots, sizes = (np.array(c, np.int64) for c in list(zip(*group))[:4])
            sketches = [np.frombuffer(row[4], np.uint64) for row in group]
            words = min(map(len, sketches))
            whole = np.stack([folded(x, words) for x in sketches])
            pairs, cut = crossing_pairs(tags.view(np.uint64) & ~np.uint64(3), roots, sizes, whole, tags & PROBE > 0, tags & INDEX > 0, bands, n)
            none = pa.nulls(len(pairs), pa.int64())
            names = ["key", "u", "v"]
            yield pa.RecordBatch.from_arrays([none, pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names)
            if cut:
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys[:1]), none, none], names)

        for batch in batches:
            for cell, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if cell != current:
                    yield from flush()
                    current, group = cell, []
                group.append(row)
        yield from flush()

    dealt = rows.select("cell", "key", "tag", "root", "size", "sketch").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "key long, u long, v long")


def _filter_of(hashes: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A bit filter of rows (hash): two bits each, at most ``FILTER_BITS`` in all, so that it is small whatever the corpus is."""
    bits = min(FILTER_BITS, max(1 << 12, 1 << (16 * hashes.count()).bit_length()))
    mask = F.lit(bits - 1).cast("long")
    places = F.explode(F.array(*[F.shiftrightunsigned("hash", n).bitwiseAND(mask) for n in (0, 32)]))
    words = hashes.select(places.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    ).toArrow()
    held = np.zeros(bits // 64, np.uint64)
    held[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)

    def holds(of: np.ndarray) -> np.ndarray:
        out = np.ones(len(of), bool)
        for n in (0, 32):
            bit = (of >> np.uint64(n)) & np.uint64(bits - 1)
            out &= (held[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
        return out

    return holds


def sets_of(df: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingles: Shingles, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the given nodes, each from one of its documents (id, node).

    Texts are not shuffled: a task looks at those whose id passes a small filter.
    """
    hashed = F.xxhash64(F.col(id_col).cast("string"))
    holds = _filter_of(docs.join(nodes, "node").groupBy("node").agg(F.min(hashed).alias("hash")).select("hash").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            batch, nodes, sets = batch.filter(pa.array(holds(batch.column(0).to_numpy().view(np.uint64)))), [], []
            for distinct in shingles(batch.column(1).to_pylist()):
                node = node_of(distinct)
                if len(distinct) and node not in seen:
                    seen.add(node)
                    nodes.append(node - (1 << 64) * (node >> 63))
                    sets.append(distinct.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    found = df.select(hashed.alias("hash"), text_col).mapInArrow(run, "node long, shingles array<long>")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def may_be_similar(pairs: DataFrame, sketches: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (u, v) whose sizes and sketches allow them to be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in (2, 4))
            fits = bands.near(a, b)
            for i in np.flatnonzero(fits).tolist():
                one, two = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (3, 5))
                words = min(len(one), len(two))
                fits[i] = np.bitwise_count(folded(one, words) ^ folded(two, words)).sum() <= bands.bound(int(a[i] + b[i]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(fits))

    one = sketches.select(F.col("node").alias("u"), F.col("size").alias("a"), F.col("sketch").alias("s"))
    two = sketches.select(F.col("node").alias("v"), F.col("size").alias("b"), F.col("sketch").alias("t"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "a", "s", "b", "t").mapInArrow(run, "u long, v long")


def similar(links: DataFrame, sets: DataFrame, percent: float) -> DataFrame:
    """Those links (u, v) whose whole sets (node, shingles) are similar."""
    one = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    two = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    shared = F.size(F.array_intersect("a", "b")).cast("long")
    both = links.join(two, "v").join(one, "u")
    return both.where(100 * shared >= percent * (F.size("a") + F.size("b") - shared)).select("u", "v")


def _split_groups(again: DataFrame, roots: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows (cell, key, tag, root, size, sketch) of the groups that have several components."""
    named = again.withColumn("node", F.col("tag").bitwiseAND(F.lit(~3).cast("long"))).join(roots, "node", "left")
    named = stored(named.select("key", "tag", "node", F.coalesce("root", "node").alias("root")), "members")
    mixed = named.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("rows"))
    mixed = stored(mixed.where("a <> b").select("key", F.ceil(F.col("rows") / F.lit(GROUP_ROWS)).cast("int").alias("n")), "mixed")
    rows = named.join(mixed, "key").join(sketches, "node")
    # Probing rows of each chunk meet listed rows of each chunk; a group of one chunk is one cell, to which a row of both roles goes once.
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("n")).cast("int")
    chunks = F.sequence(F.lit(0), F.col("n") - 1)

    def cells(role: int, cell: Callable) -> Column:
        has = F.col("tag").bitwiseAND(F.lit(role).cast("long")) > 0
        tag = F.col("node").bitwiseOR(F.lit(role).cast("long"))
        return F.when(has, F.transform(chunks, lambda other: F.struct(cell(other).alias("cell"), tag.alias("tag")))).otherwise(F.array())

    several = F.concat(cells(PROBE, lambda other: F.xxhash64("key", "own", other)), cells(INDEX, lambda other: F.xxhash64("key", other, "own")))
    one = F.array(F.struct(F.xxhash64("key", F.lit(0), F.lit(0)).alias("cell"), "tag"))
    spread = rows.withColumn("own", own).withColumn("__cells", F.when(F.col("n") == 1, one).otherwise(several))
    return spread.select(F.explode("__cells").alias("c"), "key", "root", "size", "sketch").select("c.cell", "key", "c.tag", "root", "size", "sketch")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (u, v) of different components."""
    one, two = (roots.select(F.col("node").alias(end), F.col("root").alias(f"of_{end}")).hint("merge") for end in ("u", "v"))
    named = pairs.join(one, "u", "left").join(two, "v", "left")
    return named.where(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v")


def _near_sizes(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose sizes (node, size) allow them to be similar."""
    one, two = (sizes.select(F.col("node").alias(end), F.col("size").alias(f"of_{end}")).hint("merge") for end in ("u", "v"))
    near = 100 * F.least("of_u", "of_v") >= percent * F.greatest("of_u", "of_v")
    return pairs.join(one, "u").join(two, "v").where(near).select("u", "v")


def linked_sets(
    df: DataFrame, id_col: str, text_col: str, shingles: Shingles, percent: int, keys_of: Keys = entries, known: DataFrame | None = None,
    exact_percent: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents (id, node, size) and the (node, root) of those nodes that have links. Runs jobs.

    With ``known`` links (u, v) of nodes only pairs that these leave apart are looked at. ``exact_percent`` has a bound's part of a percent.
    """
    spark = df.sparkSession
    small_batches(spark)
    bands = Bands(percent)
    seen = stored(sketched(df, id_col, text_col, shingles), "sketches")
    docs = seen.where("size IS NOT NULL").select(id_col, "node", "size")
    sketches = seen.where("sketch IS NOT NULL").select("node", "size", "sketch").dropDuplicates(["node"])
    documents = docs.count()
    frequent = seen.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("count").alias("count"))
    frequent = frequent.where(F.col("count") >= FREQUENT * documents / 2).orderBy(F.desc("count"), "shingle").limit(COST_ENTRIES).collect()
    costs = Costs([r["shingle"] for r in frequent], [r["count"] for r in frequent], documents)

    listed = _listed(df, text_col, shingles, keys_of, bands, costs)
    small_batches(spark, NUMBER_ROWS)
    found = stored(_proposed(listed), "proposals")
    small_batches(spark)

    def checked(pairs: DataFrame) -> DataFrame:
        near = stored(may_be_similar(pairs, sketches, bands), "near")
        ends = stored(near.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "ends")
        sets = stored(sets_of(df, docs, id_col, text_col, shingles, ends), "sets")
        return stored(similar(near, sets, exact_percent or percent), "links")

    tried = found.where("key IS NULL").select("u", "v").distinct()
    if known is not None:
        roots = stored(components(known), "roots")
        tried = _near_sizes(_apart(tried, roots), docs.select("node", "size").dropDuplicates(["node"]), percent)
    tried = stored(tried, "pairs")
    links = checked(tried) if known is None else known.unionByName(checked(tried))
    roots = stored(components(links), "roots")

    # Rounds until no group has a pair left that crosses components and was not verified.
    again, n = found.where("key IS NOT NULL").select("key", F.col("u").alias("tag")), FIRST_ROUND
    while True:
        answers = stored(_crossing(_split_groups(again, roots, sketches), bands, n), "crossing")
        fresh = stored(answers.where("v IS NOT NULL").select("u", "v").distinct().join(tried, ["u", "v"], "left_anti"), "pairs")
        more = stored(answers.where("v IS NULL").select("key").distinct(), "more")
        if not fresh.isEmpty():
            tried = tried.unionByName(fresh)
            links = links.unionByName(checked(fresh))
            roots = stored(components(links), "roots")
        if more.isEmpty():
            break
        again, n = stored(again.join(more, "key", "left_semi"), "again"), n * ROUND_GROWTH
    return docs, roots


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id) per row: the least id reachable by links between similar sets. Runs jobs."""
    docs, roots = linked_sets(df, id_col, text_col, lambda texts: shingle_sets(texts, shingle_words), percent)
    firsts = docs.where("node IS NOT NULL").groupBy("node").agg(F.min(id_col).alias("first_id"))
    named = stored(firsts.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root")), "named")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = stored(named.join(least, "root").select("node", "component_id"), "classes")
    joined = docs.join(classes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col(id_col)).otherwise(F.col("component_id"))
    return joined.select(id_col, F.col("size").alias("n_shingles"), component.alias("component_id"))
