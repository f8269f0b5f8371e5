"""SimHash fingerprints, linked within a Hamming radius through BK-trees.

A fingerprint is cut into ``radius + 1`` bands; two fingerprints within the radius agree on one band at
least. Distinct fingerprints are therefore dealt into shards by (band, value), and each shard becomes one
BK-tree: children are keyed by their integer Hamming distance to the parent, and a search enters only the
edges whose distance lies within the radius of its own. The trees of all documents have no bounded size, so
they are not broadcast from the driver: a shard's tree meets its searches in the task that owns the shard.

Equal fingerprints are one node from the start, so a group of copies costs one tree entry. A shard of more
than ``SHARD_NODES`` fingerprints is dealt again by the bands of its other bits; what is still larger is cut
into chunks, and the tree of each chunk is searched by each chunk in a task of its own. A shard returns at
most one link per node (a spanning forest of its links), never all pairs, and no link between components is lost.

``near_duplicates`` serves a stated similarity of shingle sets in place of a radius. It begins with the same shards and trees
at ``RADIUS``. At a similarity of 0.8 some ten bits differ, which bands of the fingerprint cannot reach; so further shards, keyed by groups
of minimal shingle hashes, are searched with a wide radius. Links are checked on whole sets. A search names the nodes that have
a candidate outside their component, and only these meet again with their sets, in the task that owns the shard: it
checks every candidate pair whose ends are still apart there and returns a spanning forest, so rows grow with nodes, never with pairs.

Edge cases: a NULL or word-less text has fingerprint zero and is linked like any other. A NULL document id
takes part in links but never names a component, unless all ids of the component are NULL. Repeated rows are
copies. An empty table gives an empty result. Other columns are ignored unless asked for in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import give_back, small_batches, stored
from tierflow.llm.components import components

SEED = 42
#: Differing bits of linked fingerprints.
RADIUS = 3
#: Fingerprints in one tree; beyond it a shard is dealt again, then cut into chunks.
SHARD_NODES = 16_384
#: Up to this size a tree is walked node by node, beyond it by arrays of searches.
SMALL_TREE = 48
#: Closest fingerprints of each tree that are proposed besides the links that connect it.
NEAREST = 3


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """XXH64 of each run of words, repeats included; of the whole sequence if it is shorter."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes.lower() and split() know ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k, digest = min(shingle_words, len(words)), xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist())), np.uint64, len(words) - k + 1
    )


def majority(hashes: np.ndarray) -> int:
    """A bit is one if it is one in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    return majority(shingle_hashes(text, shingle_words))


def with_fingerprints(
    df: DataFrame, text_col: str = "text", keep: list[str] | None = None, out: str = "fingerprint", shingle_words: int = 3
) -> DataFrame:
    """Add the fingerprint as a long of the same bits."""
    small_batches(df.sparkSession)
    kept = df.columns if keep is None else keep
    if out in kept:
        raise ValueError(f"column {out} exists already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle_words) for t in batch.column(len(kept)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(prints.view(np.int64))], [*kept, out])

    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.LongType())])
    return df.select(*kept, df[text_col].alias("__text")).mapInArrow(run, schema)


class _Groups:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def tree_links(prints: list[int], radius: int, nearest: bool = False) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Insert each fingerprint after searching the tree that holds the earlier ones.

    Returns links that connect all that is linked: a spanning forest, so fewer than there are fingerprints.
    With ``nearest`` also links of each fingerprint to the ``NEAREST`` closest other ones, apart from these.
    """
    groups, children, out = _Groups(len(prints)), [{} for _ in prints], []
    met: list[list[tuple[int, int]]] = [[] for _ in prints]
    for i in range(1, len(prints)):
        value, stack = prints[i], [0]
        while stack:
            node = stack.pop()
            d = (prints[node] ^ value).bit_count()
            if d <= radius:
                if groups.join(node, i):
                    out.append((node, i))
                if nearest:
                    met[i].append((d, node))
                    met[node].append((d, i))
            edges = children[node]
            stack += [edges[e] for e in range(d - radius, d + radius + 1) if e in edges]
        node = 0
        while (child := children[node].get(d := (prints[node] ^ value).bit_count())) is not None:
            node = child
        children[node][d] = i
    return out, [(j, i) for i, found in enumerate(met) for _, j in sorted(found)[:NEAREST]]


def array_tree_links(
    prints: np.ndarray, in_tree: np.ndarray, searches: np.ndarray, radius: int, nearest: bool = False
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The same with all searches going down the tree together: a node gets the searches that enter its edge."""
    groups, label, out = _Groups(len(prints)), np.arange(len(prints)), []
    best, at = np.full((len(prints), NEAREST), radius + 1), np.full((len(prints), NEAREST), -1)
    stack = [(in_tree, searches)]
    while stack:
        members, asking = stack.pop()
        node, members = int(members[0]), members[1:]
        distance = np.bitwise_count(prints[asking] ^ prints[node])
        met = asking[distance <= radius]
        if met.size:
            _, places = np.unique(label[met], return_index=True)
            out += [(node, other) for other in met[places].tolist() if groups.join(node, other)]
            label[met] = label[node] = groups.find(node)
        if nearest:
            worst = best[asking].argmax(axis=1)
            closer = (distance < best[asking, worst]) & (asking != node)
            best[asking[closer], worst[closer]], at[asking[closer], worst[closer]] = distance[closer], node
        if members.size:
            edge = np.bitwise_count(prints[members] ^ prints[node])
            for e in np.unique(edge).tolist():
                entering = asking[np.abs(distance.astype(np.int16) - e) <= radius]
                if entering.size:
                    stack.append((members[edge == e], entering))
    found, slot = np.nonzero(at >= 0)
    return out, list(zip(at[found, slot].tolist(), found.tolist()))


def shard_links(prints: np.ndarray, nodes: np.ndarray, side: np.ndarray, radius: int, nearest: bool) -> list[tuple[int, int, bool]]:
    """Links of one shard, and whether they go beyond the forest. side 0: tree and search, 1: tree only, 2: search only."""
    if len(prints) < 2:
        return []
    if len(prints) <= SMALL_TREE and not side.any():
        forest, more = tree_links(prints.tolist(), radius, nearest)
    else:
        places = np.arange(len(prints))
        tree, asking = places[side != 2], places[side != 1]
        if not tree.size or not asking.size:
            return []
        forest, more = array_tree_links(prints, tree, asking, radius, nearest)
    named = nodes.tolist()
    return [(named[i], named[j], extra) for pairs, extra in ((forest, False), (more, True)) for i, j in pairs]


def within(prints: np.ndarray, in_tree: np.ndarray, searches: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each node of the tree with the searches that it answers; all searches go down together."""
    stack = [(in_tree, searches)]
    while stack:
        members, asking = stack.pop()
        node, members = int(members[0]), members[1:]
        distance = np.bitwise_count(prints[asking] ^ prints[node])
        yield node, asking[distance <= radius]
        if members.size:
            edge = np.bitwise_count(prints[members] ^ prints[node])
            for e in np.unique(edge).tolist():
                entering = asking[np.abs(distance.astype(np.int16) - e) <= radius]
                if entering.size:
                    stack.append((members[edge == e], entering))


def with_candidates(
    side: np.ndarray, prints: np.ndarray, roots: np.ndarray, sizes: np.ndarray, least: np.ndarray, radius: int, similarity: float
) -> np.ndarray:
    """The places that have another component's node within the radius whose set may share enough, by sizes and least hashes."""
    places, found = np.arange(len(prints)), np.zeros(len(prints), bool)
    for node, near in within(prints, places[side != 2], places[side != 1], radius):
        near = near[roots[near] != roots[node]]
        if found[node]:
            near = near[~found[near]]
        near = near[np.minimum(sizes[near], sizes[node]) >= similarity * np.maximum(sizes[near], sizes[node])]
        near = near[may_share(least[near], sizes[near], least[node], int(sizes[node]))]
        if near.size:
            found[near] = found[node] = True
    return np.flatnonzero(found)


def set_links(
    side: np.ndarray, prints: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], radius: int, similarity: float
) -> list[tuple[int, int]]:
    """Links between sets that share enough: as many as connect the components of one shard. ``roots`` is changed.

    Every pair within the radius is checked on its whole sets, unless its ends are connected by then.
    """
    places, out = np.arange(len(prints)), []
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    hashes, member = np.unique(np.concatenate(sets), return_inverse=True)
    member, marked = member.astype(np.int32), np.zeros(len(hashes), bool)
    for node, near in within(prints, places[side != 2], places[side != 1], radius):
        # A pair of which both are in the tree and search is met twice.
        near = near[(roots[near] != roots[node]) & ((side[near] != side[node]) | (near > node)) & (sizes[near] > 0)]
        near = near[np.minimum(sizes[near], sizes[node]) >= similarity * np.maximum(sizes[near], sizes[node])]
        if not near.size:
            continue
        own = member[starts[node] : starts[node] + sizes[node]]
        marked[own] = True
        ends = np.cumsum(sizes[near])
        for part in np.split(near, np.flatnonzero(np.diff(ends // CHECKED_AT_ONCE)) + 1):
            part = part[roots[part] != roots[node]]
            if not part.size:
                continue
            first = np.cumsum(sizes[part]) - sizes[part]
            at = np.arange(sizes[part].sum()) + np.repeat(starts[part] - first, sizes[part])
            shared = np.add.reduceat(marked[member[at]], first, dtype=np.int64)
            for other in part[shared >= similarity * (sizes[part] + sizes[node] - shared)].tolist():
                if roots[other] != roots[node]:
                    out.append((node, other))
                    roots[roots == roots[other]] = roots[node]
        marked[own] = False
    return out


def may_share(rows: np.ndarray, sizes: np.ndarray, one: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``LEAST`` least hashes of sets allow a similarity of 0.8 with one set's.

    The hashes up to the lesser of both greatest ones are a sample of ``LEAST`` or more of the union, or the whole union.
    Half of it must be shared; at 0.8 less is with a chance of 0.00004 (binomial, 15 or fewer of 32).
    """
    if not len(rows):
        return np.zeros(0, bool)
    none = np.uint32(0xFFFFFFFF)
    end = np.where(sizes > LEAST, rows[:, -1], none)
    end = np.minimum(end, one[-1] if size > LEAST else none)[:, None]
    in_rows, in_one = (rows <= end) & (np.arange(LEAST) < sizes[:, None]), (one <= end) & (np.arange(LEAST) < size)
    shared = (in_rows & np.isin(rows, one[: min(size, LEAST)])).sum(axis=1)
    return 2 * shared >= in_rows.sum(axis=1) + in_one.sum(axis=1) - shared


def _dealt(shards: DataFrame, bits: int, bands: int, node: str = "print") -> DataFrame:
    """Each row once per band of its remaining ``bits``; that band joins the shard's key and leaves the rest."""
    rest, options, low = F.col("rest"), [], 0
    for b in range(bands):
        width = bits // bands + (b < bits % bands)
        value = F.shiftrightunsigned(rest, low).bitwiseAND(F.lit((1 << width) - 1))
        below = rest.bitwiseAND(F.lit((1 << low) - 1)) if low else F.lit(0).cast("long")
        above = F.shiftleft(F.shiftrightunsigned(rest, low + width), low) if low + width < 64 else F.lit(0).cast("long")
        key: Column = F.xxhash64("shard", F.lit(b), value)
        options.append(F.struct(key.alias("shard"), above.bitwiseOR(below).alias("rest")))
        low += width
    rows = shards.select("print", F.col(node).alias("node"), F.explode(F.array(*options)).alias("s"))
    return rows.select("s.shard", "s.rest", "print", "node")


def _split_hot(shards: DataFrame, limit: int, size: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of shards up to the limit, and of larger ones with their size: rows, unless another total is given."""
    size = F.count(F.lit(1)) if size is None else size
    sizes = stored(shards.groupBy("shard").agg(size.alias("size")).where(F.col("size") > limit), "hot-shards")
    return shards.join(sizes, "shard", "left_anti"), shards.join(sizes, "shard")


def _links(shards: DataFrame, radius: int, nearest: bool = False) -> DataFrame:
    """Links of all shards; rows (shard, side, print, node). A task holds one shard at a time, in the order of prints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, prints, nodes, sides = None, [], [], []

        def flush():
            return shard_links(np.concatenate(prints), np.concatenate(nodes), np.concatenate(sides), radius, nearest) if prints else []

        def answer(rows):
            u, v, more = zip(*rows) if rows else ([], [], [])
            arrays = [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(more, pa.bool_())]
            return pa.RecordBatch.from_arrays(arrays, ["u", "v", "more"])

        for batch in batches:
            keys, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            value, node = batch.column(2).to_numpy().view(np.uint64), batch.column(3).to_numpy()
            cuts = np.flatnonzero(np.diff(keys)) + 1
            rows = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if a == b:
                    continue
                if keys[a] != current:
                    rows += flush()
                    current, prints, nodes, sides = keys[a], [], [], []
                prints.append(value[a:b])
                nodes.append(node[a:b])
                sides.append(side[a:b])
            yield answer(rows)
        yield answer(flush())

    dealt = shards.select("shard", "side", "print", "node").repartition("shard").sortWithinPartitions("shard", "print", "node")
    return dealt.mapInArrow(run, "u long, v long, more boolean")


def _plain(shards: DataFrame) -> DataFrame:
    return shards.select("shard", F.lit(0).cast("byte").alias("side"), "print", "node")


def _chunked(hot: DataFrame, limit: int) -> DataFrame:
    """Shards of a known size in chunks: a row goes to each pair of its own chunk with another."""
    n = F.ceil(F.col("size") / F.lit(limit / 2)).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(1)), n).cast("int")
    rows = hot.select("shard", "print", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), n - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    key = F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(key.alias("shard"), side.cast("byte").alias("side"), "print", "node")


def linked(prints: DataFrame, radius: int = RADIUS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Distinct fingerprints (print long) to (node, root) of those with a link to another. Runs jobs."""
    bands = radius + 1
    whole = prints.select(F.lit(0).cast("long").alias("shard"), F.col("print").alias("rest"), "print")
    first = stored(_dealt(whole, 64, bands), "shards")
    small, hot = _split_hot(first, shard_nodes)
    shards = _plain(small)
    if not hot.isEmpty():
        second = stored(_dealt(hot, 64 - 64 // bands, bands), "shards")
        small, hot = _split_hot(second, shard_nodes)
        shards = shards.unionByName(_plain(small)).unionByName(_chunked(hot, shard_nodes))
    return components(_links(shards, radius).select("u", "v"))


def near_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle_words: int = 3,
    shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """(id, fingerprint long, component_id) per row: the least id reachable over links. Runs jobs."""
    docs = stored(with_fingerprints(df, text_col, [id_col], shingle_words=shingle_words), "fingerprints")
    firsts = stored(docs.groupBy(F.col("fingerprint").alias("node")).agg(F.min(id_col).alias("first_id")), "prints")
    roots = linked(firsts.select(F.col("node").alias("print")), radius, shard_nodes)
    return _classes(docs.withColumn("node", F.col("fingerprint")), firsts, roots, id_col)


#: For a similarity of 0.8: bins of shingle hashes, minima that share one shard key, and the radius of the search.
#: Fingerprints are then of distinct shingles. A bit of two sets at 0.8 differs with a chance of 0.15 (acos(0.8 / 0.9) / pi)
#: for long texts and of 0.1875 at most (sets of four and five shingles), so over 25 bits differ in one pair of 20,000 at most.
BINS, PER_KEY, WIDE_RADIUS = 32, 3, 25


def shard_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys under which similar sets meet: the least hash of each bin, an empty bin taking the next one's, in groups."""
    if not hashes.size:
        return np.zeros(1, np.uint64)
    ordered = np.unique(hashes)
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - (BINS - 1).bit_length())
    least = ordered[np.searchsorted(ordered, edges) % len(ordered)]
    keys = np.arange(1, BINS // PER_KEY + 1, dtype=np.uint64)
    for i in range(PER_KEY):
        keys = (keys ^ least[i : len(keys) * PER_KEY : PER_KEY]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


#: Least hashes that a node carries into the search.
LEAST = 32
#: Shingle hashes that count as one node of a shard's size, and those compared with one set at once.
HASHES_A_NODE, CHECKED_AT_ONCE = 256, 1 << 20


def least_hashes(distinct: np.ndarray) -> bytes:
    """The least hashes of a set given in order, shortened to 32 bits and filled up."""
    least = (distinct[:LEAST] >> np.uint64(32)).astype(np.uint32)
    return np.concatenate((least, np.full(LEAST - len(least), 0xFFFFFFFF, np.uint32))).tobytes()


def _by_shard(batches: Iterator[pa.RecordBatch], read) -> Iterator[tuple[int, list[tuple]]]:
    """(shard, pieces of each column) from rows in the order of shards. ``read``: a batch to its columns."""
    current, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, columns = batch.column(0).to_numpy(), read(batch)
        cuts = (np.flatnonzero(np.diff(keys)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            if parts and keys[a] != current:
                yield int(current), list(zip(*parts))
                parts = []
            current = keys[a]
            parts.append([c[a:b] for c in columns])
    if parts:
        yield int(current), list(zip(*parts))


def _in_shards(shards: DataFrame) -> DataFrame:
    return shards.repartition("shard").sortWithinPartitions("shard", "print", "node")


def _open_nodes(shards: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Of rows (shard, side, print, node, root, size, least) those that ``with_candidates`` finds, without size and least."""

    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        least = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint32).reshape(-1, LEAST)
        return [*(batch.column(i).to_numpy() for i in range(1, 6)), least]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, columns in _by_shard(batches, read):
            side, prints, nodes, roots, sizes, least = map(np.concatenate, columns)
            if (side != 2).any() and (side != 1).any() and (roots != roots[0]).any():
                at = with_candidates(side, prints.view(np.uint64), roots, sizes, least, radius, similarity)
                if at.size:
                    arrays = [np.full(len(at), shard), side[at], prints[at], nodes[at], roots[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["shard", "side", "print", "node", "root"])
        give_back()

    rows = _in_shards(shards.select("shard", "side", "print", "node", "root", "size", "least"))
    return rows.mapInArrow(run, "shard long, side byte, print long, node long, root long")


def _set_links(shards: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Rows (shard, side, print, node, root, part) to the links (u, v) of ``set_links``."""

    def read(batch: pa.RecordBatch) -> list:
        part = batch.column(5)
        ends, values = part.offsets.to_numpy(), part.values.to_numpy()
        return [*(batch.column(i).to_numpy() for i in range(1, 5)), [values[a:b] for a, b in zip(ends, ends[1:])]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in _by_shard(batches, read):
            side, prints, nodes, roots = map(np.concatenate, columns[:4])
            sets = [x for piece in columns[4] for x in piece]
            if (side != 2).any() and (side != 1).any():
                links = set_links(side, prints.view(np.uint64), roots, sets, radius, similarity)
                if links:
                    u, v = np.array(links).T
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[u]), pa.array(nodes[v])], ["u", "v"])
        give_back()

    return _in_shards(shards.select("shard", "side", "print", "node", "root", "part")).mapInArrow(run, "u long, v long")


def _undirected(links: DataFrame) -> DataFrame:
    return links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def set_hash(distinct: np.ndarray) -> int:
    """One hash of a whole shingle set, given in order; its two lowest bits are zero."""
    import xxhash

    return xxhash.xxh64_intdigest(distinct.tobytes(), SEED) & ~3


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8,
    radius: int = WIDE_RADIUS, shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """(id, fingerprint, component_id): rows linked by a shared part of ``similarity`` or more of their shingle sets.

    Equal shingle sets are copies and one node; links between other nodes, of equal fingerprint too, are proposed
    by the trees and count after a check on whole shingle sets; at last those that the trees left apart come from ``shingle_join``.
    Runs jobs.
    """
    from tierflow.llm import shingle_join  # it imports this module

    small_batches(df.sparkSession)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.unique(shingle_hashes(t, shingle_words)) for t in batch.column(1).to_pylist()]
            prints = np.array([majority(h) for h in hashes], np.uint64).view(np.int64)
            nodes = np.array([set_hash(h) for h in hashes], np.uint64).view(np.int64)
            keys = pa.array([shard_keys(h).view(np.int64) for h in hashes], pa.list_(pa.int64()))
            sizes, least = pa.array([len(h) for h in hashes], pa.int64()), pa.array([least_hashes(h) for h in hashes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints), pa.array(nodes), sizes, least, keys], [id_col, "fingerprint", "node", "size", "least", "keys"]
            )
        give_back()

    longs = [T.StructField(n, T.LongType()) for n in ("fingerprint", "node", "size")]
    schema = T.StructType([df.schema[id_col], *longs, T.StructField("least", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    docs = stored(df.select(id_col, text_col).mapInArrow(sketch, schema), "sketches")
    of_node = [F.first(c).alias(c) for c in ("fingerprint", "size", "least", "keys")]
    nodes = stored(docs.groupBy("node").agg(F.min(id_col).alias("first_id"), *of_node).withColumnRenamed("fingerprint", "print"), "nodes")

    # Fingerprints within the narrow radius: no such link is lost by their bands.
    whole = nodes.select(F.lit(0).cast("long").alias("shard"), F.col("print").alias("rest"), "print", "node")
    banded = stored(_dealt(whole, 64, RADIUS + 1, "node").drop("rest"), "bands")
    small, hot = _split_hot(banded, shard_nodes)
    close = stored(_undirected(_links(_plain(small).unionByName(_chunked(hot, shard_nodes)), RADIUS)), "links")
    sure = stored(_similar(close, df, docs, id_col, text_col, shingle_words, similarity), "checked")
    roots = stored(components(sure), "roots")

    # Beyond it shards of minimal hashes, where several components meet; a shard with large sets is cut into more chunks.
    shards = stored(nodes.select(F.explode("keys").alias("shard"), "print", "node", F.col("size").alias("hashes")), "shards")
    held = F.greatest(F.count(F.lit(1)), F.ceil(F.sum("hashes") / F.lit(HASHES_A_NODE)))
    small, hot = _split_hot(shards, shard_nodes, held)
    dealt = _plain(small).unionByName(_chunked(hot, shard_nodes))
    named = stored(dealt.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
    split = named.groupBy("shard").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("shard")
    asked = named.join(split.hint("merge"), "shard", "left_semi").join(nodes.select("node", "size", "least").hint("merge"), "node")
    apart = stored(_open_nodes(asked, radius, similarity), "open")
    sets = _sets(apart.select("node").distinct(), df, docs, id_col, text_col, shingle_words)
    more = stored(_set_links(apart.join(sets.hint("merge"), "node"), radius, similarity), "more")

    # Minimal hashes are random, and so are the wide radius and the least hashes. What all of that left apart meets by shingles: no link is lost.
    def distinct(texts: list[str | None]) -> list[np.ndarray]:
        return [np.unique(shingle_hashes(t, shingle_words)) for t in texts]

    known = sure.unionByName(more)
    _, roots = shingle_join.linked_sets(df, id_col, text_col, distinct, floor(100 * similarity), shingle_join.first_shingles, known, 100 * similarity)
    return _classes(docs.select(id_col, "fingerprint", "node"), nodes, roots, id_col)


def _sets(nodes: DataFrame, df: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(node, part): the shingle set of each node, as hashes of 32 bits. Texts are not shuffled. Runs jobs."""
    from tierflow.llm import shingle_join  # it imports this module

    def distinct(texts: list[str | None]) -> list[np.ndarray]:
        return [np.unique(shingle_hashes(t, shingle_words)) for t in texts]

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column(1)
            sets = [np.unique(x.values.to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.int32) for x in of]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int32()))], ["node", "part"])
        give_back()

    found = shingle_join.sets_of(df, docs, id_col, text_col, distinct, nodes)
    return stored(found.mapInArrow(shortened, "node long, part array<int>"), "shingle-sets")


def _similar(
    links: DataFrame, df: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle_words: int, similarity: float
) -> DataFrame:
    """Those links (u, v) whose shingle sets share enough. The set of a node is that of its first text."""
    ends = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).distinct()
    of_node = _sets(ends, df, docs, id_col, text_col, shingle_words)
    both = links.join(of_node.select(F.col("node").alias("u"), F.col("part").alias("a")), "u").join(
        of_node.select(F.col("node").alias("v"), F.col("part").alias("b")), "v"
    )
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(shared >= similarity * (F.size("a") + F.size("b") - shared)).select("u", "v")


def _classes(docs: DataFrame, firsts: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    """The least id of each component, given to every row. ``roots``: (node, root) of linked nodes."""
    roots = stored(roots, "roots")
    named = firsts.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_node = stored(named.join(least, "root").select("node", "component_id"), "classes")
    return docs.join(by_node, "node").select(id_col, "fingerprint", "component_id")


def one_per_group(df: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id names its component; of rows that repeat id and text one stays. Runs jobs."""
    names = stored(groups.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__id")).distinct(), "names")
    # The list of names grows with the rows, so it is joined by a shuffle whatever its size. Rows lie by id then, where copies are found.
    here = df.withColumn("__text", F.xxhash64(text_col))
    named = names.where("__id IS NOT NULL").hint("merge")
    rows = here.join(named, here[id_col] == named["__id"], "left_semi").dropDuplicates([id_col, "__text"])
    if not names.where("__id IS NULL").isEmpty():
        rows = rows.unionByName(here.where(F.col(id_col).isNull()).dropDuplicates([id_col, "__text"]))
    return rows.drop("__text")
