"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed bigram model. Every word is a state; the root is the state without
history. A state has an arc for each follower seen ``MIN_COUNT`` times or more, with absolute discounting, and
a failure arc to the root whose weight is the probability mass the arcs leave over. A text is read once from
left to right: the current state is carried, an arc or the failure arc plus a root arc is taken, and log10
probabilities add up. Root arcs have add-one smoothed counts over all words of the corpus.

Neither the words nor the arcs of a corpus have a bounded size, so no task and not the driver holds them all.
Documents lie in blocks of ``BLOCK_ROWS`` rows or ``BLOCK_TOKENS`` tokens. A block numbers its words and keeps its texts as those numbers.
It asks for its words and then for its word pairs: a row goes to each part of the words (pairs) with all that the block has
there, in a fixed order and with the block's own counts. The part adds them up over all blocks and answers each row with totals in the
same order, so a total is known by its place and neither words nor pairs travel back. Words seen ``MIN_COUNT`` times get
whole numbers that hold for the corpus; a pair is asked for by the numbers of its words, which is exact, and pairs with another word
are not asked for, since they cannot be seen often enough. Parts grow in number with the tokens, so what one holds is bounded.
A block's automaton is thus the part of the whole one that its texts can reach.
A caller may ask for a smaller model by ``state_share``: then only words of that share are states.
Every word and pair is in one row per block at most, so a very frequent one is never a large group.

Edge cases: a NULL text is empty: one end token. Without training rows all probabilities are 1. Rows are scored one by
one, repeated ids included. Words compare as bytes after A-Z became a-z. Other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from zlib import adler32, crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import small_batches, stored

#: The end of a text; no word holds a line break.
END = b"\n"
#: Between the words of a list; no word holds it.
GAP = b" "
NUMBERED_SHARE, MIN_COUNT, DISCOUNT = 1e-5, 2, 0.75
BLOCK_ROWS, BLOCK_TOKENS = 4096, 1 << 21
#: Words and pairs of all blocks that a part gets, on average.
PART_WORDS, PART_PAIRS = 1 << 19, 1 << 21
#: Numbers of words stay below it, so that a pair of them is one whole number of 63 bits.
_MOST = 3_000_000_000


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case, then the end; bytes.lower() and split() know ASCII only."""
    out = (text or "").encode().lower().split()
    out.append(END)
    return out


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _spread(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers from 0 on as compressed bytes, lowest bytes first; ``rising`` ones by their differences."""
    values = np.asarray(values).astype(np.uint64)
    if rising:
        values = np.diff(values, prepend=np.uint64(0))  # modulo 2 ** 64, so any order comes back right
    width = np.min_scalar_type(values.max(initial=0)).itemsize
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + _squeezed(planes.tobytes())


def unpacked(data: bytes, rising: bool = False) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(_spread(data[1:]), np.uint8).reshape(width, -1).T
    values = np.ascontiguousarray(planes).view(f"<u{width}").ravel().astype(np.uint64)
    return (np.cumsum(values, dtype=np.uint64) if rising else values).astype(np.int64)


def _added(place: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``n`` by place; floats hold whole numbers up to 2 ** 53."""
    return np.bincount(place, n, minlength=size).astype(np.int64)


def _joined(rows: pa.Table, order: str, column: str, rising: bool = False) -> np.ndarray:
    """What the parts sent a block, in the order of the parts."""
    kept = rows.filter(pa.compute.is_valid(rows.column(column))).sort_by(order)
    return np.concatenate([np.zeros(0, np.int64), *(unpacked(v, rising) for v in kept.column(column).to_pylist())])


def _hashes(words: list[bytes]) -> np.ndarray:
    """What orders words; its upper half tells a word's part."""
    upper = np.fromiter(map(crc32, words), np.uint64, len(words))
    return upper << np.uint64(32) | np.fromiter(map(adler32, words), np.uint64, len(words))


def _numbered(df: DataFrame, id_type: T.DataType, block_rows: int) -> DataFrame:
    """A row per block: ids, train flags, lengths and word numbers of its texts; its words and their training counts.

    Words are numbered by the order of their hashes, so those of one part follow each other.
    """

    def row(block, ids, train, lengths, read, number):
        words, ids = list(number), pa.concat_arrays(ids)
        order = np.argsort(_hashes(words), kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        read = place[np.frombuffer(read, np.int32)]
        used = np.array(train, np.int64)
        n = _added(read, np.repeat(used, lengths), len(words))
        cells = [packed(used), packed(np.array(lengths)), packed(read), _squeezed(GAP.join([words[i] for i in order])), packed(n)]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
             *(pa.array([c], pa.binary()) for c in cells), pa.array([len(words)], pa.int64()), pa.array([len(read)], pa.int64())],
            names=schema.names,
        )

    def run(batches):
        def fresh():
            number = defaultdict()
            number.default_factory = number.__len__
            return [], [], [], array("i"), number

        block, held = TaskContext.get().partitionId() << 32, fresh()
        for batch in batches:
            id_column, start = batch.column(2), 0
            for i, (used, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                ids, train, lengths, read, number = held
                words = tokens(text)
                read.extend(map(number.__getitem__, words))
                train.append(int(used))
                lengths.append(len(words))
                if len(train) >= block_rows or len(read) >= BLOCK_TOKENS:
                    ids.append(id_column.slice(start, i + 1 - start))
                    yield row(block, *held)
                    block, held, start = block + 1, fresh(), i + 1
            if start < len(batch):
                held[0].append(id_column.slice(start))
        if held[1]:
            yield row(block, *held)

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
        *[T.StructField(n, T.BinaryType()) for n in ("train", "lengths", "read", "words", "n")],
        T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])
    return df.mapInArrow(run, schema)


def _word_totals(blocks: DataFrame, parts: int, min_count: int) -> DataFrame:
    """(part, block, numbers, totals) for the words of each block in each part; tokens, words and the largest number once per part.

    A word seen less than ``min_count`` times has the number 0.
    """

    def asked(batches):
        for batch in batches:
            for block, words, n in zip(*(c.to_pylist() for c in batch.columns)):
                words, n = _spread(words).split(GAP), unpacked(n)
                part = _hashes(words) >> np.uint64(32)
                cuts = np.searchsorted(part * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1)).tolist()
                rows = [(p, block, _squeezed(GAP.join(words[a:b])), packed(n[a:b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                yield pa.RecordBatch.from_pylist([dict(zip(wanted.names, r)) for r in rows], schema=wanted)

    def answered(rows: pa.Table) -> pa.Table:
        p, number, places, counts = rows.column("part")[0].as_py(), defaultdict(), [], []
        number.default_factory = number.__len__
        for words, n in zip(rows.column("words").to_pylist(), rows.column("n").to_pylist()):
            places.append(np.fromiter(map(number.__getitem__, _spread(words).split(GAP)), np.int64))
            counts.append(unpacked(n))
        total = _added(np.concatenate(places), np.concatenate(counts), len(number))
        order = np.argsort(_hashes(list(number)), kind="stable")
        order = order[total[order] >= min_count]
        numbers = np.zeros(len(number), np.int64)
        numbers[order] = 1 + p + parts * np.arange(len(order))
        once, none = [int(total.sum()), int((total > 0).sum()), int(numbers.max())], [0, 0, 0]
        told = [once, *[none] * (len(places) - 1)]
        return pa.table({
            "part": rows.column("part"), "block": rows.column("block"),
            # Words without a number would break the rising order: they come as a list of their own.
            "numbers": pa.array([packed(numbers[i][numbers[i] > 0], rising=True) for i in places], pa.binary()),
            "totals": pa.array([packed(total[i]) for i in places], pa.binary()),
            **{name: pa.array([t[i] for t in told], pa.int64()) for i, name in enumerate(("tokens", "distinct", "largest"))},
        })

    wanted = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("n", pa.binary())])
    asks = blocks.select("block", "words", "n").mapInArrow(asked, "part int, block long, words binary, n binary")
    return asks.groupBy("part").applyInArrow(
        answered, "part int, block long, numbers binary, totals binary, tokens long, distinct long, largest long"
    )


def _known(words: pa.Table, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and totals of a block's words in their order."""
    totals = _joined(words, "part", "totals")
    numbers = np.zeros(len(totals), np.int64)
    numbers[totals >= min_count] = _joined(words, "part", "numbers", rising=True)
    return numbers, totals


class _Pairs:
    """Pairs as whole numbers: their part times ``width`` plus the rest, so sorted pairs of one part follow each other."""

    def __init__(self, numbers: int, parts: int):
        self.numbers, self.parts = numbers, parts
        self.width = numbers * numbers // parts + 1

    def keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * self.numbers + b
        return x % self.parts * self.width + x // self.parts

    def first(self, part: int, rest: np.ndarray) -> np.ndarray:
        """The number of the first word."""
        return (rest * self.parts + part) // self.numbers

    def of(self, read: np.ndarray, lengths: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of second words, distinct pairs in order, which of them is at each place); ``states`` are 0 for other words."""
        s = states[read]
        both = (s[:-1] > 0) & (s[1:] > 0)
        both[np.cumsum(lengths)[:-1] - 1] = False  # from the end of a text to the next one
        at = np.flatnonzero(both) + 1
        pairs, which = np.unique(self.keys(s[at - 1], s[at]), return_inverse=True)
        return at, pairs, which


def _prime_from(n: int) -> int:
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _pair_totals(blocks: DataFrame, words: DataFrame, pairs: _Pairs, parts: int, min_count: int, least: float) -> DataFrame:
    """(block, pair_part, arcs): totals of each block's pairs, 0 for less than ``min_count``; and what arcs hold per first word.

    The latter are rows (part, numbers, held, arcs): part and numbers of words, the sum of the totals of their arcs and their number.
    """

    def asked(docs: pa.Table, known: pa.Table) -> pa.Table:
        train, lengths, read = (unpacked(docs.column(c)[0].as_py()) for c in ("train", "lengths", "read"))
        numbers, totals = _known(known, min_count)
        at, keys, which = pairs.of(read, lengths, np.where(totals >= least, numbers, 0))
        n = _added(which, np.repeat(train, lengths)[at], len(keys))
        cuts = np.searchsorted(keys, np.arange(pairs.parts + 1) * pairs.width).tolist()
        held = [(q, a, b) for q, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        return pa.table({
            "pair_part": pa.array([q for q, _, _ in held], pa.int32()),
            "block": pa.array([docs.column("block")[0].as_py()] * len(held), pa.int64()),
            "rest": pa.array([packed(keys[a:b] - q * pairs.width, rising=True) for q, a, b in held], pa.binary()),
            "n": pa.array([packed(n[a:b]) for _, a, b in held], pa.binary()),
        })

    def answered(rows: pa.Table) -> pa.Table:
        q = rows.column("pair_part")[0].as_py()
        rests = [unpacked(v, rising=True) for v in rows.column("rest").to_pylist()]
        keys, which = np.unique(np.concatenate(rests), return_inverse=True)
        total = _added(which, np.concatenate([unpacked(v) for v in rows.column("n").to_pylist()]), len(keys))
        total[total < min_count] = 0
        answers = np.split(total[which], np.cumsum([len(r) for r in rests])[:-1])
        # Arcs per first word; words of one part, which their numbers tell, go together.
        states, place = np.unique(pairs.first(q, keys[total > 0]), return_inverse=True)
        held, arcs = _added(place, total[total > 0], len(states)), np.bincount(place, minlength=len(states))
        part = (states - 1) % parts
        order = np.lexsort((states, part))
        cuts = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
        groups = [(p, order[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        return pa.table({
            "block": pa.array([*rows.column("block").to_pylist(), *[None] * len(groups)], pa.int64()),
            "pair_part": pa.array([*[q] * len(answers), *[None] * len(groups)], pa.int32()),
            "arcs": pa.array([*map(packed, answers), *(packed(arcs[g]) for _, g in groups)], pa.binary()),
            "part": pa.array([*[None] * len(answers), *(p for p, _ in groups)], pa.int32()),
            "numbers": pa.array([*[None] * len(answers), *(packed(states[g], rising=True) for _, g in groups)], pa.binary()),
            "held": pa.array([*[None] * len(answers), *(packed(held[g]) for _, g in groups)], pa.binary()),
        })

    docs = blocks.select("block", "train", "lengths", "read").groupBy("block")
    asks = docs.cogroup(words.select("block", "part", "numbers", "totals").groupBy("block")).applyInArrow(
        asked, "pair_part int, block long, rest binary, n binary"
    )
    return asks.groupBy("pair_part").applyInArrow(
        answered, "block long, pair_part int, arcs binary, part int, numbers binary, held binary"
    )


def _with_held(words: DataFrame, sums: DataFrame, parts: int) -> DataFrame:
    """Add to the words of each block what their arcs hold, in the order of those that have a number."""

    def run(known: pa.Table, sums: pa.Table) -> pa.Table:
        if not len(known):
            return empty
        rows = [(unpacked(known_numbers, rising=True) - 1) // parts for known_numbers in known.column("numbers").to_pylist()]
        size = 1 + max((int(r.max(initial=-1)) for r in rows), default=-1)
        held, arcs = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for numbers, h, a in zip(*(sums.column(c).to_pylist() for c in ("numbers", "held", "arcs"))):
            at = (unpacked(numbers, rising=True) - 1) // parts  # each once
            held[at] += unpacked(h)
            arcs[at] += unpacked(a)
        return pa.table({
            "block": known.column("block"), "part": known.column("part"), "numbers": known.column("numbers"), "totals": known.column("totals"),
            "held": pa.array([packed(held[r]) for r in rows], pa.binary()), "followers": pa.array([packed(arcs[r]) for r in rows], pa.binary()),
        })

    schema = "block long, part int, numbers binary, totals binary, held binary, followers binary"
    names = [c.split()[0] for c in schema.split(", ")]
    empty = pa.table({c: pa.array([], t) for c, t in zip(names, [pa.int64(), pa.int32(), *[pa.binary()] * 4])})
    known = words.select("block", "part", "numbers", "totals").groupBy("part")
    return known.cogroup(sums.select("part", "numbers", "held", "arcs").groupBy("part")).applyInArrow(run, schema)


class Automaton:
    """The part of the model that one block can reach; its words are known by their numbers in the block."""

    def __init__(self, totals: np.ndarray, mass: np.ndarray, size: int, discount: float):
        self.totals, self.discount = totals, discount
        self.root = np.log10((totals + 1) / size)
        #: The weight of the failure arc; none is lost where a word has no arcs.
        self.failure = np.log10(np.maximum(1 - mass / np.maximum(totals, 1), 1e-12))

    def score(self, read: np.ndarray, lengths: np.ndarray, at: np.ndarray, arcs: np.ndarray) -> Iterator[np.ndarray]:
        """(known tokens, base, score) of all texts in one traversal; ``arcs``: totals of the pairs that end at the places ``at``.

        The state in which a token is read is the word before it, at the begin of a text the root.
        """
        text, root = np.repeat(np.arange(len(lengths)), lengths), self.root[read]
        taken = root.copy()
        taken[1:] += self.failure[read[:-1]]
        begins = np.cumsum(lengths) - lengths
        taken[begins] = root[begins]
        at, arcs = at[arcs > 0], arcs[arcs > 0]
        state = read[at - 1]
        taken[at] = np.log10((arcs - self.discount) / self.totals[state] + 10 ** (self.failure[state] + root[at]))
        for weights in (self.totals[read] > 0, root, taken):
            yield np.bincount(text, weights, minlength=len(lengths))


def scored(
    df: DataFrame, train: object, id_col: str = "doc_id", text_col: str = "text", state_share: float | None = None,
    min_count: int = MIN_COUNT, discount: float = DISCOUNT, block_rows: int = BLOCK_ROWS, numbered_share: float = NUMBERED_SHARE,
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) per row. ``train``: a condition. Runs jobs.

    ``state_share``: only words of this share of all tokens are states; every word, if it is None.
    ``numbered_share`` is without effect: it chose words that had numbers, and all words seen ``min_count`` times have them now.
    """
    small_batches(df.sparkSession)
    id_type = df.schema[id_col].dataType
    # Blocks are cut where the rows are; they are stored, so later stages agree on them.
    texts = df.select(F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    blocks = stored(_numbered(texts, id_type, block_rows), "blocks")
    size = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n_tokens")]).first()
    parts = 1 + size["n_words"] // PART_WORDS
    words = stored(_word_totals(blocks, parts, min_count), "words")
    sums = words.agg(
        *[F.coalesce(f(c), F.lit(0)).alias(c) for f, c in ((F.sum, "tokens"), (F.sum, "distinct"), (F.max, "largest"))]
    ).first()
    all_tokens, smoothed = sums["tokens"], sums["tokens"] + sums["distinct"] + 1
    if sums["largest"] >= _MOST:
        raise ValueError(f"more than {_MOST} words occur {min_count} times or more")
    least = max(min_count, 0 if state_share is None else all_tokens * state_share)
    # A prime number of parts that does not divide the numbers deals pairs evenly, whatever word is frequent.
    pair_parts = _prime_from(2 + size["n_tokens"] // PART_PAIRS)
    pairs = _Pairs(sums["largest"] + 1 + ((sums["largest"] + 1) % pair_parts == 0), pair_parts)
    totals = stored(_pair_totals(blocks, words, pairs, parts, min_count, least), "pairs")
    held = _with_held(words, totals.where("part is not null"), parts)
    answers = held.unionByName(totals.where("part is null").select("block", "pair_part", "arcs"), allowMissingColumns=True)

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        lengths, read = (unpacked(docs.column(c)[0].as_py()) for c in ("lengths", "read"))
        known = answers.filter(pa.compute.is_valid(answers.column("part")))
        numbers, totals = _known(known, min_count)
        mass = np.zeros(len(totals))
        mass[totals >= min_count] = _joined(known, "part", "held") - discount * _joined(known, "part", "followers")
        at, keys, which = pairs.of(read, lengths, np.where(totals >= least, numbers, 0))
        arcs = _joined(answers, "pair_part", "arcs")
        if len(arcs) != len(keys):
            raise ValueError("answers do not fit a block's pairs")
        ids = docs.column("ids").combine_chunks().flatten()
        n_known, base, score = Automaton(totals, mass, smoothed, discount).score(read, lengths, at, arcs[which])
        return pa.table({
            id_col: ids, "n_tokens": pa.array(lengths, pa.int64()), "n_known": pa.array(n_known.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(lengths), all_tokens), pa.int64()), "base_score": pa.array(base), "score": pa.array(score),
        })

    longs = [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
    doubles = [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]
    schema = T.StructType([T.StructField(id_col, id_type), *longs, *doubles])
    docs = blocks.select("block", "ids", "lengths", "read")
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
