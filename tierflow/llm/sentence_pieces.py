"""SentencePiece encoding with a score-ordered agenda, and decoding.

A merge-type vocabulary is applied by an agenda: all adjacent symbol pairs whose joined text is a piece wait
in the order of their scores, then of their places. The best pair is merged, its new neighbours join the agenda, and so on
until no pair is left. Symbols left outside the vocabulary fall back to bytes. The agendas of all new short segments of a batch are
worked off together: a row of ranks for each segment, and in every round the best entry of each row is merged. Long segments have a
heap of their own, where pairs that no longer exist are skipped when they come up.

No piece of the vocabulary has a space mark after another character, so a text falls into segments (a run of
space marks and what follows) that never merge across their borders. Each task keeps the ids of segments it
has met, in two generations of bounded size, so a frequent word is merged once, not at every place; between tasks a
worker keeps a few of them only. All segments that are new in an Arrow batch are also encoded by the sentencepiece library and must agree.

Edge cases: NULL and empty texts have no ids and decode to the empty text. Literal space marks count as
spaces, as in the library. Very long segments cost O(n log n). Other columns pass through; a clash of an
added name with an input column is an error that names it.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierflow.llm.common import give_back, small_batches

MARK = "▁"
#: Segments a task remembers per generation, about 0.2 kB each, and what a worker keeps of them for its next task.
REMEMBERED, KEPT = 300_000, 50_000
#: Up to this many symbols the agenda is a row of ranks; beyond it, a heap.
SHORT = 24
_NEVER = np.iinfo(np.int32).max
_CODES = 0x110000


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def _numbers(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<i4").tolist()


class PieceModel:
    """Vocabulary of one model file, with the agenda."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.unknown = sp.unk_id()
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.ids, self.cost, self.byte_ids = {}, {}, {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not sp.is_control(i) and not sp.is_unknown(i):
                self.ids[piece], self.cost[piece] = i, -sp.get_score(i)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a space mark after another character")
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        self.segment = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if "\n" in joined else f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
        self.after_break = len(sp.encode("\n"))
        self.young, self.old, self.remembered = {}, {}, remembered
        self._pair_table(size)

    def _pair_table(self, size: int) -> None:
        """Numbers of symbols (a piece is its id, another character comes after all ids), and of each pair of symbols that makes a
        piece its rank and the piece."""
        self.first_other = size
        self.number = np.arange(size, size + _CODES, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.number[ord(piece)] = i
        ranks = {cost: r for r, cost in enumerate(sorted(set(self.cost.values())))}

        def numbered(part: str) -> int | None:
            return int(self.number[ord(part)]) if len(part) == 1 else self.ids.get(part)

        rows = []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = numbered(piece[:cut]), numbered(piece[cut:])
                if left is not None and right is not None:
                    rows.append(((left << 32) | right, ranks[self.cost[piece]], i))
        table = np.array(sorted(rows) or np.zeros((0, 3)), np.int64).reshape(-1, 3)
        self.pairs = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.ranks, self.made = np.append(table[:, 1], _NEVER).astype(np.int32), np.append(table[:, 2], -1).astype(np.int32)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and the piece it makes."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[at] == keys, self.ranks[at], _NEVER), self.made[at]

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda."""
        return _numbers(self.merge_all([segment])[0])

    def merge_all(self, segments: list[str]) -> list[bytes]:
        """Packed ids of segments by their agendas: short ones of equal length together."""
        out: list = [None] * len(segments)
        by_length: dict[int, list[int]] = {}
        for at, s in enumerate(segments):
            if len(s) <= SHORT:
                by_length.setdefault(len(s), []).append(at)
            else:
                out[at] = _packed(self._ids(self._merge_long(s)))
        for length, places in by_length.items():
            codes = np.frombuffer("".join([segments[i] for i in places]).encode("utf-32-le", "surrogatepass"), np.uint32)
            for at, ids in zip(places, self._merge_rows(self.number[codes].reshape(-1, length))):
                out[at] = ids
        return out

    def _merge_rows(self, symbols: np.ndarray) -> list[bytes]:
        """Rows of equal length: a round merges the best pair of each row, the leftmost of equal ones; rows without a pair are done."""
        out, rows = [None] * len(symbols), np.arange(len(symbols))
        rank, made = self._look_up(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            width = symbols.shape[1]
            best = rank.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)
            on = rank[np.arange(len(rows)), best] < _NEVER if width > 1 else np.zeros(len(rows), bool)
            if not on.all():
                for at, ids in zip(rows[~on].tolist(), self._plain(symbols[~on])):
                    out[at] = ids
                rows, symbols, rank, made, best = rows[on], symbols[on], rank[on], made[on], best[on]
                if not len(rows):
                    break
            line, piece = np.arange(len(rows)), made[np.arange(len(rows)), best]
            places = np.arange(width - 1)
            source = places + (places > best[:, None])
            symbols = np.take_along_axis(symbols, source, 1)
            symbols[line, best] = piece
            rank, made = (np.take_along_axis(x, source[:, : width - 2], 1) for x in (rank, made))
            left = np.flatnonzero(best > 0)
            if len(left):
                at = best[left] - 1
                rank[left, at], made[left, at] = self._look_up(symbols[left, at], piece[left])
            right = np.flatnonzero(best < width - 2)
            if len(right):
                at = best[right]
                rank[right, at], made[right, at] = self._look_up(piece[right], symbols[right, at + 1])
        return out

    def _plain(self, symbols: np.ndarray) -> list[bytes]:
        """Packed ids of finished rows; characters outside the vocabulary as their bytes."""
        flat, width = np.ascontiguousarray(symbols, "<i4").tobytes(), 4 * symbols.shape[1]
        out = [flat[i : i + width] for i in range(0, len(flat), width)]
        for i in np.flatnonzero((symbols >= self.first_other).any(axis=1)).tolist():
            row = []
            for n in symbols[i].tolist():
                if n < self.first_other:
                    row.append(n)
                elif self.byte_ids:
                    row.extend(self.byte_ids[b] for b in chr(n - self.first_other).encode())
                else:
                    row.append(self.unknown)
            out[i] = _packed(row)
        return out

    def _merge_long(self, segment: str) -> list[str]:
        symbols, n, cost = list(segment), len(segment), self.cost
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            piece = symbols[i] + symbols[i + 1]
            if piece in cost:
                agenda.append((cost[piece], i, piece))
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] is None or j >= n or len(symbols[i]) + len(symbols[j]) != len(piece) or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair = piece + symbols[k]
                if pair in cost:
                    heapq.heappush(agenda, (cost[pair], i, pair))
            h = before[i]
            if h >= 0:
                pair = symbols[h] + piece
                if pair in cost:
                    heapq.heappush(agenda, (cost[pair], h, pair))
        return [s for s in symbols if s is not None]

    def _ids(self, symbols: list[str]) -> list[int]:
        out, ids = [], self.ids
        for s in symbols:
            found = ids.get(s)
            if found is not None:
                out.append(found)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in s.encode())
            else:
                out.append(self.unknown)
        return out

    def agree(self, met: dict[str, bytes]) -> None:
        """The library must give the same ids for the segments that were merged."""
        segments = [s for s in met if s != MARK]  # a lone space mark is never a text of its own to the library
        given = [s[1:] if s[0] == MARK else "\n" + s for s in segments]
        skip = [0 if s[0] == MARK else self.after_break for s in segments]
        theirs = [ids[k:] if k else ids for k, ids in zip(skip, self.library.encode(given, num_threads=1))]
        ours = [met[s] for s in segments]
        if list(map(len, ours)) == [4 * len(ids) for ids in theirs] and _packed(list(chain.from_iterable(theirs))) == b"".join(ours):
            return
        for s, mine, ids in zip(segments, ours, theirs):
            if _numbers(mine) != ids:
                raise ValueError(f"the library encodes {s[:80]!r} as {ids[:20]}, the agenda as {_numbers(mine)[:20]}")

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        split = [self.segment.findall(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        young, old = self.young, self.old
        unseen = []
        for s in set().union(*split) - young.keys():
            ids = old.get(s)
            if ids is None:
                unseen.append(s)
            else:
                young[s] = ids
        met = dict(zip(unseen, self.merge_all(unseen)))
        if met:
            self.agree(met)
            young.update(met)
        out = [b"".join(map(young.__getitem__, parts)) for parts in split]
        for s in [s for s in met if len(s) > 64]:
            del young[s]
        if len(young) > self.remembered:
            self.young, self.old = {}, young
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return list(map(_numbers, self.packed(texts)))

    def rest(self) -> None:
        """Between tasks: keep the segments met first, which are the frequent ones, and give freed memory back."""
        self.young, self.old = dict(islice(self.young.items(), KEPT)), {}
        give_back()

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model of a file, kept for the other tasks of this worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def with_pieces(
    df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "piece_ids", decoded_col: str | None = "decoded",
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the ids of each text, and what they decode to. ``keep``: the input columns to return (all)."""
    small_batches(df.sparkSession)
    kept = df.columns if keep is None else keep
    added = [ids_col, *([decoded_col] if decoded_col else [])]
    if clash := set(added) & set(kept):
        raise ValueError(f"columns {sorted(clash)} exist already")
    fields = [df.schema[c] for c in kept] + [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            packed = model.packed(texts)
            ends = np.cumsum([0, *map(len, packed)], dtype=np.int64) // 4
            flat = np.frombuffer(b"".join(packed), "<i4")
            out = [*batch.columns[: len(kept)], pa.ListArray.from_arrays(ends.astype(np.int32), flat)]
            if decoded_col:
                out.append(pa.array(model.decode(list(map(_numbers, packed))), pa.string()))
            yield pa.RecordBatch.from_arrays(out, [*kept, *added])
        model.rest()

    return df.select(*kept, df[text_col].alias("__text")).mapInArrow(run, T.StructType(fields))
