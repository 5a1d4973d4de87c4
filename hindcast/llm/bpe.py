"""Byte-level BPE encoding and decoding by the ranks of a vocabulary file, with numpy matrices.

Distinct pre-tokens are put into matrices by length, padded; in each round every row merges its leftmost pair of
least rank, the row closes up, and only the two pairs beside the merged one are looked up again. Pairs are found in an
open-addressing hash table of (left id, right id). Rows without a pair leave the matrix. A pre-token of more than
``LONGEST`` bytes (a long run of one class) is merged with a heap instead, in n log n steps.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hindcast.llm.kernels import runs, slices, text_buffer
from hindcast.llm.wordpieces import WordTable, binary_rows

LONGEST = 512
_NONE = np.int32(2**31 - 1)
_ROWS = 1 << 15


class Ranks:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = [(self.rank[w[:k]], self.rank[w[k:]], r) for w, r in self.rank.items() for k in range(1, len(w)) if w[:k] in self.rank and w[k:] in self.rank]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        key = (left << 32) | right
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            first = first[free[first]]
            self.keys[slot[first]], self.values[slot[first]] = key[first], rank[first]
            rest = np.ones(len(key), bool)
            rest[first] = False
            key, rank, slot = key[rest], rank[rest], (slot[rest] + 1) & (len(self.keys) - 1)
        size = max(self.rank.values()) + 1
        lengths = np.zeros(size, np.int64)
        words = [b""] * size
        for w, r in self.rank.items():
            lengths[r], words[r] = len(w), w
        self.lengths, self.starts, self.bytes = lengths, np.cumsum(lengths) - lengths, np.frombuffer(b"".join(words), np.uint8)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or ``_NONE``; ids below 0 make no pair."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.values[slot], _NONE)
        todo = np.flatnonzero((there != key) & (there != -1) & (key >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[todo]]
            hit = there == key[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (there != -1)]
        return out

    def merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Merge all rows of a matrix of ids, padded with -1 on the right."""
        done = np.full_like(ids, -1)
        where = np.arange(len(ids))
        width = ids.shape[1]
        rank = np.full(ids.shape, _NONE, np.int32)
        rank[:, :-1] = self.pair(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        column = np.arange(width)
        while len(ids):
            at = rank.argmin(axis=1)
            row = np.arange(len(ids))
            best = rank[row, at]
            ended = best == _NONE
            if ended.any():
                done[where[ended], : ids.shape[1]] = ids[ended]
                go = ~ended
                ids, rank, where, at, best = ids[go], rank[go], where[go], at[go], best[go]
                if not len(ids):
                    break
                row = np.arange(len(ids))
            width = int((ids >= 0).sum(axis=1).max())
            ids, rank, column = ids[:, :width], rank[:, :width], column[:width]
            ids[row, at] = best
            source = np.minimum(column + (column > at[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            ids[:, -1] = -1
            rank[:, -1] = _NONE
            nxt = np.minimum(at + 1, width - 1)
            rank[row, at] = np.where(at + 1 < width, self.pair(ids[row, at], ids[row, nxt]), _NONE)
            has = at > 0
            rank[row[has], at[has] - 1] = self.pair(ids[row[has], at[has] - 1], ids[row[has], at[has]])
        return done

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges for one long pre-token, with a heap of pairs and linked neighbours."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        found: dict[tuple[int, int], int] = {}

        def rank(i: int) -> int:
            pair = (ids[i], ids[after[i]])
            if pair not in found:
                found[pair] = int(self.pair(np.array([pair[0]]), np.array([pair[1]]))[0])
            return found[pair]

        heap = [(rank(i), i) for i in range(n - 1)]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if r == _NONE:
                break
            if not alive[i] or after[i] < 0 or rank(i) != r:
                continue
            gone = after[i]
            alive[gone] = False
            ids[i], after[i] = r, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
                heapq.heappush(heap, (rank(i), i))
            if before[i] >= 0:
                heapq.heappush(heap, (rank(before[i]), before[i]))
        return [x for x, a in zip(ids, alive, strict=True) if a]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some pre-tokens in a row, and the number of ids of each."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.ones(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of words: numbers, ids, counts
        whole = np.fromiter((self.rank.get(w, -1) for w in words), np.int64, len(words))
        one = np.flatnonzero(whole >= 0)
        parts.append((one, whole[one].astype(np.uint32), counts[one]))
        rest = np.flatnonzero((whole < 0) & (length <= LONGEST))
        rest = rest[np.argsort(length[rest], kind="stable")]
        low = 0
        while low < len(rest):
            longest = int(length[rest[low]]) * 5 // 4 + 1  # rows of a matrix are padded by a fourth at most
            high = min(low + max(1, _ROWS * 16 // longest), int(np.searchsorted(length[rest], longest, side="right")))
            some = rest[low:high]
            low = high
            n = length[some]
            matrix = np.full((len(some), int(n.max())), -1, np.int32)
            data = np.frombuffer(b"".join([words[i] for i in some]), np.uint8)
            matrix[np.repeat(np.arange(len(some)), n), runs(n)] = self.single[data]
            merged = self.merge_rows(matrix)
            real = merged >= 0
            parts.append((some, merged[real].astype(np.uint32), real.sum(axis=1)))
        for i in np.flatnonzero((whole < 0) & (length > LONGEST)):
            ids = np.array(self.merge_long(words[i]), np.uint32)
            parts.append((np.array([i]), ids, np.array([len(ids)])))
        for numbers, _, n in parts:
            counts[numbers] = n
        starts = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint32)
        for numbers, ids, n in parts:
            out[np.repeat(starts[numbers], n) + runs(n)] = ids
        return out, counts

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and the n + 1 offsets of the ids in them."""
        n = self.lengths[ids]
        return self.bytes[np.repeat(self.starts[ids], n) + runs(n)], np.concatenate([[0], np.cumsum(n)])


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def _table(path: str) -> WordTable:
    return WordTable(ranks(path).encode_words)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replace or add the column ``ids``: the ids of each text as little-endian unsigned 32-bit integers (binary).

    ``path`` names a file of base64 tokens and ranks that every executor has. Null and empty texts give no ids; all
    other columns are kept; rows are neither moved nor merged.
    """
    kept = [c for c in df.columns if c != ids]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path)
        for batch in batches:
            for part in slices(batch, text):
                flat, at = table.encode_column(part.column(text))
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, binary_rows(flat.astype("<u4").view(np.uint8), at * 4)], [*kept, ids])

    return df.mapInArrow(task, T.StructType([*[df.schema[c] for c in kept], T.StructField(ids, T.BinaryType())]))


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``encode``, then ``decode`` of the ids, in one pass over the rows."""
    kept = [c for c in df.columns if c not in (ids, to)]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, vocabulary = _table(path), ranks(path)
        for batch in batches:
            for part in slices(batch, text):
                flat, at = table.encode_column(part.column(text))
                data, edge = vocabulary.decode(flat)
                new = [binary_rows(flat.astype("<u4").view(np.uint8), at * 4), binary_rows(data, edge[at])]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *new], [*kept, ids, to])

    return df.mapInArrow(task, T.StructType([*[df.schema[c] for c in kept], T.StructField(ids, T.BinaryType()), T.StructField(to, T.BinaryType())]))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Replace or add the column ``to``: the bytes that the ids stand for. Null ids give no bytes; an id outside the
    vocabulary is an error."""
    kept = [c for c in df.columns if c != to]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks(path)
        for batch in batches:
            for part in slices(batch, ids):
                buf, off = text_buffer(part.column(ids))
                data, at = vocabulary.decode(np.ascontiguousarray(buf).view("<u4"))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], binary_rows(data, at[off // 4])], [*kept, to])

    return df.mapInArrow(task, T.StructType([*[df.schema[c] for c in kept], T.StructField(to, T.BinaryType())]))
