"""Byte-level BPE over Arrow columns: each distinct pre-token is encoded once, then gathered by number.

Byte-level BPE never merges across pre-tokens, so the ids of a text are the ids of its pre-tokens in order. A
``WordTable`` remembers the ids of the pre-tokens that one Python worker has seen and holds at most ``limit`` of them;
when it is full it keeps those that came again, which changes the time and never the ids.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from hindcast.llm.kernels import pretokens, runs, text_buffer

LIMIT = 250_000
Encoder = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class WordTable:
    def __init__(self, encode: Encoder, limit: int = LIMIT):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.counts = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int32)  # calls that asked for a word since the table was last full

    def shed(self, room: int) -> None:
        """Forget the words that one call alone asked for since the last time; all, if the others fill half of the table or
        leave no room for so many."""
        keep = np.flatnonzero(self.uses[: len(self.index)] > 1)
        if len(keep) > self.limit // 2 or len(keep) + room > self.limit:
            return self.clear()
        words, counts = list(self.index), self.counts[keep]
        ids = self.ids[np.repeat(self.starts[keep], counts) + runs(counts)]
        self.clear()
        self.index = {words[k]: i for i, k in enumerate(keep.tolist())}
        self.ids, self.used = _room(ids, 1 << 16), len(ids)
        self.starts, self.counts, self.uses = _room(np.cumsum(counts) - counts, 1 << 14), _room(counts, 1 << 14), np.zeros(max(len(keep), 1 << 14), np.int32)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each of some distinct words; new ones are encoded and kept."""
        if len(self.index) + len(words) > self.limit and self.index:
            self.shed(len(words))
        found = self.index
        new = [w for w in words if w not in found]
        if new:
            ids, counts = self.encode(new)
            at, n = len(found), len(new)
            self.ids = _room(self.ids, self.used + len(ids))
            self.starts, self.counts = _room(self.starts, at + n), _room(self.counts, at + n)
            self.uses = _room(self.uses, at + n)
            self.ids[self.used : self.used + len(ids)] = ids
            self.counts[at : at + n] = counts
            self.starts[at : at + n] = self.used + np.cumsum(counts) - counts
            self.used += len(ids)
            found.update(zip(new, range(at, at + n), strict=True))
        number = np.fromiter(map(found.__getitem__, words), np.int64, len(words))
        self.uses[number] += 1
        return number

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the n + 1 offsets of the texts in them."""
        buf, off = text_buffer(column)
        starts, of_text = pretokens(buf, off)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        edges = np.append(starts, buf.size).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf))]).dictionary_encode()
        number = self.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        counts = self.counts[number]
        ids = self.ids[np.repeat(self.starts[number], counts) + runs(counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])[of_text]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


def binary_rows(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Consecutive byte ranges of an array as an Arrow binary column."""
    at = edges.astype(np.int32) if edges[-1] < 2**31 else edges.astype(np.int64)
    kind = pa.binary() if at.dtype == np.int32 else pa.large_binary()
    return pa.Array.from_buffers(kind, len(edges) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])
