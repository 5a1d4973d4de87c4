"""Vectorised helpers used inside Arrow tasks: words, word hashes and pre-tokens of text columns.

All helpers take Arrow string arrays and treat null as the empty text. They work on slices of a megabyte
(``slices``) so that memory stays bounded whatever the batch size; a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
pa.set_memory_pool(pa.system_memory_pool())  # workers give memory of past batches back at once
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the n + 1 offsets of the texts in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of text each, or one row."""
    _, off = text_buffer(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()  # what the slices took goes back before the next batch


def freed(result: pa.Table | pa.RecordBatch) -> pa.Table | pa.RecordBatch:
    """``result``, with the memory that made it given back: a worker that waits for its next group holds little."""
    pa.default_memory_pool().release_unused()
    return result


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _MIX1
    x ^= x >> _U(27)
    x *= _MIX2
    x ^= x >> _U(31)
    return x


# ---------------------------------------------------------------- words

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` in ``buf``, and the n + 1 offsets of each text's words."""
    if not buf.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~_SEPARATOR[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = off[:-1][off[:-1] < buf.size]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = edge[edge > 0] - 1
    last[edge] = inside[edge]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


@lru_cache(maxsize=4)
def _byte_values(seed: int, lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _ODD + _U(seed))
    if lower:
        values = values.copy()
        values[65:91] = values[97:123]
    return values


HASH_BLOCK = 1 << 18


def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if n <= HASH_BLOCK + 1:
        return _block_powers(HASH_BLOCK + 1, seed)
    return _block_powers.__wrapped__(n, seed)  # for a word longer than a block


@lru_cache(maxsize=4)
def _block_powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(mix(np.array([seed + 77], _U))[0]) | 1
    up, down = (np.multiply.accumulate(np.array([1] + [x] * (n - 1), _U)) for x in (base, pow(base, -1, 1 << 64)))
    return up, down


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, *, lower: bool = False, seed: int = 0) -> np.ndarray:
    """64-bit hashes of ascending byte ranges; with ``lower``, A-Z count as a-z. Works through the bytes in blocks."""
    out, values, a = np.empty(len(starts), _U), _byte_values(seed, lower), 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + HASH_BLOCK, side="right")))
        low, n = int(starts[a]), int(ends[b - 1] - starts[a])
        up, down = _powers(n + 1, seed)
        total = np.zeros(n + 1, _U)
        np.multiply(values[buf[low : low + n]], up[:n], out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        at = starts[a:b] - low
        out[a:b] = (total[ends[a:b] - low] - total[at]) * down[at]
        a = b
    return mix(out ^ ((ends - starts).astype(_U) * _ODD)) if len(out) else out


def window_hashes(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive entries, over ``len(h) - width + 1`` starts."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    factors = mix(np.arange(1, width + 1, dtype=_U) + _U(1000 * (seed + 1))) | _U(1)
    out = h[:n] * factors[0]
    for k in range(1, width):
        out += h[k : k + n] * factors[k]
    return mix(out)


def runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run: ``runs([2, 3])`` is ``[0, 1, 0, 1, 2]``."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


# ---------------------------------------------------------------- pre-tokens of byte-level BPE

_LETTER, _NUMBER, _SPACE, _OTHER, _EDGE = 0, 1, 2, 3, 9


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    import regex

    table = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = (x if x < 0xD800 else x + 0x800 for x in m.span())
            table[a:b] = kind
    return table


def pretokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pre-tokens, and the n + 1 offsets of each text's pre-tokens.

    The split is that of the usual byte-level pattern: contractions, then runs of letters, numbers or other
    characters with at most one space before them, then white space, of which the last character goes alone
    when a text goes on. Every byte belongs to one pre-token, so each ends where the next one starts.
    """
    if not buf.size:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    if len(lead) == buf.size:
        points = buf
    else:
        points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    kind = _classes()[points]
    heads = np.searchsorted(lead, off[:-1][off[:-1] < buf.size])
    before = np.empty(n, np.uint8)
    before[1:] = kind[:-1]
    before[heads] = _EDGE
    after = np.empty(n, np.uint8)
    after[:-1] = kind[1:]
    after[-1] = _EDGE
    after[heads[heads > 0] - 1] = _EDGE
    blank = kind == _SPACE
    turn = kind != before
    tied = np.zeros(n, bool)  # what stands right after a plain space takes it in
    tied[1:] = points[:-1] == 32
    tied[heads] = False
    start = np.where(blank, turn | ((after != _SPACE) & (after != _EDGE)), turn & ~tied)
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        end_of = np.append(heads, n)[np.searchsorted(heads, quote, side="right")]
        room = end_of - quote
        padded = np.append(points, [0, 0]).astype(np.uint32)
        one, two = padded[quote + 1], padded[quote + 2]
        short = (room > 1) & np.isin(one, [ord(c) for c in "stmd"])
        long = (room > 2) & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
        start[quote[short | long] + 1] = False
        for which, width in ((short, 2), (long & ~short, 3)):
            stop = quote[which] + width
            stop = stop[stop < n]
            start[stop] = True
    at = np.flatnonzero(start)
    where = lead[at]
    return where, np.searchsorted(where, off)
