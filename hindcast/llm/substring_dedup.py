"""Removal of repeated passages: difference-cover anchors.

{0, 1, 3, 9} is a difference cover modulo 13: for any two positions there is a shift below 13 that takes both to
residues of the cover. So of two equal windows of 20 words, some two equal runs of 8 words (20 - 13 + 1) lie at the
same place in both and start at cover positions of their texts: it is enough to hash 4 of 13 positions. Anchors that
occur once are dropped; windows are looked at only around the others, where each window's whole 20-word hash (96
bits) decides. The window that starts first keeps its words.

Hashes move packed, one row for each block of texts and bucket. A block sends each anchor once and each window's first
occurrence in it once, whatever their frequency, so a passage that a third of all texts share is one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.llm.kernels import freed, mix, runs, slices, text_buffer, window_hashes, word_hashes, words

WINDOW, PERIOD = 20, 13
COVER = np.array([0, 1, 3, 9])
ANCHOR = WINDOW - PERIOD + 1
#: Text that is handled at once, and anchors in a block, about.
GROUP_BYTES, BLOCK_ENTRIES = 6 << 20, 1 << 19
_U = np.uint64
_SENT = np.dtype([("low", "<u4"), ("high", "u1"), ("ref", "<u2"), ("at", "<u4")])
_FIRST = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("ref", "<u4"), ("at", "<u4")])
_RUN = np.dtype([("key", "<i8"), ("at", "<u4"), ("n", "<u4")])
_NOBODY = 0xFFFF  # so a block has the anchors of fewer documents
_LAST = np.iinfo(np.int64).max


def _as_runs(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(key, position) pairs as runs of consecutive positions."""
    order = np.lexsort((at, key))
    key, at = key[order], at[order].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)])) if len(key) else np.zeros(0, np.int64)
    out = np.empty(len(new), _RUN)
    out["key"], out["at"], out["n"] = key[new], at[new], np.diff(np.append(new, len(key)))
    return out


def _filled(bucket: np.ndarray) -> dict[int, np.ndarray]:
    """The entries of each bucket that has some: the work goes with the entries, whatever the number of buckets."""
    order = np.argsort(bucket, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]])) if len(order) else np.zeros(0, np.int64)
    return dict(zip(bucket[order][start].astype(np.int64).tolist(), np.split(order, start[1:]), strict=True)) if len(order) else {}


def _by_group(runs_: np.ndarray, groups: int) -> Iterator[tuple[int, bytes]]:
    for g, which in _filled(runs_["key"] % groups).items():
        yield g, runs_[which].tobytes()


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


_BLOCKS = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("entries", pa.binary()), ("known", pa.binary())])
_MARKS = pa.schema([("group", pa.int32()), ("marks", pa.binary())])
BLOCKS, MARKS = "bucket int, docs binary, entries binary, known binary", "group int, marks binary"


def _anchor_blocks(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of anchors: each once, with its place if it occurs once in the block; the places of others are known
    to repeat."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    texts = 0

    def flush() -> pa.RecordBatch:
        h, key, at = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(h, kind="stable")
        h, key, at = h[order], key[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(h)))
        again = np.repeat(times > 1, times)
        docs, ref = np.unique(key[first], return_inverse=True)
        entry = np.empty(len(first), _SENT)
        entry["low"], entry["high"], entry["at"] = h[first] & _U(0xFFFFFFFF), (h[first] >> _U(32)) & _U(0xFF), at[first]
        entry["ref"] = np.where(times > 1, _NOBODY, ref)
        bucket = (h[first] >> _U(48)) % _U(buckets)
        held_by, known_by = _filled(bucket), _filled((h[again] >> _U(48)) % _U(buckets))
        key_again, at_again, none = key[again], at[again], np.zeros(0, np.int64)
        rows = []
        for b, which in held_by.items():  # an anchor that is known to repeat has an entry in its bucket too
            some, known = entry[which], known_by.get(b, none)
            mine, some["ref"] = _renumber(docs, some["ref"])
            rows.append((b, mine.astype("<i8").tobytes(), some.tobytes(), _as_runs(key_again[known], at_again[known]).tobytes()))
        return _table(rows, _BLOCKS)

    for batch in batches:
        for part in slices(batch, "text"):
            buf, off = text_buffer(part.column("text"))
            starts, ends, of_text = words(buf, off)
            n = np.diff(of_text)
            h = window_hashes(word_hashes(buf, starts, ends), ANCHOR)
            place = runs(n)
            text = np.repeat(np.arange(len(n)), n)
            can = (n[text] >= WINDOW) & (place + ANCHOR <= n[text]) & np.isin(place % PERIOD, COVER)
            at = np.flatnonzero(can)
            more = int((n >= WINDOW).sum())  # fewer than a slice's bytes over 40
            if held and texts + more >= _NOBODY:
                yield freed(flush())
                texts = 0
            texts += more
            held.append((h[at], part.column("_key").to_numpy()[text[at]], place[at]))
            if sum(len(x[0]) for x in held) > BLOCK_ENTRIES:
                yield freed(flush())
                texts = 0
    if held:
        yield freed(flush())


def _renumber(docs: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the documents that are referred to, and the new references."""
    real = ref != _NOBODY
    used, new = np.unique(ref[real], return_inverse=True)
    out = ref.copy()
    out[real] = new
    return docs[used], out


def _repeated(table: pa.Table, groups: int) -> pa.Table:
    """Places of one bucket's anchors that occur more than once."""
    h, key, at, ref, known = [], [], [], [], []
    for docs, entries, k in zip(table["docs"], table["entries"], table["known"], strict=True):
        e, d = np.frombuffer(entries.as_buffer(), _SENT), np.append(np.frombuffer(docs.as_buffer(), "<i8"), 0)
        h.append(e["low"].astype(_U) | (e["high"].astype(_U) << _U(32)))
        key.append(d[np.minimum(e["ref"], len(d) - 1)])
        at.append(e["at"])
        ref.append(e["ref"] != _NOBODY)
        known.append(np.frombuffer(k.as_buffer(), _RUN))
    h, key, at, ref = (np.concatenate(x) for x in (h, key, at, ref))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    twice &= ref
    found = np.concatenate([_as_runs(key[twice], at[twice]), *known])
    return pa.Table.from_batches([_table(list(_by_group(found, groups)), _MARKS)])


class _Group:
    """The texts of one group with the marks that were found for them."""

    def __init__(self, docs: pa.Table, marks: pa.Table):
        self.docs = docs.combine_chunks()
        self.key = self.docs["_key"].to_numpy().astype(np.int64)
        self.buf, off = text_buffer(self.docs["text"])
        self.starts, self.ends, self.of_text = words(self.buf, off)
        self.n = np.diff(self.of_text)
        found = np.frombuffer(b"".join(m.as_py() for m in marks["marks"]), _RUN)
        order = np.argsort(found["key"], kind="stable")
        found = found[order]
        low, high = np.searchsorted(found["key"], self.key), np.searchsorted(found["key"], self.key, side="right")
        self.row = np.repeat(np.arange(len(self.key)), high - low)
        take = np.repeat(low, high - low) + runs(high - low)
        self.at, self.length = found["at"][take].astype(np.int64), found["n"][take].astype(np.int64)

    def covered(self, before: int, after: int, last: int) -> np.ndarray:
        """Of each word: whether it lies from ``before`` words before a mark to ``after`` words behind it; the last
        words of each text may be left out."""
        edge = np.zeros(len(self.starts) + 1, np.int64)
        low = np.maximum(self.at - before, 0)
        high = np.minimum(self.at + self.length + after, self.n[self.row] - last)
        real = high > low
        np.add.at(edge, (self.of_text[self.row] + low)[real], 1)
        np.add.at(edge, (self.of_text[self.row] + high)[real], -1)
        return np.cumsum(edge)[:-1] > 0


def _window_blocks(docs: pa.Table, marks: pa.Table, buckets: int) -> pa.Table:
    """Windows around repeated anchors: the first of each word sequence in the group; later ones are known to repeat."""
    g = _Group(docs, marks)
    start = np.flatnonzero(g.covered(PERIOD - 1, 0, WINDOW - 1))
    if not len(start):
        return pa.Table.from_batches([_table([], _BLOCKS)])
    text = np.searchsorted(g.of_text, start, side="right") - 1
    h1, h2 = (window_hashes(word_hashes(g.buf, g.starts, g.ends, seed=s), WINDOW, s + 1)[start] for s in (0, 1))
    h2 = h2.astype(np.uint32)
    doc, key = g.docs["_doc"].to_numpy().astype(np.int64)[text], g.key[text]
    at = (start - g.of_text[text]).astype(np.uint32)
    del start, text
    order = np.lexsort((key, at, doc, h2, h1))
    h1, h2, doc, at, key = h1[order], h2[order], doc[order], at[order], key[order]
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    first = (doc == doc[head]) & (at == at[head])  # copies of a row are as early as each other
    again = np.zeros(len(key), bool)
    again[1:] = ~new[1:] & (key[1:] == key[:-1])
    sent = np.flatnonzero(first & ~again)
    entry = np.empty(len(sent), _FIRST)
    pairs, entry["ref"] = _pairs(key[sent], doc[sent])
    entry["h1"], entry["h2"], entry["at"] = h1[sent], h2[sent], at[sent]
    bucket = (mix(h1[sent]) >> _U(40)) % _U(buckets)
    filled = _filled(bucket)
    known, carrier = _as_runs(key[~first], at[~first]), int(g.key[0]) % buckets
    if len(known):
        filled.setdefault(carrier, np.zeros(0, np.int64))
    rows = []
    for b, which in filled.items():
        some = entry[which]
        used, some["ref"] = np.unique(some["ref"], return_inverse=True)
        rows.append((b, pairs[used].astype("<i8").tobytes(), some.tobytes(), known.tobytes() if b == carrier else b""))
    return pa.Table.from_batches([_table(rows, _BLOCKS)])


def _pairs(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (key, doc) pairs, and the number of each one's pair."""
    order = np.lexsort((doc, key))
    new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (doc[order][1:] != doc[order][:-1])])
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    return np.stack([key[order][new], doc[order][new]], axis=1), number


def _later(table: pa.Table, groups: int) -> pa.Table:
    """Places of one bucket's windows of which an earlier one exists."""
    parts, pairs, known, base = [], [], [], 0
    for docs, entries, k in zip(table["docs"], table["entries"], table["known"], strict=True):
        e, d = np.frombuffer(entries.as_buffer(), _FIRST).copy(), np.frombuffer(docs.as_buffer(), "<i8").reshape(-1, 2)
        e["ref"] += base
        base += len(d)
        parts.append(e)
        pairs.append(d)
        known.append(np.frombuffer(k.as_buffer(), _RUN))
    e, pairs = np.concatenate(parts), np.concatenate(pairs)
    key, doc, at = pairs[e["ref"], 0], pairs[e["ref"], 1], e["at"]
    order = np.lexsort((at, doc, e["h2"], e["h1"]))
    e, key, doc, at = e[order], key[order], doc[order], at[order]
    new = np.concatenate([[True], (e["h1"][1:] != e["h1"][:-1]) | (e["h2"][1:] != e["h2"][:-1])]) if len(e) else np.zeros(0, bool)
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[head]) | (at != at[head])
    found = np.concatenate([_as_runs(key[later], at[later]), *known])
    return pa.Table.from_batches([_table(list(_by_group(found, groups)), _MARKS)])


def _kept(docs: pa.Table, marks: pa.Table, names: list[str]) -> pa.Table:
    """The texts without the words of marked windows."""
    g = _Group(docs, marks)
    gone = g.covered(0, WINDOW - 1, 0)
    text = np.repeat(np.arange(len(g.n)), g.n)
    removed = np.bincount(text[gone], minlength=len(g.n))
    starts, ends, text = g.starts[~gone], g.ends[~gone], text[~gone]
    edge = np.zeros(g.buf.size + 1, np.int8)
    edge[starts] += 1
    np.subtract.at(edge, ends, 1)
    keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
    data = g.buf.copy()
    between = ends[:-1][text[1:] == text[:-1]]  # white space stands there, as another word of the text follows
    data[between] = 32
    keep[between] = True
    size = np.bincount(text, weights=(ends - starts).astype(float), minlength=len(g.n)).astype(np.int64)
    size += np.maximum(np.bincount(text, minlength=len(g.n)) - 1, 0)
    offsets = np.concatenate([[0], np.cumsum(size)])
    kept = pa.Array.from_buffers(pa.string(), len(g.n), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[keep])])
    out = [kept if c == "kept_text" else pa.array(g.n) if c == "n_words" else pa.array(removed.astype(np.int64)) if c == "n_removed" else g.docs[c] for c in names]
    return pa.table(dict(zip(names, out, strict=True)))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``n_words``, ``n_removed`` and ``kept_text`` to ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, unchanged; a null text has none. A word is removed if a window
    of 20 consecutive words that covers it has the same words as one that starts earlier: in a smaller doc_id, or in
    the same document at an earlier word. All windows are judged on the texts given. Kept words are joined by one space.
    Texts of fewer than 20 words stay whole. Documents without a doc_id come last, as one document; rows that share
    doc_id and text are as early as each other and are both kept. Columns of ``docs`` with the new names are replaced.

    A group of about ``GROUP_BYTES`` of text, or one longer text, is in memory at a time.
    """
    spark = docs.sparkSession
    named = docs.drop("n_words", "n_removed", "kept_text", "_doc", "_key", "group")
    fields = [*named.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(shuffled, size // GROUP_BYTES + 1)
    buckets = max(shuffled, size // (4 * GROUP_BYTES) + 1)
    rows = named.withColumns({"_doc": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST)), "_key": F.xxhash64(doc_id, text)})
    if text != "text":
        rows = rows.drop("text").withColumnRenamed(text, "text")
    grouped = rows.withColumn("group", F.pmod("_key", F.lit(groups)).cast("int"))

    anchors = rows.select("_key", "text").mapInArrow(lambda batches: _anchor_blocks(batches, buckets), BLOCKS)
    repeated = anchors.groupBy("bucket").applyInArrow(lambda t: freed(_repeated(t, groups)), MARKS)
    windows = grouped.groupBy("group").cogroup(repeated.groupBy("group")).applyInArrow(lambda d, m: freed(_window_blocks(d, m, buckets)), BLOCKS)
    later = windows.groupBy("bucket").applyInArrow(lambda t: freed(_later(t, groups)), MARKS)
    names = [text if f.name == "text" else f.name for f in fields]
    inner = ["text" if f.name == text else f.name for f in fields]
    schema = T.StructType([T.StructField(i, f.dataType) for i, f in zip(inner, fields, strict=True)])
    out = grouped.groupBy("group").cogroup(later.groupBy("group")).applyInArrow(lambda d, m: freed(_kept(d, m, inner)), schema)
    return out.toDF(*names)
