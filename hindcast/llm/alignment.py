"""Which tokens of two tokenizers cover the same bytes: byte-owner arrays.

Token numbers of A and of B are repeated over the bytes that they cover. Each consecutive distinct pair of owners is a
link (an A and a B occurrence that share bytes), and a place where both owners change is a cut between two groups.

A is a byte-level BPE file of the tokenizers library, B a sentencepiece model of BPE type without normalisation whose
pieces have spaces at their front only, so that neither merges over the start of a run of spaces: distinct words are
encoded once for each worker. Both encode a text with one space before it.

``align`` gives each text's groups, and the links packed: texts of a block of about a megabyte share a dictionary of
their distinct id pairs. ``with_link_counts`` joins the dictionaries, not the links, with the corpus-wide counts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.llm.kernels import freed, pretokens, runs, slices, text_buffer
from hindcast.llm.shared import Scratch
from hindcast.llm.wordpieces import Encoder, binary_rows

_SPACE = 0x20
#: Distinct words that a worker holds for each tokenizer; about 100 MB.
WORDS = 800_000
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups", pa.large_string()), ("block", pa.int64()), ("refs", pa.binary()), ("times", pa.binary()), ("pairs", pa.binary()), ("docs", pa.binary())])
ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, block bigint, refs binary, times binary, pairs binary, docs binary"


class Vocabulary:
    """A tokenizer's ids of words, and the bytes of its tokens. It remembers the ids of up to ``WORDS`` words; when it is
    full it starts anew, which changes the time and never the ids."""

    def __init__(self, encode_words: Encoder, tokens: list[bytes]):
        self.encode_words, self.size = encode_words, len(tokens)
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.edges = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each of some distinct words; new ones are encoded and kept."""
        if len(self.number) + len(words) > WORDS and self.number:
            self.clear()
        out = np.array(list(map(self.number.get, words, repeat(-1))), np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            ids, counts = self.encode_words(fresh)
            known = len(self.number)
            used = int(self.edges[known])
            self.ids, self.edges = _room(self.ids, used + len(ids)), _room(self.edges, known + len(new) + 1)
            self.ids[used : used + len(ids)] = ids
            self.edges[known + 1 : known + len(new) + 1] = used + np.cumsum(counts)
            out[new] = np.arange(known, known + len(new))
            self.number.update(zip(fresh, range(known, known + len(new)), strict=True))
        return out

    def encode(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the n + 1 offsets of the words in them; a word ends where the next starts."""
        edges = np.append(starts, buf.size).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf))]).dictionary_encode()
        distinct, off = _raw(coded.dictionary)
        off = off.tolist()
        number = self.numbers([distinct[x:y] for x, y in zip(off, off[1:])])[coded.indices.to_numpy()]  # noqa: B905
        first = self.edges[number]
        counts = self.edges[number + 1] - first
        return self.ids[np.repeat(first, counts) + runs(counts)].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        return self.bytes[np.repeat(self.starts[ids], n) + runs(n)]


def _raw(column: pa.Array) -> tuple[bytes, np.ndarray]:
    _, offsets, data = column.buffers()
    return data.to_pybytes() if data else b"", np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts


@lru_cache(maxsize=1)
def _byte_signs() -> dict[str, int]:
    """The printable sign by which byte-level files write each byte: itself where printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are plain text
    sign = _byte_signs()
    tokens = [bytes(map(sign.__getitem__, t)) if (t := tokenizer.id_to_token(i)) and all(c in sign for c in t) else b"" for i in range(tokenizer.get_vocab_size())]

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int]] = []
        for k in range(0, len(words), 2048):  # the library's results take much more room than their ids
            found += [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words[k : k + 2048]], add_special_tokens=False)]
        return _flat(found)

    return Vocabulary(encode, tokens)


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(re.search("[^▁]▁", t) for t in names):
        raise ValueError("pieces with a space behind another sign are not supported")
    tokens = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)]
    blank = model.piece_to_id("▁")

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word starts with a space, which the model adds itself, but not to an empty text."""
        return _flat([ids or [blank] for ids in model.encode([w[1:].decode() for w in words], num_threads=1)])

    return Vocabulary(encode, tokens)


def _space_words(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of runs of spaces; each text starts with a space."""
    space = buf == _SPACE
    space[1:] &= ~space[:-1].copy()
    space[off[:-1]] = True
    return np.flatnonzero(space)


@lru_cache(maxsize=2)
def _numerals(n: int) -> pa.Array:
    return pa.array([f"{i}{end}" for end in (",", "|", ";", "") for i in range(n)], pa.large_string())


def _groups(ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, last: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, ``a1,a2|b1;a3|b2``, and the offsets of the groups in it. ``in_a`` and ``in_b``: the tokens'
    groups, ``last``: which group ends a text."""
    n = len(last)
    end_a, end_b = np.cumsum(np.bincount(in_a, minlength=n)), np.cumsum(np.bincount(in_b, minlength=n))
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[np.arange(len(ids_a)) + np.concatenate([[0], end_b])[in_a]] = ids_a + size * np.where(np.arange(len(ids_a)) + 1 == end_a[in_a], 1, 0)
    code[np.arange(len(ids_b)) + end_a[in_b]] = ids_b + size * np.where(np.arange(len(ids_b)) + 1 == end_b[in_b], np.where(last[in_b], 3, 2), 0)
    text, off = text_buffer(_numerals(size).take(pa.array(code)))
    return text, off[np.concatenate([[0], end_a + end_b])]


def _aligned_slice(part: pa.RecordBatch, a: Vocabulary, b: Vocabulary, block: int) -> Iterator[pa.RecordBatch]:
    text = pc.fill_null(part.column("text").cast(pa.large_string()), "")
    keep = np.flatnonzero(pc.greater(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
    buf, off = text_buffer(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text.take(pa.array(keep)), pa.scalar("", pa.large_string())))
    ids, edge = [], []
    for v, starts in ((a, pretokens(buf, off)[0]), (b, _space_words(buf, off))):
        found, of_word = v.encode(buf, starts)
        ids.append(found)
        edge.append(of_word[np.searchsorted(starts, off)])
    # texts that either tokenizer does not give back have no tokens
    whole = np.ones(len(keep), bool)
    for v, found, at in zip((a, b), ids, edge, strict=True):
        ends = np.concatenate([[0], np.cumsum(v.lengths[found])])[at]
        whole &= np.diff(ends) == np.diff(off)
    if not whole.all():
        buf, keep, (ids, edge), off = _only(whole, buf, off, keep, ids, edge)
    same = np.ones(len(keep), bool)
    for v, found in zip((a, b), ids, strict=True):
        wrong = np.flatnonzero(v.joined(found) != buf)
        same[np.searchsorted(off, wrong, side="right") - 1] = False
    if not same.all():
        buf, keep, (ids, edge), off = _only(same, buf, off, keep, ids, edge)

    n = part.num_rows
    counts = {c: np.zeros(n, np.int64) for c in _COUNTS}
    group_at, texts = np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    refs = times = pairs = docs = np.zeros(0, np.int64)
    ref_at = np.zeros(n + 1, np.int64)
    if len(keep):
        own_a, own_b = (np.repeat(np.arange(len(x), dtype=np.int32), v.lengths[x]) for v, x in ((a, ids[0]), (b, ids[1])))
        turn_a, turn_b = (np.concatenate([[True], x[1:] != x[:-1]]) for x in (own_a, own_b))
        cut = turn_a & turn_b
        group = np.cumsum(cut) - 1
        at = np.flatnonzero(turn_a | turn_b)
        n_links, n_groups = np.diff(np.searchsorted(at, off)), np.diff(np.concatenate([[0], np.cumsum(cut)])[off])
        for c, x in zip(_COUNTS, (np.diff(edge[0]), np.diff(edge[1]), n_groups, n_links), strict=True):
            counts[c][keep] = x
        last = np.zeros(int(n_groups.sum()), bool)
        last[np.cumsum(n_groups) - 1] = True
        texts, edges = _groups(ids[0], ids[1], group[turn_a], group[turn_b], last, max(a.size, b.size))
        width = np.zeros(n, np.int64)
        width[keep] = np.diff(edges[np.concatenate([[0], np.cumsum(n_groups)])])
        group_at = np.concatenate([[0], np.cumsum(width)])
        pairs, ref = np.unique(ids[0][own_a[at]] << 32 | ids[1][own_b[at]], return_inverse=True)
        both, many = np.unique(np.repeat(keep, n_links) * len(pairs) + ref, return_counts=True)
        refs, times = both % len(pairs), many
        docs = np.bincount(refs, minlength=len(pairs))
        ref_at = np.searchsorted(both // len(pairs), np.arange(n + 1))
    ref_type = "<u2" if len(pairs) <= 1 << 16 else "<u4"
    none = pa.nulls(n, pa.binary())
    columns = [part.column("doc_id").cast(pa.int64()), *[pa.array(counts[c]) for c in _COUNTS], binary_rows(texts, group_at).cast(pa.large_string()), pa.array(np.full(n, block)), binary_rows(refs.astype(ref_type).view(np.uint8), ref_at * int(ref_type[2])), binary_rows(times.astype("<u4").view(np.uint8), ref_at * 4), none, none]
    yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)
    if len(pairs):
        row = {"block": block, "pairs": pairs.astype("<i8").tobytes(), "docs": docs.astype("<u4").tobytes()}
        yield pa.RecordBatch.from_pylist([row], schema=_SCHEMA)


def _only(which: np.ndarray, buf: np.ndarray, off: np.ndarray, keep: np.ndarray, ids: list[np.ndarray], edge: list[np.ndarray]) -> tuple:
    """The same arrays without some texts."""
    n = np.diff(off)
    ids = [x[np.repeat(which, np.diff(e))] for x, e in zip(ids, edge, strict=True)]
    edge = [np.concatenate([[0], np.cumsum(np.diff(e)[which])]) for e in edge]
    return buf[np.repeat(which, n)], keep[which], (ids, edge), np.concatenate([[0], np.cumsum(n[which])])


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Alignment of each text of ``docs(doc_id, text)``; other columns are left out.

    One row a document: ``n_a`` and ``n_b`` tokens, ``n_groups`` and ``n_links``, and ``groups``, ids as
    ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and those that either tokenizer's tokens do not give back byte for
    byte, have zeros and ''. Repeated rows and null ids are documents like others; a very long text is handled whole,
    in memory of about 60 times its bytes. ``refs`` and ``times`` are the distinct id pairs of the document's links as
    numbers in its block's dictionary, which is one more row for each block (``pairs`` is not null there).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(path_a), pieces(path_b)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text"):
                yield from _aligned_slice(part, a, b, block)
                block += 1

    return docs.select("doc_id", "text").mapInArrow(run, ALIGNED)


def _unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            pairs = np.frombuffer(row["pairs"], "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row["block"])), pa.array(pairs), pa.array(np.frombuffer(row["docs"], "<u4").astype(np.int64))], ["block", "pair", "docs"])


def link_pairs(aligned: DataFrame) -> DataFrame:
    """``(block, pair, docs)``: the id pairs (A's id in the upper 32 bits) of each block, with the documents that hold them."""
    return aligned.where("pairs is not null").select("block", "pairs", "docs").mapInArrow(_unpack, "block bigint, pair bigint, docs bigint")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``(pair, count, best)``: documents that hold a pair linked, and whether no pair of the same A id has more."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("count").alias("highest"))
    return counts.withColumn("a", F.shiftright("pair", 32)).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """The documents of ``align`` with ``n_best``, links whose count is their A id's highest, and ``count_sum``, over links.

    Other columns of ``aligned`` stay; those that hold its packed links go. The join moves each distinct pair of a
    block once, however often and in however many of its documents it is linked. Without documents there are no rows."""
    fixed = ["block", "refs", "times", "pairs", "docs"]
    out = [f for f in aligned.schema.fields if f.name not in fixed]
    schema = T.StructType([*out, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    names = [f.name for f in out]

    def sums(docs: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("pair").to_numpy())
        count, best = found.column("count").to_numpy()[order], found.column("best").to_numpy()[order].astype(np.int64)
        kind = "<u2" if len(order) <= 1 << 16 else "<u4"
        n = np.array([len(x) // 4 for x in docs.column("times").to_pylist()], np.int64)
        refs = np.frombuffer(b"".join(docs.column("refs").to_pylist()), kind)
        times = np.frombuffer(b"".join(docs.column("times").to_pylist()), "<u4").astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(n)])
        total = [np.concatenate([[0], np.cumsum(times * x[refs])]) if len(order) else np.zeros(len(times) + 1, np.int64) for x in (best, count)]
        columns = [docs.column(c) for c in names] + [pa.array(np.diff(t[edge])) for t in total]
        return freed(pa.table(columns, [*names, "n_best", "count_sum"]))

    with Scratch(aligned.sparkSession, "alignment") as scratch:
        table = scratch.written(aligned, "aligned")
        pairs = link_pairs(table)
        counts = scratch.written(pair_counts(pairs), "counts")
        found = pairs.select("block", "pair").join(counts, "pair")
        docs = table.where("pairs is null").drop("pairs", "docs")
        return scratch.result(docs.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(sums, schema))
