"""Token files with random access: directly addressable codes.

Ids are split into 8-bit chunks. Level 0 holds the lowest chunk of every id; a bitmap tells which ids go on in the
next level, and a rank directory counts the set bits before each block of 512, so that the chunk of an id in the next
level is found by one directory entry and the bits of one block. No other id is decoded on the way.

A store is a Parquet folder, so it may lie wherever Spark can write. Each row is a segment: whole documents with about
``SEGMENT`` ids together. Rows are in ascending order of doc_id, by ``part`` (a range of doc_id) and ``segment``.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.llm.kernels import slices
from hindcast.llm.wordpieces import WordTable, binary_rows

SEGMENT = 1 << 20
BLOCK = 512
#: Bytes of text that are encoded together: the more, the fewer times a frequent word is looked up.
SLICE = 8 << 20

LEVEL = T.StructType([T.StructField(c, T.BinaryType()) for c in ("chunks", "more", "ranks")])
SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("start", T.LongType()),  # ids before it in its part
        T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("ends", T.BinaryType()),  # int64, by document, from the segment's start
        T.StructField("levels", T.ArrayType(LEVEL)),
    ]
)


def pack(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Ids (unsigned 32-bit) as chunk levels with continuation bitmaps and rank directories."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        before = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64))])[:-1] if len(more) else np.zeros(0)
        levels.append({"chunks": (rest & 255).astype(np.uint8).tobytes(), "more": bits.tobytes(), "ranks": before.astype("<u4").tobytes()})
        rest = rest[more] >> 8
        if not len(rest):
            return levels


def unpack(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    out, places = np.zeros(0, np.uint32), None
    for k, level in enumerate(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        if places is None:
            out, places = chunks, np.arange(len(chunks))
        else:
            out[places] |= chunks << np.uint32(8 * k)
        places = places[np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(chunks), bitorder="little").astype(bool)]
    return out


_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], np.int64)


def at(levels: list[dict[str, bytes]], places: np.ndarray) -> np.ndarray:
    """The ids at some places of a segment; only their own chunks, and the bits of their own blocks, are read."""
    out, which, place = np.zeros(len(places), np.uint32), np.arange(len(places)), np.asarray(places, np.int64)
    for k, level in enumerate(levels):
        if not len(which):
            break
        out[which] |= np.frombuffer(level["chunks"], np.uint8)[place].astype(np.uint32) << np.uint32(8 * k)
        bits = np.frombuffer(level["more"], np.uint8)
        goes = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        which, place = which[goes], place[goes]
        block = place // BLOCK
        first = block * (BLOCK // 8)
        cover = np.minimum(first[:, None] + np.arange(BLOCK // 8), len(bits) - 1)
        inside = np.where(first[:, None] + np.arange(BLOCK // 8) < (place >> 3)[:, None], _POPCOUNT[bits[cover]], 0).sum(axis=1)
        inside += _POPCOUNT[bits[place >> 3] & ((1 << (place & 7)) - 1).astype(np.uint8)]
        place = np.frombuffer(level["ranks"], "<u4")[block].astype(np.int64) + inside
    return out


@lru_cache(maxsize=2)
def _tokenizer_table(path: str) -> WordTable:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 2048):  # the library's results take much more room than their ids
            found = [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words[k : k + 2048]], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        return np.concatenate(flat), np.concatenate(counts)

    return WordTable(encode, limit=700_000)  # the library takes long for a word


@lru_cache(maxsize=2)
def _added_tokens(path: str) -> dict[str, int]:
    """The tokens that the library finds in a text before it splits it, by their literal."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that take in white space or stand for whole words only are not supported")
    return {t["content"]: t["id"] for t in added if t["content"]}


def _encode(column: pa.Array, tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the n + 1 offsets of the texts in them; added tokens cut a text into pieces."""
    table, added = _tokenizer_table(tokenizer), _added_tokens(tokenizer)
    if not any(pc.any(pc.match_substring(column, x)).as_py() for x in added):
        return table.encode_column(column)
    cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)) + ")")
    parts = [cut.split(t or "") for t in column.to_pylist()]  # pieces, and the added tokens between them
    ids, edge = table.encode_column(pa.array([x for p in parts for x in p[::2]], pa.large_string()))
    between = np.array([i for p in parts for i in [*map(added.__getitem__, p[1::2]), -1]], np.int64)
    there = between >= 0
    ids = np.insert(ids, edge[1:][there], between[there].astype(np.uint32))
    edge = edge + np.concatenate([[0], np.cumsum(there)])
    return ids, edge[np.cumsum([0, *[len(p) // 2 + 1 for p in parts]])]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs(doc_id, text)`` with the tokenizer file of the tokenizers library into a store at ``path``.

    The tokenizer must be byte-level BPE with the usual split and without a space before the text. Its added tokens get
    their ids wherever a text holds their literal, as in the library. Each document's ids end with ``end_id``; a null text is empty. A null doc_id comes first, repeated ones stay side by side. Other
    columns are not stored. Texts move once, to their range of doc_id.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        state = {"segment": 0, "start": 0}
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def segment() -> pa.RecordBatch:
            ids = np.concatenate([x[1] for x in held])
            ends = np.cumsum(np.concatenate([x[2] for x in held]))
            row = {"part": part, "segment": state["segment"], "start": state["start"], "n_tokens": len(ids), "doc_ids": [i for x in held for i in x[0]], "ends": ends.astype("<i8").tobytes(), "levels": pack(ids)}
            state["segment"] += 1
            state["start"] += len(ids)
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for some in slices(batch, "text", SLICE):
                flat, edge = _encode(some.column("text"), tokenizer)
                held.append((some.column("doc_id").to_pylist(), np.insert(flat, edge[1:], end_id), np.diff(edge) + 1))
                if sum(len(x[1]) for x in held) >= SEGMENT:
                    yield segment()
        if held:
            yield segment()

    ordered.mapInArrow(task, SCHEMA).write.option("compression", "uncompressed").parquet(path)


_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.binary())]
    + [("levels", pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])))]
)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The store's segments, with ``first``: the number of ids before each in the whole store.

    What is broadcast is one row for each part (a written file), not for each segment or document.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(parts), "part").withColumn("first", F.col("base") + F.col("start")).drop("base")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a store: doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian
    unsigned 32-bit)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = unpack(row["levels"]).astype("<u4")
                edge = np.concatenate([[0], np.frombuffer(row["ends"], "<i8")])
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["first"] + edge[:-1]), pa.array(np.diff(edge)), binary_rows(ids.view(np.uint8), edge * 4)], ["doc_id", "start", "n_tokens", "ids"])

    return segments(spark, path).select("doc_ids", "ends", "levels", "first").mapInArrow(task, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def lookup(spark: SparkSession, path: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """The id at each of some positions of the whole store; positions outside it, or null, give no row.

    Positions meet their segment by an equality join on blocks of ``SEGMENT`` positions, of which a segment of usual
    size touches at most three.
    """
    store = segments(spark, path).select("first", "n_tokens", "levels", F.explode(F.sequence(F.floor(F.col("first") / SEGMENT), F.floor((F.col("first") + F.col("n_tokens") - 1) / SEGMENT))).alias("_block"))
    asked = positions.select(F.col(position).cast("bigint").alias("position")).withColumn("_block", F.floor(F.col("position") / SEGMENT))
    asked = asked.groupBy("_block").agg(F.sort_array(F.collect_set("position")).alias("positions"))  # SEGMENT at most
    inside = F.filter("positions", lambda p: (p >= F.col("first")) & (p < F.col("first") + F.col("n_tokens")))
    found = store.join(asked, "_block").select("first", "levels", inside.alias("positions")).where(F.size("positions") > 0)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                places = np.array(row["positions"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(at(row["levels"], places - row["first"]).astype(np.int64))], ["position", "token_id"])

    return found.mapInArrow(task, "position bigint, token_id bigint")
