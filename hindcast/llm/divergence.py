"""How far the word use of the sources of a language diverges: all pairs, by two-dimensional tiles of group blocks.

A group is a source of a language. Terms are counted once over the texts; a language keeps the terms that enough of its
documents hold. Groups of a language are numbered and cut into blocks of ``BLOCK``; its vocabulary is cut into sections
of about ``SECTION`` terms. Each group's counts of a section travel packed, as one row, to the tiles of its block with
every other block. A task of a tile walks through its sections in chunks of ``CHUNK`` terms and holds two blocks of
probabilities of one chunk; sums over sections are added up afterwards. So no task holds a vocabulary or a language.

Probabilities are whole numbers of billionths, p = 1 + floor(10^9 (count + s) / (N + s V)); all sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.kernels import slices, text_buffer
from hindcast.llm.shared import Scratch

BLOCK, SECTION, CHUNK = 32, 1 << 13, 1 << 11
SCALE, SMOOTH = 1_000_000_000, 5
#: Parts of a hot group in the join with the groups' totals.
SALTS = 64

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_COUNTS = pa.schema([("lang", pa.large_string()), ("source", pa.large_string()), ("term", pa.large_string()), ("count", pa.int64()), ("docs", pa.int64())])


def _terms(buf: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms in a row, A-Z lower-cased, and how many each text has."""
    inside = _INSIDE[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < buf.size)]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    kept = buf[inside]
    kept = np.where((kept >= 65) & (kept <= 90), kept | 32, kept).astype(np.uint8)
    edges = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(kept)]), np.diff(np.searchsorted(starts, off))


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each slice by (lang, source, term), and a row without a term for each of its (lang, source)."""
    for batch in batches:
        for part in slices(batch, "text"):
            langs, sources = (part.column(c).cast(pa.large_string()).dictionary_encode() for c in ("lang", "source"))
            lang, source = (x.indices.to_numpy().astype(np.int64) for x in (langs, sources))
            n_sources = len(sources.dictionary)
            groups, group = np.unique(lang * n_sources + source, return_inverse=True)
            found, n = _terms(*text_buffer(part.column("text")))
            coded = found.dictionary_encode()
            v = len(coded.dictionary)
            held, times = np.unique(np.repeat(np.arange(part.num_rows), n) * v + coded.indices.to_numpy(), return_counts=True)
            pair, which = np.unique(group[held // v] * v + held % v, return_inverse=True) if v else (held, held)
            count, docs = np.bincount(which, times, len(pair)).astype(np.int64), np.bincount(which, minlength=len(pair))
            of = np.concatenate([pair // max(v, 1), np.arange(len(groups))])
            # only its bytes are cut at ASCII, so a term of a valid text is valid
            term = pa.chunked_array([coded.dictionary.cast(pa.large_string()).take(pa.array(pair % max(v, 1))), pa.nulls(len(groups), pa.large_string())]).combine_chunks()
            zeros = np.zeros(len(groups), np.int64)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(groups[of] // n_sources)), sources.dictionary.take(pa.array(groups[of] % n_sources)), term, pa.array(np.concatenate([count, zeros])), pa.array(np.concatenate([docs, zeros]))],
                schema=_COUNTS,
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, count, docs)``: occurrences of a term in the texts of a group, and the documents that hold it.

    One row more with a null term names each group, so that a group without terms is there too. Null texts, languages
    and sources count as ''. Slices are counted before Spark adds them up."""
    blank = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = blank.mapInArrow(_count_terms, "lang string, source string, term string, count bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def probability(count: Column, size: Column) -> Column:
    """1 + floor(10^9 (count + s) / size) in exact arithmetic."""
    return F.call_function("div", (count + SMOOTH).cast("decimal(24,0)") * F.lit(SCALE).cast("decimal(10,0)"), size.cast("decimal(24,0)")) + 1


def _whole(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same for arrays: three digits of the quotient at a time stay below 2**63 while sizes are below 9 * 10**15."""
    out, rest = np.zeros(np.broadcast(count, size).shape, np.int64), count + SMOOTH
    whole, rest = np.divmod(rest, size)
    out += whole
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, size)
        out = out * 1000 + digit
    return out + 1


def _tile(rows: pa.Table) -> pa.Table:
    """Sums of one section for the pairs of a tile: two blocks of groups (or one with itself), in chunks of its terms."""
    number, width = rows.column("number").to_numpy(), int(rows.column("width")[0].as_py())
    order = np.argsort(number)
    block = number[order] // BLOCK
    rows = rows.take(pa.array(order))
    size = rows.column("size").to_numpy()
    positions, counts = ([np.asarray(x, np.int64) for x in rows.column(c).to_pylist()] for c in ("positions", "counts"))
    sides = [np.flatnonzero(block == block[0]), np.flatnonzero(block == block[-1])]
    total = np.zeros((len(sides[0]), len(sides[1])), np.int64)
    sources = rows.column("source").combine_chunks()
    where = [np.argsort(x) for x in positions]
    for low in range(0, width, CHUNK):
        p = np.zeros((len(order), min(CHUNK, width - low)), np.int64)
        for k, at in enumerate(where):
            a, b = np.searchsorted(positions[k][at], [low, low + CHUNK])
            p[k, positions[k][at[a:b]] - low] = counts[k][at[a:b]]
        p = _whole(p, size[:, None])
        right = p[sides[1]]
        for i, k in enumerate(sides[0]):
            total[i] += np.abs(right - p[k]).sum(axis=1)
    i, j = (x.ravel() for x in np.meshgrid(sides[0], sides[1], indexing="ij"))
    value = total.ravel()
    if block[0] != block[-1]:
        i, j, value = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([value, value])
    i, j, value = (x[i != j] for x in (i, j, value))
    lang = rows.column("lang").combine_chunks().take(pa.array(np.zeros(len(i), np.int64)))
    return pa.table([lang, sources.take(pa.array(i)), sources.take(pa.array(j)), pa.array(value)], ["lang", "source", "item", "value"])


def _pairs(own: DataFrame, kept: DataFrame, sizes: DataFrame, sections: int) -> DataFrame:
    """``(lang, source, item, value)``: the summed difference of each two sources of a language."""
    widths = kept.groupBy("lang", "section").agg(F.count(F.lit(1)).alias("width"))
    packed = own.groupBy("lang", "source", "section").agg(F.collect_list(F.struct("position", "count")).alias("v")).select("lang", "source", "section", F.col("v.position").alias("positions"), F.col("v.count").alias("counts"))
    every = sizes.select("lang", "source", "number", "blocks", "size", F.explode(F.sequence(F.lit(0), F.lit(sections - 1))).alias("section"))
    # a language that keeps nothing has one section without terms, so that its pairs are there with 0
    every = every.join(widths, ["lang", "section"], "left").withColumn("width", F.coalesce("width", F.lit(0))).where("width > 0 or section = 0")
    vectors = every.join(packed, ["lang", "source", "section"], "left").withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in (("positions", "array<int>"), ("counts", "array<bigint>"))})
    block = F.expr(f"cast(number div {BLOCK} as int)")
    sent = vectors.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"low": F.least(block, "other"), "high": F.greatest(block, "other")})
    tiles = sent.select("lang", "low", "high", "section", "source", "number", "size", "width", "positions", "counts").groupBy("lang", "low", "high", "section")
    return tiles.applyInArrow(_tile, "lang string, source string, item string, value bigint").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _over_used(own: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: how far a group's probability of a term is above its language's."""
    salted = sizes.select("lang", "source", "size", "lang_size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    both = own.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(salted, ["lang", "source", "salt"])
    over = probability(F.col("count"), F.col("size")) - probability(F.col("lang_count"), F.col("lang_size"))
    return both.select("lang", "source", F.col("term").alias("item"), over.alias("value")).where("value > 0")


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs(text, lang, source)``.

    ``pair``: each other source of the language, by the absolute differences of probabilities summed over the kept terms
    (0 where none is kept); ``term``: the ``top`` terms that a group uses more than its language. Null texts, languages
    and sources count as ''; a group without terms is there with counts of 0; repeated rows count as often as they
    stand; a very long text is counted whole, in the memory of one slice. No documents give no rows. Equal values are
    ranked by the item's bytes. Other columns are not read. Sizes have to stay below 9 * 10**15 terms."""
    with Scratch(docs.sparkSession, "divergence") as scratch:
        counts = scratch.written(term_counts(docs), "counts")
        terms = counts.where("term is not null")
        per_term = terms.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
        per_term = scratch.written(per_term, "vocabulary")
        langs = per_term.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("n"))
        largest = langs.agg(F.max("v"), F.max("n")).first()
        if (largest[1] or 0) + SMOOTH * (largest[0] or 0) >= 9 * 10**15:
            raise ValueError("too many terms for exact sums")
        sections = -(-(largest[0] or 1) // SECTION)
        in_section = Window.partitionBy("lang", "section").orderBy("term")
        kept = per_term.withColumn("section", F.pmod(F.xxhash64("term"), F.lit(sections)).cast("int")).withColumn("position", F.row_number().over(in_section) - 1)
        kept = scratch.written(kept, "kept")
        own = scratch.written(terms.select("lang", "source", "term", "count").join(kept, ["lang", "term"]), "own")
        of_lang = Window.partitionBy("lang")
        sizes = counts.where("term is null").select("lang", "source").join(own.groupBy("lang", "source").agg(F.sum("count").alias("n")), ["lang", "source"], "left")
        sizes = sizes.join(langs.withColumnRenamed("n", "lang_n"), "lang", "left").select(
            "lang",
            "source",
            (F.coalesce("n", F.lit(0)) + SMOOTH * F.coalesce("v", F.lit(0))).alias("size"),
            (F.coalesce("lang_n", F.lit(0)) + SMOOTH * F.coalesce("v", F.lit(0))).alias("lang_size"),
            (F.row_number().over(of_lang.orderBy("source")) - 1).alias("number"),
            F.ceil(F.count(F.lit(1)).over(of_lang) / BLOCK).cast("int").alias("blocks"),
        )
        sizes = scratch.written(sizes, "sizes")
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        out = [x.withColumn("rank", F.row_number().over(ranked)).where(F.lit(True) if most is None else F.col("rank") <= most).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, x, most in (("pair", _pairs(own, kept, sizes, sections), None), ("term", _over_used(own, sizes), top))]
        return scratch.result(out[0].unionByName(out[1]))
