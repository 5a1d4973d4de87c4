"""Exact self-join of texts by Jaccard similarity of word n-grams: a parity-sketch join.

Sets of n-grams are cut by a hash into parts, and a part's sketch is the XOR of its members' hashes. Each n-gram in
one set alone changes one part, so two sets that differ in d n-grams agree in all but d parts (pigeonhole). A set of n
differs from any partner in at most n (1 - t) / t n-grams, so where more than that many parts are filled, partners
agree in a filled part and meet there. Parts are the same for all sets of a size band (a power of two, with those of
the band below that may have partners in it). Before the exact check, a second sketch of 4,096 parity bits gives a
lower bound of the difference by its Hamming distance.

Very frequent n-grams (boilerplate) may be left out of the sketches: leaving out the same n-grams everywhere never
adds to a difference. Sets with too few filled parts then also sketch all their n-grams, and if even those are too few
filled parts, each n-gram by itself; any pair of linked sets meets in the widest form that either of them needs.

Equal sets are one class from the start. Sets that meet are compared with the most connected set of their group
first; what that leaves apart is compared in pairs, in a large group with the nearest sets by parity bits first and with
more of them in rounds while some are left. So a large group of near copies costs a few comparisons a set, and no link
between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.graph import components
from hindcast.llm.kernels import freed, mix, runs, slices, text_buffer, window_hashes, word_hashes, words
from hindcast.llm.shared import written
from hindcast.llm.wordpieces import binary_rows

#: An n-gram is frequent if batches in which it occurs more than once have it ``FREQUENT_LEAST`` times together. Of more
#: than ``FREQUENT_MOST`` (8 bytes each, broadcast) only the most frequent count as such.
FREQUENT_LEAST, FREQUENT_MOST = 16, 2_000_000
#: Entries of a block of sketches, and blocks' bytes in a bucket, about.
BLOCK_ENTRIES, BUCKET_BYTES = 1 << 20, 12 << 20
#: A table of class and document ids is broadcast up to so many rows (16 bytes each).
BROADCAST_ROWS = 2_000_000
SKETCH_BITS = 4096
_U = np.uint64


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct ``width``-word n-grams, ascending, in a row; and the n + 1 offsets."""
    buf, off = text_buffer(column)
    starts, ends, at = words(buf, off)
    h = word_hashes(buf, starts, ends, lower=True)
    grams = window_hashes(h, width)
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            x = np.sort(grams[a : b - width + 1])
            sets.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        else:
            sets.append(window_hashes(h[a:b], b - a, seed=b - a) if b > a else h[:0])
    return (np.concatenate(sets) if sets else np.zeros(0, _U)), np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)


def class_ids(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each set (0 for an empty one)."""
    total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(values ^ _U(0x5BD1E995)), dtype=_U)])
    n = np.diff(at)
    return np.where(n > 0, mix((total[at[1:]] - total[at[:-1]]) ^ mix(n.astype(_U))) | _U(1), _U(0)).view(np.int64)


def parity_bits(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of ``SKETCH_BITS`` packed bits: the parity of each set's members that fall on each bit."""
    n = len(at) - 1
    place = np.repeat(np.arange(n), np.diff(at)) * SKETCH_BITS + (values >> _U(52)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=n * SKETCH_BITS) & 1).astype(bool).reshape(n, SKETCH_BITS), axis=1)


def _difference(n: np.ndarray, percent: int) -> np.ndarray:
    """The most n-grams in which a set of n and a partner can differ."""
    return n * (100 - percent) // percent


def sketches(values: np.ndarray, at: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Part sketches of all sets, and the set of each."""
    n = np.diff(at)
    most = _difference(n, percent)
    own = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
    rare = np.ones(len(values), bool)
    if len(frequent):
        k = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
        rare = frequent[k] != values
    of = np.repeat(np.arange(len(n)), n)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def parts(level: np.ndarray, use: np.ndarray, tier: int) -> np.ndarray:
        """Sketch the parts of the sets with ``level >= 0``; gives the number of filled parts of every set."""
        use = use & (level[of] >= 0)
        x, d = values[use], of[use]
        # with about 0.4 parts for an n-gram of the largest set, a set's filled parts outnumber its differences
        size = np.where(level >= 0, (6 * (100 - percent) << np.maximum(level + 1, 0)) // (5 * percent) + 3, 0)
        base = np.concatenate([[0], np.cumsum(size)])
        part = (((mix(x + (level[d].astype(_U) << _U(3))) >> _U(32)) * size[d].astype(_U)) >> _U(32)).astype(np.int64)
        xor = np.zeros(base[-1], _U)
        np.bitwise_xor.at(xor, base[d] + part, mix(x ^ _U(0x1B873593)))
        filled = np.flatnonzero(xor)
        who = np.searchsorted(base, filled, side="right") - 1
        salt = ((filled - base[who]).astype(_U) << _U(10)) + (level[who].astype(_U) << _U(2)) + _U(tier)
        found.append((mix(xor[filled] ^ mix(salt)), who))
        return np.bincount(who, minlength=len(n))

    can = most > 0  # else only an equal set can be a partner
    for level in (np.where(can, own, -1), np.where(can & (100 * n >= percent << (own + 1)), own + 1, -1)):
        level = np.where(parts(level, rare, 0) > most, -1, level)
        level = np.where(parts(level, np.ones(len(values), bool), 1) > most, -1, level) if (level >= 0).any() else level
        if (level >= 0).any():
            use = level[of] >= 0
            found.append((mix(values[use] ^ mix((level[of[use]].astype(_U) << _U(2)) + _U(2))), of[use]))
    return np.concatenate([x for x, _ in found]), np.concatenate([d for _, d in found])


_ENTRY = np.dtype([("sketch", "<u4"), ("ref", "<u2")])
_CLASSES = 1 << 16


def _blocks(sketch: np.ndarray, classes: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Entries by bucket: (bucket, ids of the classes in it, packed sketches with the number of their class).

    A bucket and 32 more bits tell sketches apart; sketches that fall together only bring sets to the exact check.
    """
    bucket = (sketch >> _U(32)) % _U(buckets)
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=_U))
    for b in np.flatnonzero(np.diff(edge)):
        some = order[edge[b] : edge[b + 1]]
        ids, ref = np.unique(classes[some], return_inverse=True)
        entry = np.empty(len(some), _ENTRY)
        entry["sketch"], entry["ref"] = sketch[some] & _U(0xFFFFFFFF), ref
        yield int(b), ids.astype("<i8").tobytes(), entry.tobytes()


def _groups(table: pa.Table) -> pa.Table:
    """Classes of one bucket that meet in a sketch, one row for each different set of classes."""
    sketch, classes = [], []
    for ids, packed in zip(table["ids"], table["entries"], strict=True):
        entry = np.frombuffer(packed.as_buffer(), _ENTRY)
        sketch.append(entry["sketch"])
        classes.append(np.frombuffer(ids.as_buffer(), "<i8")[entry["ref"]])
    sketch, classes = np.concatenate(sketch), np.concatenate(classes)
    order = np.argsort(sketch, kind="stable")
    sketch, classes = sketch[order], classes[order]
    same = sketch[1:] == sketch[:-1]
    keep = np.zeros(len(sketch), bool)
    keep[1:] |= same
    keep[:-1] |= same
    sketch, classes = sketch[keep], classes[keep]
    order = np.lexsort((classes, sketch))
    sketch, classes = sketch[order], classes[order]
    keep = np.ones(len(sketch), bool)
    keep[1:] = (sketch[1:] != sketch[:-1]) | (classes[1:] != classes[:-1])
    sketch, classes = sketch[keep], classes[keep]
    first = np.flatnonzero(np.concatenate([[True], sketch[1:] != sketch[:-1]])) if len(sketch) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(sketch)))
    known, number, count = np.unique(classes, return_inverse=True, return_counts=True)
    total = np.add.reduceat(mix(classes.astype(_U)), first) if len(first) else np.zeros(0, _U)
    big = np.flatnonzero(size > 1)
    _, one = np.unique(total[big], return_index=True)
    big = big[one]
    rows = [classes[a : a + s] for a, s in zip(first[big].tolist(), size[big].tolist(), strict=True)]
    leaders = [int(r[np.argmax(count[number[a : a + s]])]) for r, a, s in zip(rows, first[big].tolist(), size[big].tolist(), strict=True)]
    members = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size[big])]).astype(np.int32), np.concatenate(rows) if rows else np.zeros(0, np.int64))
    return pa.table({"gid": pa.array(total[big].view(np.int64)), "leader": pa.array(leaders, pa.int64()), "members": members})


_PAIR = np.dtype([("a", "<i8"), ("b", "<i8")])
PAIRS_HELD = 1 << 19
#: Sets of a group that are compared group by group; and sets of a block of a family.
LARGE, BLOCK = 32, 1024
#: Sets of a block that a set of a family meets in the first round; four times as many in each further one.
NEAREST = 4
_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], np.int32)


def _may_link(n: np.ndarray, m: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m n-grams whose parity bits differ in ``bits`` can be linked."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (_POPCOUNT[bits].sum(axis=1) * (100 + percent) <= (n + m) * (100 - percent))


def _possible(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        x, y = (text_buffer(batch.column(c))[0].reshape(-1, SKETCH_BITS // 8) for c in ("sketch_a", "sketch_b"))
        yield batch.select(["a", "b"]).filter(pa.array(_may_link(n, m, x ^ y, percent)))


def _pairs_apart(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of one group's classes that are in different components and whose sizes allow a link; each once a task."""
    seen, held, total = np.zeros(0, _PAIR), [], 0

    def new() -> pa.RecordBatch:
        nonlocal seen
        pairs = np.setdiff1d(np.concatenate(held), seen)
        seen = np.union1d(seen, pairs)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs["a"]), pa.array(pairs["b"])], ["a", "b"])

    for batch in batches:
        for row in range(batch.num_rows):
            m = batch.column("members")[row].values
            fp, part, n = (m.field(c).to_numpy() for c in ("fp", "component", "n"))
            order = np.argsort(n, kind="stable")
            fp, part, n = fp[order], part[order], n[order]
            to = np.searchsorted(n, n * 100 // percent, side="right")
            count = np.maximum(to - np.arange(len(n)) - 1, 0)
            i = np.repeat(np.arange(len(n)), count)
            j = i + 1 + runs(count)
            i, j = i[part[i] != part[j]], j[part[i] != part[j]]
            pairs = np.empty(len(i), _PAIR)
            pairs["a"], pairs["b"] = np.minimum(fp[i], fp[j]), np.maximum(fp[i], fp[j])
            held.append(pairs)
            total += len(pairs)
            if total > PAIRS_HELD:
                yield new()
                total = 0
    if held:
        yield new()


def _blocks_apart(t: pa.Table, percent: int, most: int) -> pa.Table:
    """Pairs between two blocks of a family (or within one) that are in different components and that sizes and parity
    bits allow: one after another row of the first block against the second, of each the ``most`` nearest by parity
    bits. A row of nulls tells that some row had more."""
    t = t.combine_chunks()
    own, fp, part, n = (t[c].to_numpy() for c in ("block", "fp", "component", "n"))
    bits = text_buffer(t["sketch"])[0].view(_U).reshape(len(fp), -1)
    first, second = np.flatnonzero(own == t["i"][0].as_py()), np.flatnonzero(own == t["j"][0].as_py())
    found, more = [], False
    for at, x in enumerate(first.tolist()):
        y = second[at + 1 :] if first[0] == second[0] else second
        y = y[(part[y] != part[x]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))]
        apart = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
        may = apart * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
        y, apart = y[may], apart[may]
        if len(y) > most:
            y, more = y[np.lexsort((fp[y], apart))[:most]], True
        found.append(np.stack([np.minimum(fp[x], fp[y]), np.maximum(fp[x], fp[y])]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    end = pa.nulls(int(more), pa.int64())
    return pa.table({c: pa.chunked_array([pa.array(v), end]) for c, v in zip("ab", pairs, strict=True)})


def _linked(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
            both = np.sort(np.concatenate([x, y]), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def shingle_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """One row for each document: ``doc_id``, ``n_shingles``, ``class_id``, ``component_id`` and ``text_key`` (xxhash64 of the
    text, which tells rows of one doc_id apart).

    A-Z are lower-cased; words are split at ASCII white space. A text's set are its distinct ``width``-word n-grams; with
    fewer words, all its words as one; without words or text, nothing (n_shingles 0, class_id 0), and it is linked
    with nothing and its own component. Documents of one class have equal sets. Documents are linked when
    ``100 * |A and B| >= percent * |A or B|``; component_id is the least doc_id that links lead to. A null doc_id is
    a document without a number: it counts in links and never as the least. Repeated rows are copies. Other columns
    are not looked at.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = []
            for part in slices(batch, "text"):
                values, at = shingle_sets(part.column("text"), width)
                seen.append(values)
                bits = parity_bits(values, at)
                nothing = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("text_key"), pa.array(np.diff(at)), pa.array(class_ids(values, at)), binary_rows(bits.ravel(), np.arange(part.num_rows + 1) * (SKETCH_BITS // 8)), nothing, nothing],
                    ["doc_id", "text_key", "n", "fp", "sketch", "gram", "count"],
                )
            grams, count = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, _U), np.zeros(0, np.int64))
            grams, count = grams[count > 1], count[count > 1]
            nothing = pa.nulls(len(grams), pa.int64())
            yield pa.RecordBatch.from_arrays([nothing, nothing, nothing, nothing, pa.nulls(len(grams), pa.binary()), pa.array(grams.view(np.int64)), pa.array(count)], ["doc_id", "text_key", "n", "fp", "sketch", "gram", "count"])

    described = written(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(describe, "doc_id bigint, text_key bigint, n bigint, fp bigint, sketch binary, gram bigint, count bigint"), "shingles")
    often = described.where("gram is not null").groupBy("gram").agg(F.sum("count").alias("c")).where(F.col("c") >= FREQUENT_LEAST)
    many = written(often, "frequent")
    sizes = many.groupBy(F.floor(F.log2("c") * 8).alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("k").desc()).collect()
    kept, lowest = 0, 10**6
    for row in sizes:  # some hundred rows: one for each eighth of a power of two
        kept += row["n"]
        if kept > FREQUENT_MOST:
            break
        lowest = row["k"]
    often = many.where(F.floor(F.log2("c") * 8) >= lowest)
    frequent = spark.sparkContext.broadcast(np.sort(often.select("gram").toPandas()["gram"].to_numpy(np.int64).view(_U)))
    members = described.where("n is not null").select("doc_id", "text_key", "n", "fp", "sketch")
    n_total = members.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(n_total * 7 // BUCKET_BYTES) + 1)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        texts = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(_blocks(np.concatenate([x for x, _ in held]), np.concatenate([c for _, c in held]), buckets))
            held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "ids", "entries"])

        for batch in batches:
            for part in slices(batch, "text"):
                if held and texts + part.num_rows > _CLASSES:
                    yield from flush()
                    texts = 0
                values, at = shingle_sets(part.column("text"), width)
                sketch, of = sketches(values, at, frequent.value, percent)
                held.append((sketch, class_ids(values, at)[of]))
                texts += part.num_rows
                if sum(len(x) for x, _ in held) > BLOCK_ENTRIES:
                    yield from flush()
                    texts = 0
        if held:
            yield from flush()

    signed = docs.mapInArrow(sign, "bucket int, ids binary, entries binary")
    groups = signed.groupBy("bucket").applyInArrow(lambda t: freed(_groups(t)), "gid bigint, leader bigint, members array<bigint>")
    groups = written(groups.groupBy("gid").agg(F.min_by("leader", "leader").alias("leader"), F.first("members").alias("members")), "groups")

    met = groups.select(F.explode("members").alias("fp")).distinct()
    # copies are added up before they are dealt by their set
    least = F.min_by(F.struct("doc_id", "n", "sketch"), F.coalesce("doc_id", F.lit(2**63 - 1))).alias("one")
    classes = written(members.groupBy("fp").agg(least).join(met, "fp").select("fp", "one.*"), "classes")

    def collect_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, at = shingle_sets(part.column("text"), width)
                ids = class_ids(values, at)
                same = pa.array(ids == part.column("fp").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(ids), binary_rows(values.view(np.uint8), at * 8)], ["fp", "grams"]).filter(same)

    def linked(pairs: DataFrame) -> DataFrame:
        """Pairs that are linked: those that sizes and parity bits allow are compared by their sets."""
        for side in ("a", "b"):
            pairs = pairs.join(classes.select(F.col("fp").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
        pairs = written(pairs.mapInArrow(lambda batches: _possible(batches, percent), "a bigint, b bigint"), "pairs")
        asked = classes.join(pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct(), "fp").select("fp", F.col("doc_id").alias("_doc"))
        asked = written(asked, "asked")
        small = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
        sets = docs.join(small, docs["doc_id"].eqNullSafe(small["_doc"])).select("fp", "text").mapInArrow(collect_sets, "fp bigint, grams binary")
        sets = written(sets.dropDuplicates(["fp"]), "sets")
        both = pairs.join(sets.select(F.col("fp").alias("a"), F.col("grams").alias("set_a")), "a").join(sets.select(F.col("fp").alias("b"), F.col("grams").alias("set_b")), "b")
        return written(both.mapInArrow(lambda batches: _linked(batches, percent), "a bigint, b bigint"), "links")

    stars = groups.select("leader", F.explode("members").alias("fp")).where("leader <> fp").select(F.least("leader", "fp").alias("a"), F.greatest("leader", "fp").alias("b")).distinct()
    first = linked(stars)
    part = written(components(first, "a", "b"), "parts")
    links, tested = first, stars

    def in_parts(df: DataFrame) -> DataFrame:
        return df.join(part.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))

    def open_groups() -> tuple[DataFrame, DataFrame]:
        """Members of groups with their components, and the groups that have several, with their sizes."""
        labelled = in_parts(groups.select("gid", F.explode("members").alias("fp")))
        sizes = labelled.groupBy("gid").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("size"))
        return labelled, sizes.where("x <> y").select("gid", "size")

    def nearest(most: int) -> Callable[[pa.Table], pa.Table]:
        return lambda t: _blocks_apart(t, percent, most)

    def compared(pairs: DataFrame) -> None:
        """Compare pairs that were not compared before, and bring links and components up to date."""
        nonlocal links, tested, part
        new = written(pairs.join(tested, ["a", "b"], "left_anti").distinct(), "apart")
        links, tested = links.unionByName(linked(new)), tested.unionByName(new)
        part = written(components(links, "a", "b"), "parts")

    # large groups are much alike: those that share sets are one family, whose rows meet their nearest first. What is
    # still apart after that meets more of them, until no row has any left
    large = written(groups.where(F.size("members") > LARGE).join(open_groups()[1].where(f"size > {LARGE}").select("gid"), "gid", "left_semi").select("leader", F.explode("members").alias("fp")).distinct(), "large")
    if not large.isEmpty():
        family = components(large, "leader", "fp").select(F.col("node").alias("fp"), F.col("component").alias("family"))
        family = written(family.join(classes.select("fp", "n", "sketch"), "fp"), "families")
        sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("size")).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        most, more = NEAREST, True
        while more:
            dealt = in_parts(family.join(sizes, "family")).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            dealt = dealt.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "fp", "component", "n", "sketch")
            near = written(dealt.groupBy("family", "i", "j").applyInArrow(nearest(most), "a bigint, b bigint"), "near")
            more = not near.where("a is null").isEmpty()
            compared(near.where("a is not null"))
            most *= 4
    labelled, open_now = open_groups()
    rest = labelled.join(open_now.where(f"size <= {LARGE}"), "gid").join(classes.select("fp", "n"), "fp").groupBy("gid").agg(F.collect_list(F.struct("fp", "component", "n")).alias("members"))
    compared(rest.mapInArrow(lambda batches: _pairs_apart(batches, percent), "a bigint, b bigint"))
    labelled = members.join(part.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    labelled = written(labelled.select("doc_id", "text_key", "n", "fp", "component"), "labelled")
    least = written(labelled.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    out = labelled.join(least, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("fp").alias("class_id"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "text_key")
