"""Near-duplicate embeddings: Euclidean p-stable hashing with exact cosine checks.

On unit vectors a cosine of at least t is a distance of at most sqrt(2 - 2t). Each table hashes a vector to a number of
quantised random projections; vectors of one label that share a table's bucket are candidates. The number of
projections grows with the logarithm of the vectors of the largest label, so that a bucket holds about one unrelated
vector at any size, and the number of tables follows, so that a pair at the threshold shares no bucket with a
probability of ``MISS``: the work grows with about n to the power 1.24.

What is shuffled first are keys alone. Members of buckets of up to ``LARGE`` classes then bring a copy of 8 bits a
component, whose error bound leaves no linked pair out; the pairs that pass are made distinct and compared exactly, in
double precision. A larger bucket is dealt into blocks, and pairs of blocks are compared in tasks of their own, which
keep no pair: they give, for each vector, a number of links and the local component. A pair that meets in several
large buckets counts in the first one alone, and never among the pairs of small ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil, erf, exp, log, log1p, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.graph import components
from hindcast.llm.kernels import mix, text_buffer
from hindcast.llm.shared import written
from hindcast.llm.vectors import rows, unit, usable

#: Width of a cell, chance to miss a pair at the threshold, and the least and most projections of a table.
WIDTH, MISS, LEAST_HASHES, MOST_HASHES = 1.5, 0.001, 6, 24
LARGE, BLOCK = 32, 1024
_LABELS = "cls bigint, n bigint, lead bigint"
_U = np.uint64


def _same_cell(distance: float) -> float:
    """The probability that one projection puts two vectors of this distance into the same cell."""
    r = WIDTH / distance
    return erf(r / sqrt(2)) - sqrt(2 / pi) / r * (1 - exp(-(r**2) / 2))


def shape(n: int, least: float) -> tuple[int, int]:
    """Tables, and projections of each, for ``n`` vectors of one label and a threshold."""
    hashes = min(MOST_HASHES, max(LEAST_HASHES, ceil(log(max(n, 2)) / -log(_same_cell(sqrt(2)))) + 1))
    meet = _same_cell(sqrt(max(2 - 2 * least, 1e-6))) ** hashes
    return ceil(log(MISS) / log1p(-meet)), hashes


def bucket_keys(x: np.ndarray, tables: int, hashes: int, seed: int) -> np.ndarray:
    """The bucket of each vector in each table, as 64-bit keys."""
    rng = np.random.default_rng((seed, x.shape[1]))
    a, b = rng.standard_normal((x.shape[1], tables * hashes)), rng.random(tables * hashes) * WIDTH
    cells = np.floor((unit(x) @ a + b) / WIDTH).astype(np.int64).reshape(len(x), tables, hashes)
    key = np.zeros((len(x), tables), _U)
    for k in range(hashes):
        key = (key ^ cells[:, :, k].astype(_U)) * _U(0x9E3779B97F4A7C15)
        key ^= key >> _U(29)
    return mix(key + (np.arange(tables, dtype=_U) << _U(40)))


def _rough(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors in 8 bits a component, the scale of each and the length of what is lost."""
    x = unit(x)
    scale = np.abs(x).max(axis=1) / 127
    small = np.rint(x / scale[:, None]).astype(np.int8)
    return small, scale, np.linalg.norm(x - small * scale[:, None], axis=1) + 1e-9


def _pairs(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs of each small bucket whose cosine can reach ``least``; rows come sorted by bucket."""
    left: pa.Table | None = None

    def within(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        key, cls, scale, lost = (t[c].to_numpy() for c in ("key", "cls", "scale", "lost"))
        buf, off = text_buffer(t["rough"])
        found = [np.zeros((2, 0), np.int64)]
        for step in range(1, LARGE):
            i = np.flatnonzero(key[step:] == key[:-step])
            if not len(i):
                break
            for k in range(0, len(i), 1 << 15):
                a, b = i[k : k + (1 << 15)], i[k : k + (1 << 15)] + step
                dim = np.diff(off)[a]
                for d in np.unique(dim):
                    p, q = a[dim == d], b[dim == d]
                    x, y = (buf[off[z][:, None] + np.arange(d)].view(np.int8).astype(np.float32) for z in (p, q))
                    near = np.einsum("ij,ij->i", x, y) * scale[p] * scale[q] >= least - lost[p] - lost[q] - lost[p] * lost[q] - 1e-5
                    found.append(np.stack([np.minimum(cls[p], cls[q])[near], np.maximum(cls[p], cls[q])[near]]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([left, t]) if left is not None else t
        key = t["key"].to_numpy()
        cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if t.num_rows and (key != key[-1]).any() else 0
        left = t.slice(cut)
        if cut:
            yield within(t.slice(0, cut))
    if left is not None and left.num_rows:
        yield within(left)


def _exact(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = batch.column("x").value_lengths().to_numpy()
        keep = np.zeros(batch.num_rows, bool)
        for d in np.unique(size):
            some = np.flatnonzero(size == d)
            x, y = (unit(rows(batch.column(c).take(pa.array(some)))) for c in ("x", "y"))
            keep[some] = (x * y).sum(axis=1) >= least
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _compare(cls: np.ndarray, copies: np.ndarray, own: np.ndarray, x: np.ndarray, keys: np.ndarray, table: int, i: int, j: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links of one large bucket, between blocks i and j: classes, their new links (those that no large bucket of an
    earlier table has), and the least class they lead to."""
    a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
    close = x[a] @ x[b].T >= least
    if i == j:
        np.fill_diagonal(close, False)
    if not close.any():
        return None
    new = close.copy()
    for t in range(table):
        new &= keys[a, t][:, None] != keys[b, t][None, :]
    n = np.zeros(len(cls), np.int64)
    np.add.at(n, a, new @ copies[b])
    if i != j:
        np.add.at(n, b, copies[a] @ new)
    lead = cls.copy()
    while True:
        before = lead.copy()
        low = np.where(close, lead[b][None, :], np.iinfo(np.int64).max).min(axis=1)
        lead[a] = np.minimum(lead[a], low)
        low = np.where(close, lead[a][:, None], np.iinfo(np.int64).max).min(axis=0)
        lead[b] = np.minimum(lead[b], low)
        if (lead == before).all():
            break
    some = (n > 0) | (lead != cls)
    return cls[some], n[some], lead[some]


def _links(batches: Iterable[pa.RecordBatch], tables: int, least: float) -> Iterator[pa.RecordBatch]:
    """Compare the rows of each large bucket and pair of blocks; rows come sorted by these."""
    names = ["key", "i", "j"]
    left: pa.Table | None = None

    def groups(t: pa.Table, final: bool) -> Iterator[pa.Table]:
        nonlocal left
        cols = [t[c].to_numpy() for c in names]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if t.num_rows else np.zeros(0, int)
        edge = [0, *new.tolist(), t.num_rows]
        for a, b in zip(edge[:-2], edge[1:-1], strict=True):
            yield t.slice(a, b - a)
        left = t.slice(edge[-2], edge[-1] - edge[-2])
        if final and left.num_rows:
            yield left

    def one(t: pa.Table) -> pa.RecordBatch | None:
        t = t.combine_chunks()
        cls, place = t["cls"].to_numpy(), t["place"].combine_chunks()
        keys = np.repeat(mix(cls.view(_U))[:, None], tables, axis=1).view(np.int64)  # equal in no two rows
        keys[np.repeat(np.arange(len(cls)), place.value_lengths().to_numpy()), place.flatten().field("table").to_numpy()] = place.flatten().field("key").to_numpy()
        got = _compare(cls, t["copies"].to_numpy(), t["block"].to_numpy(), unit(rows(t["embedding"])), keys, t["table"][0].as_py(), t["i"][0].as_py(), t["j"][0].as_py(), least)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in got], ["cls", "n", "lead"]) if got else None

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([left, t]) if left is not None and left.num_rows else t
        yield from (r for g in groups(t, False) if (r := one(g)) is not None)
    if left is not None and left.num_rows and (r := one(left)) is not None:
        yield r


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = 0.93, seed: int = 7) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id and kept (vec_id = component_id).

    Vectors are compared only with those of the same, not null, label and of the same length. Vectors that are null,
    empty or zero or hold null or non-finite components, and those without a label or an id, link with nothing. Rows that
    are equal in id, label and vector are one vector and give one row; equal vectors of other ids are copies, which
    are compared once and counted as often as they are there. An empty table gives an empty one. Other columns are not
    looked at.
    """
    every = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"), F.col(label).cast("bigint").alias("label")).distinct()
    taking = every.where(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # classes of equal vectors, named by a hash of label and vector
    classes = taking.groupBy("label", "embedding").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    classes = classes.withColumn("cls", F.xxhash64("label", "embedding"))
    classes = written(classes.withColumn("dim", F.size("embedding")), "vector-classes")

    largest = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    tables, hashes = shape(int(largest), least)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, base = batch.column("dim").to_numpy(), batch.column("base").to_numpy()
            for d in np.unique(dims):
                part, some = batch.filter(pa.array(dims == d)), base[dims == d].view(_U)
                keys = mix(bucket_keys(rows(part.column("embedding")), tables, hashes, seed) ^ some[:, None])
                lists = pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * tables, keys.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays([part.column("cls"), lists], ["cls", "keys"])

    def roughen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                small, scale, lost = _rough(rows(part.column("embedding")))
                yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array([r.tobytes() for r in small], pa.binary()), pa.array(scale), pa.array(lost)], ["cls", "rough", "scale", "lost"])

    signed = classes.select("cls", "dim", F.xxhash64("label", "dim").alias("base"), "embedding").mapInArrow(sign, "cls bigint, keys array<bigint>")
    places = signed.select("cls", F.posexplode("keys").alias("table", "key"))
    sizes = places.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = written(places.join(sizes, "key"), "vector-buckets")

    rough = classes.select("cls", "dim", "embedding").mapInArrow(roughen, "cls bigint, rough binary, scale double, lost double")
    small = met.where(F.col("size") <= LARGE).select("key", "cls").join(rough, "cls").repartition("key").sortWithinPartitions("key")
    near = small.mapInArrow(lambda b: _pairs(b, least), "a bigint, b bigint").distinct()
    for side, x in (("a", "x"), ("b", "y")):
        near = near.join(classes.select(F.col("cls").alias(side), F.col("embedding").alias(x)), side)
    near = near.mapInArrow(lambda b: _exact(b, least), "a bigint, b bigint")

    crowded = met.where(F.col("size") > LARGE)
    place = crowded.groupBy("cls").agg(F.collect_list(F.struct("table", "key")).alias("place"))  # one for each table at most
    for side, x in (("a", "x"), ("b", "y")):
        near = near.join(place.select(F.col("cls").alias(side), F.col("place.key").alias(x)), side, "left")
    near = written(near.where(~F.coalesce(F.arrays_overlap("x", "y"), F.lit(False))).select("a", "b"), "vector-pairs")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    crowded = crowded.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cls", F.lit("block")), F.col("blocks")).cast("int"))
    crowded = crowded.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    full = crowded.join(classes.select("cls", "copies", "embedding"), "cls").join(place, "cls")
    ready = full.select("key", "table", "i", "j", "block", "cls", "copies", "embedding", "place").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = written(ready.mapInArrow(lambda b: _links(b, tables, least), _LABELS), "vector-links")

    sides = near.select(F.col("a").alias("cls"), F.col("b").alias("to")).unionByName(near.select(F.col("b").alias("cls"), F.col("a").alias("to")))
    few = sides.join(classes.select(F.col("cls").alias("to"), "copies"), "to").select("cls", F.col("copies").alias("n"))
    counts = found.select("cls", "n").unionByName(few).groupBy("cls").agg(F.sum("n").alias("n"))
    found = found.select("cls", "lead").unionByName(near.select(F.col("a").alias("cls"), F.col("b").alias("lead")))
    part = components(found, "cls", "lead").withColumnRenamed("node", "cls")
    joined = classes.select("label", "embedding", "cls", "least_id", "copies").join(counts, "cls", "left").join(part, "cls", "left")
    joined = joined.withColumn("component", F.coalesce("component", "cls"))
    named = joined.groupBy("component").agg(F.min("least_id").alias("component_id"))
    described = joined.join(named, "component").select("cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = every.withColumn("cls", F.when(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.xxhash64("label", "embedding"))).join(described, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
