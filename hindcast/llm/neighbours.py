"""Approximate nearest neighbours: an inverted file of coarse centroids with product-quantised residuals.

Centroids and codebooks are fitted by k-means on a bounded sample (``SAMPLE``, drawn by a hash of the id); every vector
is indexed: its list is the nearest centroid, its code quantises what is left in ``PARTS`` parts of the vector. The
number of lists grows with the square root of the vectors. A query goes to the lists of its nearest centroids: to as
many as hold ``AIM`` of the true neighbours within the sample, so few where vectors have clusters and many where they
have none.

There, a table of the query's products with all code words gives its asymmetric distance to every coded vector. A first
pass finds each query's ``RERANK``-th smallest distance over all lists; a second one computes the exact cosine of the
vectors up to that distance, those that tie with it included, and only of these.

Lists are dealt to buckets, and a bucket with many vectors into chunks, so that a large list is no single task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.kernels import text_buffer
from hindcast.llm.shared import written
from hindcast.llm.vectors import rows, unit, usable

SAMPLE, PARTS, WORDS = 16_384, 16, 256
#: Lists for each square root of the vectors, and the least and most of them.
LISTS_BY_ROOT, LEAST_LISTS, MOST_LISTS = 4, 16, 1024
#: Share of the sample's true neighbours whose list is to be searched, and vectors that are ranked exactly.
AIM, RERANK = 0.97, 400
CHUNK, LEAST_BUCKETS = 16_384, 8


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    k = min(k, len(x))
    centre = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, centre)
        total, n = np.zeros_like(centre), np.bincount(near, minlength=k)
        np.add.at(total, near, x)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for a in range(0, len(x), 4096):
        out[a : a + 4096] = ((centre**2).sum(axis=1) - 2 * x[a : a + 4096] @ centre.T).argmin(axis=1)
    return out


@dataclass
class Index:
    centres: np.ndarray
    words: list[np.ndarray]  # of each part
    edges: np.ndarray  # of the parts
    probed: float  # share of the lists

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes, and what a coded vector adds to the distance from any query: its squared residual and twice its product with its centroid."""
        of = nearest(x, self.centres)
        rest = x - self.centres[of]
        parts = list(zip(self.words, self.edges[:-1], self.edges[1:], strict=True))
        codes = np.stack([nearest(rest[:, a:b], w) for w, a, b in parts], axis=1)
        near = np.concatenate([w[codes[:, k]] for k, (w, _, _) in enumerate(parts)], axis=1)
        return of, codes.astype(np.uint8), (near**2).sum(axis=1) + 2 * (near * self.centres[of]).sum(axis=1)

    def distances(self, q: np.ndarray, of: np.ndarray, codes: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Squared distances from a query to coded vectors, in single precision."""
        out = ((self.centres - q) ** 2).sum(axis=1)[of] + own
        for k, w in enumerate(self.words):
            out -= (2 * (w @ q[self.edges[k] : self.edges[k + 1]]))[codes[:, k]]
        return out.astype(np.float32)


def fit(x: np.ndarray, lists: int, k: int, seed: int) -> Index:
    rng = np.random.default_rng(seed)
    centres = kmeans(x, lists, rng)
    of = nearest(x, centres)
    rest = x - centres[of]
    edges = np.linspace(0, x.shape[1], min(PARTS, x.shape[1]) + 1).astype(int)
    words = [kmeans(rest[:, a:b], WORDS, rng) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    asked = rng.choice(len(x), min(len(x), 512), replace=False)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -2
    top = np.argpartition(-score, min(k, len(x) - 1), axis=1)[:, :k] if len(x) > 1 else np.zeros((1, 0), int)
    order = np.argsort((centres**2).sum(axis=1) - 2 * x[asked] @ centres.T, axis=1, kind="stable")
    place = np.argsort(order, axis=1, kind="stable")
    needed = place[np.arange(len(asked))[:, None], of[top]] + 1 if top.size else np.array([len(centres)])
    return Index(centres, words, edges, float(np.quantile(needed, AIM)) / len(centres))


def _search(index_rows: pa.Table, asked: pa.Table, index: Index, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query that comes to a chunk: its id, the exact candidates' ids and scores, or (without a limit) no ids
    and the smallest distances."""
    if not index_rows.num_rows or not asked.num_rows:
        return
    of, ids, own = (index_rows[c].to_numpy() for c in ("list", "vec_id", "own"))
    x = unit(rows(index_rows["embedding"]))
    codes = text_buffer(index_rows["code"])[0].reshape(len(ids), -1)
    second = "most" in asked.column_names
    most = asked["most"].to_numpy() if second else np.zeros(asked.num_rows)
    for query, q, lists, limit in zip(asked["query_id"].to_pylist(), unit(rows(asked["embedding"])), asked["lists"], most, strict=True):
        goes = np.zeros(len(index.centres), bool)
        goes[lists.values.to_numpy()] = True
        some = np.flatnonzero(goes[of] & (ids != query))
        distance = index.distances(q, of[some], codes[some], own[some])
        if not second:
            yield query, ids[:0], np.sort(distance[np.argpartition(distance, RERANK - 1)[:RERANK]] if len(distance) > RERANK else distance)
            continue
        some = some[distance <= limit]
        score = (x[some] * q).sum(axis=1)
        top = np.lexsort((ids[some], -score))[:k]
        yield query, ids[some][top], score[top]


def _smallest(i: pa.Table, a: pa.Table, index: Index, k: int) -> pa.Table:
    found = [(query, d.tobytes()) for query, _, d in _search(i, a, index, k)]
    return pa.table({"query_id": pa.array([q for q, _ in found], pa.int64()), "distances": pa.array([d for _, d in found], pa.binary())})


def _exact(i: pa.Table, a: pa.Table, index: Index, k: int) -> pa.Table:
    found = [(np.full(len(ids), query), ids, score) for query, ids, score in _search(i, a, index, k)]
    cols = [np.concatenate([np.zeros(0, t), *[f[c] for f in found]]) for c, t in enumerate((np.int64, np.int64, np.float64))]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), cols, strict=True)))


def _limit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``RERANK``-th smallest distance of each query."""
    for batch in batches:
        limits = []
        for held in batch.column("held"):
            d = np.concatenate([np.zeros(0, "<f4"), *[np.frombuffer(x.as_buffer(), "<f4") for x in held.values]])
            limits.append(float(np.partition(d, RERANK - 1)[RERANK - 1]) if len(d) > RERANK else float("inf"))
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(limits, pa.float64())], ["query_id", "most"])


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = 5) -> DataFrame:
    """The ``k`` nearest vectors to each query: query_id, rank (from 1), vec_id, score.

    ``queries`` is a condition on ``vec_id``; candidates are all rows of another id. ``score`` is the cosine in double
    precision; ties go to the smaller vec_id. A query goes to more lists than its share of them where those hold
    too few vectors, so that it gets all candidates if there are fewer than ``k``. Vectors that are null, empty or
    zero, hold null or non-finite components, have no id or differ in length from the first of the sample take no part.
    Of rows that share an id, one vector (the least) is used. An empty table gives an empty result. Other columns are
    not looked at.
    """
    spark = vectors.sparkSession
    every = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")).where(usable("embedding") & F.col("vec_id").isNotNull())
    every = every.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sample = every.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = len(sample["embedding"][0])
    sample = sample[sample["embedding"].map(len) == dim]
    total = vectors.count() if len(sample) == SAMPLE else len(sample)
    lists = int(np.clip(LISTS_BY_ROOT * total**0.5, LEAST_LISTS, MOST_LISTS))
    index = fit(unit(np.array(sample["embedding"].to_list(), float)), lists, k, seed)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, codes, own = index.encode(unit(rows(batch.column("embedding"))))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(of), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(own)], ["vec_id", "embedding", "list", "code", "own"])

    same = every.where(F.size("embedding") == dim)
    coded = written(same.mapInArrow(encode, "vec_id bigint, embedding array<double>, list bigint, code binary, own double"), "vector-index")
    held = np.zeros(len(index.centres), np.int64)
    for row in coded.groupBy("list").count().collect():  # MOST_LISTS rows at most
        held[row["list"]] = row["count"]
    buckets = max(LEAST_BUCKETS, int(held.sum()) // CHUNK)
    chunks = [max(1, -(-int(held[b::buckets].sum()) // (2 * CHUNK))) for b in range(min(buckets, len(held)))]

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(rows(batch.column("embedding")))
            near = np.argsort((index.centres**2).sum(axis=1) - 2 * x @ index.centres.T, axis=1, kind="stable")
            for r in range(batch.num_rows):
                enough = int(np.searchsorted(np.cumsum(held[near[r]]), k + 1)) + 1
                to = near[r][: max(enough, int(np.ceil(index.probed * len(held))))]
                out = [(b, c, to[to % buckets == b].tolist()) for b in np.unique(to % buckets).tolist() for c in range(chunks[b])]
                part = batch.slice(r, 1).take(pa.array([0] * len(out)))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("embedding"), *[pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.list_(pa.int64())))]], ["query_id", "embedding", "bucket", "chunk", "lists"])

    asked = coded.where(queries).select("vec_id", "embedding").mapInArrow(send, "query_id bigint, embedding array<double>, bucket int, chunk int, lists array<bigint>")
    bucket = (F.col("list") % buckets).cast("int")
    many = F.get(F.array(*[F.lit(c) for c in chunks]), F.col("bucket"))
    dealt = coded.withColumn("bucket", bucket).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), many).cast("int")).groupBy("bucket", "chunk")
    first = dealt.cogroup(asked.groupBy("bucket", "chunk")).applyInArrow(lambda i, a: _smallest(i, a, index, k), "query_id bigint, distances binary")
    limits = written(first.groupBy("query_id").agg(F.collect_list("distances").alias("held")).mapInArrow(_limit, "query_id bigint, most double"), "vector-limits")
    asked = asked.join(limits, "query_id")
    found = dealt.cogroup(asked.groupBy("bucket", "chunk")).applyInArrow(lambda i, a: _exact(i, a, index, k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
