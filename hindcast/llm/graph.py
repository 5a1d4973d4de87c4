"""Connected components of an edge table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.shared import written


#: So many edges (16 bytes each) are one task's work at the end; more of them go by steps.
TASK_EDGES = 1_000_000


def _finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of at most ``TASK_EDGES`` edges: hooking to the smaller root, and pointer jumping."""
    held = list(batches)
    if not held:
        return
    u, v = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v"))
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v, top = index[: len(u)], index[len(u) :], np.arange(len(nodes))
    while (top[u] != top[v]).any():
        np.minimum.at(top, np.maximum(top[u], top[v]), np.minimum(top[u], top[v]))
        while (top[top] != top).any():
            top = top[top]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[top])], ["node", "component"])


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, component)`` for every node of ``edges``: the component is its least node.

    Nodes are 64-bit integers; null ends, loops and repeated edges are ignored. Each step is a grouped minimum (with
    partial sums before its shuffle) and an equality join, so a node with very many edges is no single group. Steps
    are written to the shared folder; their number grows with the logarithm of the longest path. Once no more than
    ``TASK_EDGES`` edges are there, one task finishes.
    """
    pairs = edges.select(F.col(u).cast("bigint").alias("u"), F.col(v).cast("bigint").alias("v")).where("u is not null and v is not null and u <> v")
    now = written(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while now.count() > TASK_EDGES:
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = now.groupBy("u").agg(F.min("v").alias("m")).unionByName(now.select(F.col("v").alias("u"), F.col("v").alias("m"))).groupBy("u").agg(F.min("m").alias("m"))
        large = sides.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        after = written(small, "edges")
        same = [x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first() for x in (now, after)]
        now = after
        if tuple(same[0]) == tuple(same[1]):
            break
    else:
        return now.coalesce(1).mapInArrow(_finish, "node bigint, component bigint")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
