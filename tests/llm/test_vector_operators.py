import numpy as np
import pytest
from pyspark.sql import functions as F

from hindcast.llm.graph import components
from hindcast.llm.near_vectors import near_duplicates
from hindcast.llm.neighbours import nearest_neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((400, 24))
    near = x[:1] + 0.05 * rng.standard_normal((60, 24))
    rows = [(i, [float(v) for v in row], i % 3) for i, row in enumerate(np.concatenate([x, np.repeat(near, 2, axis=0), 3 * x[5:6]]))]
    odd = [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] + [1.0] * 23, 1), (903, [None] + [1.0] * 23, 1), (904, [float(v) for v in x[1]], None), (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (907, [], 1)]
    return rows + odd


def usable(v):
    return v and None not in v and np.isfinite(v).all() and np.any(v)


@pytest.fixture(scope="module")
def rows():
    return vectors()


def test_near_duplicates(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df.withColumn("cls", F.lit("clash"))).collect()}
    links = {i: set() for i, _, _ in rows}
    unit = {i: np.float64(np.float32(v)) / np.linalg.norm(np.float64(np.float32(v))) for i, v, _ in rows if usable(v)}
    for i, v, a in rows:
        for j, w, b in rows:
            if i < j and a is not None and a == b and i in unit and j in unit and len(v) == len(w) and unit[i] @ unit[j] >= 0.93:
                links[i].add(j)
                links[j].add(i)
    top = {i: i for i in links}
    for _ in links:
        for i, to in links.items():
            top[i] = min([top[i], *(top[j] for j in to)])
    assert got == {i: (len(to), top[i], top[i] == i) for i, to in links.items()}
    assert near_duplicates(df.limit(0)).count() == 0
    twice = near_duplicates(spark.createDataFrame([rows[0], rows[0]], SCHEMA)).collect()
    assert [(r["n_links"], r["kept"]) for r in twice] == [(0, True)]


@pytest.mark.parametrize("large", [32, 3])
def test_planted_links_near_the_threshold(spark, monkeypatch, large):
    """2,000 unrelated vectors of one label, 400 pairs at cosines from 0.90 to 0.99, and a family of 50 near copies."""
    monkeypatch.setattr("hindcast.llm.near_vectors.LARGE", large)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.standard_normal((400, 64))
    off -= (off * x[:400]).sum(axis=1, keepdims=True) * x[:400]
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    c = np.linspace(0.90, 0.99, 400)[:, None]
    family = x[1999] + 0.02 * rng.standard_normal((50, 64))
    y = np.float32(np.concatenate([x, c * x[:400] + np.sqrt(1 - c**2) * off, family]))
    got = {r["vec_id"]: r["n_links"] for r in near_duplicates(spark.createDataFrame([(i, [float(v) for v in r], 1) for i, r in enumerate(y)], SCHEMA)).collect()}
    u = np.float64(y)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93).sum(axis=1) - 1
    assert links.sum() > 3000
    missed = sum(int(links[i]) - n for i, n in got.items())
    assert all(n <= links[i] for i, n in got.items())
    assert missed <= 4  # of 3,100 ends of links, those at the very threshold
    assert all(got[i] == links[i] for i in range(200, 400))  # at 0.945 and above
    assert all(got[i] == 50 for i in [1999, *range(2400, 2450)])


def test_tables_grow_with_the_vectors():
    from hindcast.llm.near_vectors import _same_cell, shape

    for n in (10, 10**4, 10**8):
        tables, hashes = shape(n, 0.93)
        assert n * _same_cell(2**0.5) ** hashes < 1
        assert (1 - _same_cell(0.14**0.5) ** hashes) ** tables <= 0.001


def test_neighbours(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got: dict[int, list] = {}
    for r in nearest_neighbours(df.withColumn("rank", F.lit("clash")), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    unit = {i: np.float64(np.float32(v)) / np.linalg.norm(np.float64(np.float32(v))) for i, v, _ in rows if usable(v) and len(v) == 24}
    hits = 0
    assert set(got) == {i for i in unit if i % 50 == 0}
    for q, found in got.items():
        exact = sorted(((-(unit[q] @ w), i) for i, w in unit.items() if i != q))[:5]
        hits += len({i for _, i in exact} & {i for _, i, _ in found})
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(unit[q] @ unit[i], abs=1e-12) for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
    assert hits >= 0.9 * 5 * len(got)
    few = nearest_neighbours(spark.createDataFrame(rows[:4], SCHEMA), F.col("vec_id") % 50 == 0).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_codes_decide_and_recall_holds(spark, monkeypatch):
    """6,000 vectors with 600 near copies of one: distances by codes cut far below the vectors that are searched."""
    monkeypatch.setattr("hindcast.llm.neighbours.RERANK", 60)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((6000, 16))
    x[3000:3600] = x[0] + 0.02 * rng.standard_normal((600, 16))
    rows = [(i, [float(v) for v in r], None) for i, r in enumerate(x)] + [(50, [9.0] * 16, None)]
    got: dict[int, list] = {}
    for r in nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x[50] = min(list(np.float64(np.float32(x[50]))), [9.0] * 16)
    u = np.float64(np.float32(x))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = 0
    assert len(got) == 120
    for q, found in got.items():
        score = u @ u[q]
        score[q] = -2
        hits += len(set(np.lexsort((np.arange(len(u)), -score))[:5].tolist()) & found)
    assert hits >= 0.9 * 5 * 120


@pytest.mark.parametrize("most", [10**6, 0])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr("hindcast.llm.graph.TASK_EDGES", most)
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5100)] + [(None, 1), (2, None), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    top = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in range(120):
        for a, b in edges:
            if a in top and b in top:
                top[a] = top[b] = min(top[a], top[b])
    assert got == top
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
