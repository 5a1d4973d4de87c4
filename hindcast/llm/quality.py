"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over at most ``BINS`` bins, learnt by cyclic boosting: round after round, feature by
feature, a tree of at most four leaves is fitted to the gradient of the logistic loss and added, shrunk, to the table.
Then the pairs of features that explain most of what is left get two-way tables in the same way. A score is the
logistic function of the sum of table entries.

Features are computed from the text alone. The model is fitted on a sample of labelled rows of bounded size
(``SAMPLE_ROWS``, documented and drawn by a hash of the id); every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.llm.kernels import slices, text_buffer, word_hashes, words

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 200, 60, 0.1, 2.0
FEATURES = ("words", "bytes_a_word", "upper", "digits", "symbols", "bars", "bangs", "stops", "commas", "lines", "beyond_ascii", "ends_in_symbol", "distinct_words", "short_words", "long_words", "longest_word")

_KINDS = [
    np.isin(np.arange(256), np.frombuffer(chars, np.uint8))
    for chars in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*+/<=>@\\^_`{}~[]", b"|", b"!", b".", b",", b"\n", bytes(range(128, 192)))
]
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"!#$%&*+/<=>@\\^_`{}~[]|", np.uint8))


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text; an empty or null text has zeros."""
    buf, off = text_buffer(column)
    starts, ends, of_text = words(buf, off)
    n, size = np.diff(of_text), np.diff(off)
    some = np.maximum(n, 1).astype(float)
    text = np.repeat(np.arange(len(n)), n)
    length = ends - starts

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(text, weights=values, minlength=len(n))

    counts = []
    for kind in _KINDS:
        total = np.concatenate([[0], np.cumsum(kind[buf], dtype=np.int64)])
        counts.append(total[off[1:]] - total[off[:-1]])
    order = np.lexsort((word_hashes(buf, starts, ends), text))
    h, t = word_hashes(buf, starts, ends)[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    distinct = np.bincount(t[new], minlength=len(n))
    longest = np.zeros(len(n))
    np.maximum.at(longest, text, length.astype(float))
    upper, digits, symbols, bars, bangs, stops, commas, lines, beyond = counts
    share = np.maximum(size, 1)
    columns = [np.log1p(n), per_text(length) / some, upper / share, digits / share, symbols / share, bars / some, bangs / some, stops / some, commas / some, lines / some, beyond / share]
    columns += [per_text(_SYMBOL[buf[ends - 1]]) / some if len(ends) else np.zeros(len(n)), distinct / some, per_text(length <= 3) / some, per_text(length >= 12) / some, np.log1p(longest)]
    return np.stack(columns, axis=1)


@dataclass
class Model:
    base: float
    edges: list[np.ndarray]  # of the bins of each feature
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]  # features, and their table over coarse bins

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def coarse(self, bins: np.ndarray) -> np.ndarray:
        """Bins for tables of pairs: those of each feature in ``PAIR_BINS`` even parts, or one by one if they are few."""
        n = np.array([len(e) + 1 for e in self.edges])
        return np.where(n <= PAIR_BINS, bins, bins * PAIR_BINS // np.maximum(n, 1))

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            total += t[b[:, j]]
        coarse = self.coarse(b)
        for i, j, t in self.pairs:
            total += t[coarse[:, i], coarse[:, j]]
        return 1 / (1 + np.exp(-total))


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Where to cut a row of gradient and curvature sums in two, and the gain."""
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = a**2 / (b + RIDGE) + (g.sum() - a) ** 2 / (h.sum() - b + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    k = int(np.argmax(gain)) if len(gain) else 0
    return k + 1, float(gain[k]) if len(gain) else 0.0


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + RIDGE))


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A piecewise constant step over bins with at most ``2 ** depth`` pieces."""
    k, gain = _split(g, h)
    if not depth or gain <= 1e-9:
        return np.full(len(g), _leaf(g, h))
    return np.concatenate([_tree(g[:k], h[:k], depth - 1), _tree(g[k:], h[k:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A cut along one feature, then one along the other on either side; and its gain."""
    best = None
    for flip in (False, True):
        G, H = (g.T, h.T) if flip else (g, h)
        k, _ = _split(G.sum(axis=1), H.sum(axis=1))
        out, gain = np.zeros_like(G), -(g.sum() ** 2) / (h.sum() + RIDGE)
        for rows in (slice(0, k), slice(k, None)):
            cut, _ = _split(G[rows].sum(axis=0), H[rows].sum(axis=0))
            for columns in (slice(0, cut), slice(cut, None)):
                out[rows, columns] = _leaf(G[rows, columns], H[rows, columns])
                gain += G[rows, columns].sum() ** 2 / (H[rows, columns].sum() + RIDGE)
        if best is None or gain > best[1]:
            best = (out.T if flip else out, gain)
    return best


def _edges(x: np.ndarray) -> np.ndarray:
    """Edges of a feature's bins: its most frequent value has a bin of its own, quantiles of the others make the rest."""
    if not len(x):
        return np.zeros(0)
    values, count = np.unique(x, return_counts=True)
    mode = values[count.argmax()]
    rest = x[x != mode]
    even = np.quantile(rest, np.arange(1, BINS - 2) / (BINS - 2)) if len(rest) else np.zeros(0)
    return np.unique(np.concatenate([even, [mode, np.nextafter(mode, np.inf)]]))


def fit_rows(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit features and labels (0 or 1). Without rows, or with one label only, the model is a constant."""
    rate = (y.sum() + 1) / (len(y) + 2)
    edges = [_edges(x[:, j]) for j in range(len(FEATURES))]
    model = Model(float(np.log(rate / (1 - rate))), edges, [np.zeros(BINS) for _ in FEATURES], [])
    if len(np.unique(y)) < 2:
        return model
    b, total = model.bins(x), np.full(len(y), model.base)

    def sums(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)

    for _ in range(ROUNDS):
        for j in range(len(FEATURES)):
            step = RATE * _tree(*sums(b[:, j], BINS))
            model.tables[j] += step
            total += step[b[:, j]]
    coarse = model.coarse(b)
    cell = {(i, j): coarse[:, i] * PAIR_BINS + coarse[:, j] for i in range(len(FEATURES)) for j in range(i)}
    shape = (PAIR_BINS, PAIR_BINS)
    gains = {p: _pair_tree(*(s.reshape(shape) for s in sums(c, PAIR_BINS**2)))[1] for p, c in cell.items()}
    model.pairs = [(i, j, np.zeros(shape)) for i, j in sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            step = RATE * _pair_tree(*(s.reshape(shape) for s in sums(cell[i, j], PAIR_BINS**2)))[0]
            table += step
            total += step.ravel()[cell[i, j]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows from which no label is learnt."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, label)``, by at most ``sample_rows`` labelled rows that are
    not held out. Null labels and ids are left out; with repeated labels of a document, the larger one counts, and of
    repeated rows of a document the one with the least features. Null and empty texts have zeros. Other columns of both tables are not looked at;
    empty tables give a constant model."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = features(part.column("text"))
                rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_y"), rows], ["doc_id", "_y", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "_y", "text").mapInArrow(task, T.StructType([docs.schema["doc_id"], T.StructField("_y", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))]))
    # repeated documents count once, so that the driver gets sample_rows rows of numbers at most
    got = rows.groupBy("doc_id").agg(F.min("x").alias("x"), F.max("_y").alias("_y")).toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["x"].to_list(), float).reshape(-1, len(FEATURES))
    return fit_rows(x, got["_y"].to_numpy(float))


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "quality_score") -> DataFrame:
    """Replace or add the column ``to``: 0 to 1, higher for better texts. Null texts count as empty."""
    kept = [c for c in docs.columns if c != to]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(model.score(features(part.column(text))))], [*kept, to])

    return docs.mapInArrow(task, T.StructType([*[docs.schema[c] for c in kept], T.StructField(to, T.DoubleType())]))
