"""Language-model scores by a hierarchical Pitman-Yor model.

A token is drawn in the restaurant of its context, the word before it (by its 48-bit hash; the end of a text stands
before the next one's first word). All context restaurants share one parent, the restaurant of words without context,
whose parent is the uniform distribution over the known words and one unknown word. Customers of a dish sit at tables,
and each table is a customer in the parent restaurant.

Seating is sampled by Gibbs sweeps. Contexts are dealt to buckets by a hash (a very frequent one over several buckets,
by its words), and words to parts by theirs. In a sweep, the buckets seat the customers of their contexts anew, given
the parent's probabilities; the parts then seat the tables of all contexts anew in the parent. After ``BURN_IN``
sweeps, each of ``SAMPLES`` sweeps is a sample, and a token's probability is the mean of its predictive probabilities
under the samples.

Bucketed tables hold what does not change (pairs with their counts; words with the buckets that ask for them), so that
only sums by word travel between sweeps.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.llm.kernels import mix, slices, text_buffer, word_hashes, words
from hindcast.llm.seating import sample_tables, sweep
from hindcast.llm.shared import Scratch, shuffles_cleared

#: Tokens of a block, text bytes of a bucket and of a group of documents; buckets, and parts of the words, at least.
BLOCK_TOKENS, BUCKET_BYTES, GROUP_BYTES, BUCKETS, PARTS = 3 << 18, 8 << 20, 24 << 20, 24, 8
#: A pair is frequent, or a context is very frequent, only if it makes one of so many tokens: that bounds how many there are.
FREQUENT, HOT = 1 << 18, 1 << 18
BURN_IN, SAMPLES, THETA = 2, 3, 1.0
_U = np.uint64
MASK = _U((1 << 48) - 1)
END = _U(0x0123456789ABCDEF) & MASK
_FIXED = float(1 << 30)  # log10 probabilities travel as multiples of 2 ** -30


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and contexts of all tokens of some texts, and the number of tokens of each: its words and one end."""
    buf, off = text_buffer(column)
    starts, ends, at = words(buf, off)
    h = np.insert(word_hashes(buf, starts, ends, lower=True) & MASK, at[1:], END)
    return h, np.concatenate([np.array([END], _U), h[:-1]])[: len(h)], np.diff(at) + 1


def pair_keys(h: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    return mix(mix(h ^ _U(0x2545F491)) ^ ctx)


# ---------------------------------------------------------------- messages

_KINDS = [pa.int32(), pa.string(), pa.int32(), *[pa.binary()] * 5, pa.float64(), pa.float64()]
_NAMES = ["key", "kind", "part", "a", "b", "c", "d", "e", "x", "y"]
MESSAGE = "key int, kind string, part int, a binary, b binary, c binary, d binary, e binary, x double, y double"


def put(x: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, from the lowest one to the last that is not all zeros; the number of both before them."""
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8).T
    k = 8
    while k and not planes[k - 1].any():
        k -= 1
    return (len(x) * 16 + k).to_bytes(8, "little") + planes[:k].tobytes()


def length(b: bytes) -> int:
    return int.from_bytes(b[:8], "little") // 16


def get(b: bytes | None) -> np.ndarray:
    if b is None:
        return np.zeros(0, _U)
    n, k = divmod(int.from_bytes(b[:8], "little"), 16)
    out = np.zeros((n, 8), np.uint8)
    out[:, :k] = np.frombuffer(b, np.uint8, k * n, 8).reshape(k, n).T
    return out.view("<u8").ravel()


def counts_of(b: bytes | None) -> np.ndarray:
    return get(b).astype(np.int64)


def message(key: int, kind: str, part: int | None = None, *arrays: bytes, x: float | None = None, y: float | None = None) -> tuple:
    return (key, kind, part, *arrays, *[None] * (5 - len(arrays)), x, y)


def table_of(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(_KINDS)], _NAMES)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_KINDS)], _NAMES)


def by_kind(*tables: pa.Table) -> dict[str, list[dict]]:
    out = defaultdict(list)
    for t in tables:
        for row in t.select([c for c in _NAMES if c in t.column_names]).to_pylist():
            out[row["kind"]].append(row)
    for found in out.values():
        found.sort(key=lambda r: -1 if r["part"] is None else r["part"])
    return out


def joined(found: list[dict], column: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *[counts_of(r[column]) for r in found]])


# ---------------------------------------------------------------- totals


@dataclass(frozen=True)
class Deal:
    """How contexts go to buckets: very frequent ones (sorted) are split by their words."""

    buckets: int
    hot: np.ndarray
    splits: np.ndarray

    def __call__(self, h: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        at = mix(ctx ^ _U(0x51ED270B)) >> _U(33)
        if len(self.hot):
            k = np.minimum(np.searchsorted(self.hot, ctx), len(self.hot) - 1)
            some = np.flatnonzero(self.hot[k] == ctx)
            at[some] += (mix(h[some] ^ _U(0x7FEB352D)) >> _U(33)) % self.splits[k[some]]
        return at % _U(self.buckets)


@dataclass(frozen=True)
class Totals:
    """What all buckets share."""

    n: int  # training tokens
    v: int  # different ones
    d1: float  # discounts of the contexts and of their parent
    d0: float
    customers: float = 0.0  # of the parent
    tables: float = 0.0
    hot_customers: np.ndarray | None = None  # of the very frequent contexts
    hot_tables: np.ndarray | None = None

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probability of words with so many customers and tables in it."""
        return (customers - self.d0 * tables + (THETA + self.d0 * self.tables) / (self.v + 1)) / (THETA + self.customers)

    def predictive(self, c: np.ndarray, t: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Probabilities of pairs with c customers at t tables, in contexts with so many in all."""
        return (c - self.d1 * t + (THETA + self.d1 * tables) * parent) / (THETA + customers)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


# ---------------------------------------------------------------- counting


def _blocks(batches: Iterable[pa.RecordBatch], *more: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Tokens and contexts of about ``BLOCK_TOKENS`` tokens of whole texts, and the named columns for each token."""
    held: list[tuple[np.ndarray, ...]] = []
    total = 0
    for batch in batches:
        for part in slices(batch, "text"):
            h, ctx, n = tokens(part.column("text"))
            held.append((h, ctx, *[np.repeat(part.column(c).to_numpy(zero_copy_only=False), n) for c in more]))
            total += len(h)
            if total >= BLOCK_TOKENS:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, total = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _often(batches: Iterable[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Contexts with half of a share of a block's tokens or more."""
    for (_, ctx) in _blocks(batches):
        cell = ctx & _U((1 << 20) - 1)  # only contexts in full cells can be frequent
        u, n = np.unique(ctx[np.bincount(cell.view(np.int64), minlength=1 << 20)[cell] * 2 >= share * len(ctx)], return_counts=True)
        some = n * 2 >= share * len(ctx)
        yield pa.RecordBatch.from_arrays([pa.array(u[some].view(np.int64)), pa.array(n[some])], ["ctx", "n"])


def _edges(sorted_values: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_values, np.arange(n + 1, dtype=sorted_values.dtype))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, values.dtype)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _count_blocks(batches: Iterable[pa.RecordBatch], deal: Deal) -> Iterator[pa.RecordBatch]:
    """Pairs of all documents with their training counts, which are 0 for pairs of held-out documents alone."""
    for h, ctx, held in _blocks(batches, "held"):
        b = deal(h, ctx)
        order = np.lexsort((h, (b << _U(40)) | (ctx >> _U(8))))  # contexts that differ in the last 8 bits alone may mingle
        h, ctx, b, one = h[order], ctx[order], b[order], (~held[order].astype(bool)).astype(np.int64)
        new = _starts(b, ctx, h)
        count, h, ctx, b = _sums(one, new), h[new], ctx[new], b[new]
        edge, rows = _edges(b, deal.buckets), []
        for k in np.flatnonzero(np.diff(edge)).tolist():
            some = slice(edge[k], edge[k + 1])
            first = _starts(ctx[some])
            rows.append(message(k, "cell", None, put(h[some]), put(ctx[some][first]), put(_sizes(first, edge[k + 1] - edge[k])), put(count[some])))
        yield batch_of(rows)


def _merge(table: pa.Table) -> pa.Table:
    """One bucket's pairs by context: its words, its contexts with their number of pairs, the pairs' words and counts.

    ``x`` and ``y`` are the pairs with one and with two customers; ``part`` is not used."""
    cells = table.to_pylist()
    h = np.concatenate([get(r["a"]) for r in cells])
    ctx = np.concatenate([np.repeat(get(r["b"]), counts_of(r["c"])) for r in cells])
    count = np.concatenate([counts_of(r["d"]) for r in cells])
    order = np.lexsort((h, ctx))
    h, ctx, count = h[order], ctx[order], count[order]
    new = _starts(ctx, h)
    count, h, ctx = _sums(count, new), h[new], ctx[new]
    first = _starts(ctx)
    known, ref = np.unique(h, return_inverse=True)
    row = message(cells[0]["key"], "pairs", None, put(known), put(ctx[first]), put(_sizes(first, len(ctx))), put(ref), put(count), x=float((count == 1).sum()), y=float((count == 2).sum()))
    return table_of([row])


@dataclass
class Pairs:
    """One bucket's pairs, sorted by context and word."""

    key: int
    words: np.ndarray
    ctx: np.ndarray
    of: np.ndarray  # the context of each pair
    ref: np.ndarray  # its word
    c: np.ndarray  # its customers

    @classmethod
    def read(cls, row: dict) -> Pairs:
        ctx = get(row["b"])
        return cls(row["key"], get(row["a"]), ctx, np.repeat(np.arange(len(ctx)), counts_of(row["c"])), counts_of(row["d"]), counts_of(row["e"]))

    def hot(self, deal: Deal) -> tuple[np.ndarray, np.ndarray]:
        """Places of the very frequent contexts here, and their numbers."""
        if not len(deal.hot) or not len(self.ctx):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(deal.hot, self.ctx), len(deal.hot) - 1)
        some = np.flatnonzero(deal.hot[k] == self.ctx)
        return some, k[some]

    def sum(self, values: np.ndarray, everywhere: np.ndarray | None, deal: Deal) -> np.ndarray:
        """Sums by context; those of very frequent contexts, which other buckets share, are ``everywhere``."""
        out = np.bincount(self.of, values, len(self.ctx))
        some, number = self.hot(deal)
        if len(some) and everywhere is not None:
            out[some] = everywhere[number]
        return out

    def tables(self, seats: dict | None) -> np.ndarray:
        """Tables of each pair: one where it has customers, unless a sweep gave more to those with two or more."""
        t = (self.c > 0).astype(np.int64)
        if seats is not None:
            t[self.c > 1] = counts_of(seats["a"])
        return t

    def hot_row(self, values: np.ndarray, deal: Deal) -> list[tuple]:
        some, number = self.hot(deal)
        return [message(-1, "hot", None, put(number), put(np.bincount(self.of, values, len(self.ctx))[some]))] if len(some) else []


def _part_edges(sorted_words: np.ndarray, bits: int) -> np.ndarray:
    """Where the parts of some sorted words start: a part has the words with the same upper bits."""
    return np.searchsorted(sorted_words, np.arange((1 << bits) + 1, dtype=_U) << _U(48 - bits))


def _ask(batches: Iterable[pa.RecordBatch], bits: int, deal: Deal) -> Iterator[pa.RecordBatch]:
    """One bucket's words by part, with their training counts and numbers of contexts."""
    for batch in batches:
        for row in batch.to_pylist():
            p = Pairs.read(row)
            count, kinds = (np.bincount(p.ref, x, len(p.words)) for x in (p.c, p.c > 0))
            edge = _part_edges(p.words, bits)
            cut = [slice(a, b) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            yield batch_of([message(k, "ask", p.key, put(p.words[s]), put(count[s]), put(kinds[s])) for k, s in enumerate(cut) if s.stop > s.start] + p.hot_row(p.c, deal))


def _vocabulary(table: pa.Table) -> pa.Table:
    """One part's words: counts, numbers of contexts, and which words each bucket asks for, bucket after bucket.

    ``x`` and ``y`` are the tokens and the different words of the part; words with one and two contexts are in a row of
    their own, as are the answers to the buckets: their words' counts."""
    if table["key"][0].as_py() < 0:
        return table  # customers of very frequent contexts
    asked = by_kind(table)["ask"]
    key = asked[0]["key"]
    known, ref = np.unique(np.concatenate([get(r["a"]) for r in asked]), return_inverse=True)
    count, kinds = (np.bincount(ref, joined(asked, c), len(known)).astype(np.int64) for c in ("b", "c"))
    size = np.array([length(r["a"]) for r in asked])
    edge = np.concatenate([[0], np.cumsum(size)])
    rows = [message(key, "words", None, put(kinds), put(ref), put(np.array([r["part"] for r in asked])), put(size), x=float(count.sum()), y=float((count > 0).sum()))]
    rows.append(message(key, "kinds", None, x=float((kinds == 1).sum()), y=float((kinds == 2).sum())))
    rows += [message(r["part"], "known", key, put(count[ref[a:b]])) for r, a, b in zip(asked, edge[:-1], edge[1:], strict=True)]
    return table_of(rows)


# ---------------------------------------------------------------- Gibbs sweeps


def _seat_parent(words_row: pa.Table, rest: pa.Table, totals: Totals, seed: tuple[int, int]) -> pa.Table:
    """One part's words seated in the parent, given the tables of all contexts; and what its buckets asked for."""
    if not words_row.num_rows:
        return table_of([])
    row, found = words_row.to_pylist()[0], by_kind(rest)
    kinds, ref, parts, size = (counts_of(row[c]) for c in ("a", "b", "c", "d"))
    customers = np.bincount(ref, joined(found["up"], "a"), len(kinds)).astype(np.int64) if found["up"] else kinds
    t = counts_of(found["state"][0]["a"]) if found["state"] else (customers > 0).astype(np.int64)
    some = np.flatnonzero(customers)
    others = THETA + totals.d0 * np.maximum(totals.tables - t[some], 0)
    t[some] = sample_tables(customers[some], others, totals.d0, np.full(len(some), 1 / (totals.v + 1)), np.random.default_rng((*seed, 0, row["key"])))
    edge = np.concatenate([[0], np.cumsum(size)])
    rows = [message(row["key"], "state", None, put(t), x=float(customers.sum()), y=float(t.sum()))]
    rows += [message(int(k), "down", row["key"], put(customers[ref[a:b]]), put(t[ref[a:b]])) for k, a, b in zip(parts, edge[:-1], edge[1:], strict=True)]
    return table_of(rows)


def _seat_contexts(pairs: pa.Table, rest: pa.Table, totals: Totals, deal: Deal, bits: int, seed: tuple[int, int]) -> pa.Table:
    """One bucket's customers seated anew, given the parent; and the new tables by word and of very frequent contexts."""
    if not pairs.num_rows:
        return table_of([])
    p, found = Pairs.read(pairs.to_pylist()[0]), by_kind(rest)
    parent = totals.parent(joined(found["down"], "a"), joined(found["down"], "b"))
    t = p.tables(found["seat"][0] if found["seat"] else None)
    more = np.flatnonzero(p.c > 1)
    tables = p.sum(t, totals.hot_tables, deal)
    t[more] = sweep(p.of[more], p.c[more], t[more], tables, THETA, totals.d1, parent[p.ref[more]], np.random.default_rng((*seed, 1, p.key)))
    sums, edge = np.bincount(p.ref, t, len(p.words)), _part_edges(p.words, bits)
    rows = [message(p.key, "seat", None, put(t[more]))]
    rows += [message(k, "up", p.key, put(sums[edge[k] : edge[k + 1]])) for k in np.flatnonzero(np.diff(edge)).tolist()]
    return table_of(rows + p.hot_row(t, deal))


# ---------------------------------------------------------------- scores


def _probabilities(p: Pairs, found: dict[str, list[dict]], samples: list[Totals], deal: Deal) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair, the word's training count and log10 of the mean of its predictive probabilities."""
    mean = np.zeros(len(p.c))
    for k, totals in enumerate(samples):
        t = p.tables(found[f"seat{k}"][0] if found[f"seat{k}"] else None)
        parent = totals.parent(joined(found[f"down{k}"], "a"), joined(found[f"down{k}"], "b"))
        customers, tables = p.sum(p.c, totals.hot_customers, deal), p.sum(t, totals.hot_tables, deal)
        mean += totals.predictive(p.c, t, customers[p.of], tables[p.of], parent[p.ref]) / len(samples)
    return joined(found["known"], "a")[p.ref], np.log10(mean)


class Lookup:
    """Scores of some pairs and the counts of their words, found by key."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, scores: np.ndarray, totals: Totals):
        order = np.argsort(keys, kind="stable")
        self.keys, self.known, self.score = keys[order], counts[order] > 0, scores[order]
        self.base = np.log10((counts[order] + 0.5) / (totals.n + 0.5 * (totals.v + 1)))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each pair, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def sums(self, doc: np.ndarray, number: np.ndarray, docs: int) -> list[np.ndarray]:
        """Known tokens, base scores and scores of documents 0 to ``docs - 1``, from tokens that were found."""
        return [np.bincount(doc, x[number], docs) for x in (self.known, self.base, self.score)]


def _frequent(pairs: pa.Table, rest: pa.Table, samples: list[Totals], deal: Deal) -> pa.Table:
    """The frequent pairs of one bucket: keys, counts of their words, and scores."""
    if not pairs.num_rows:
        return table_of([])
    p = Pairs.read(pairs.to_pylist()[0])
    some = p.c * FREQUENT > samples[0].n
    count, score = _probabilities(p, by_kind(rest), samples, deal)
    return table_of([message(p.key, "frequent", None, put(pair_keys(p.words[p.ref[some]], p.ctx[p.of[some]])), put(count[some]), score[some].astype("<f8").tobytes())])


def _put_sums(docs: np.ndarray, n: np.ndarray, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> list[bytes]:
    """Sums by document, for documents in ascending order."""
    return [put(np.diff(docs, prepend=np.int64(0)).view(_U)), put(n), put(known), put(np.rint(-base * _FIXED)), put(np.rint(-score * _FIXED))]


def _ask_blocks(batches: Iterable[pa.RecordBatch], deal: Deal, frequent: Lookup) -> Iterator[pa.RecordBatch]:
    """Tokens to be scored, by the bucket of their pair; those of frequent pairs are scored here. One of a block's rows
    carries the sums of these, with the number of all tokens of each of its documents."""
    for h, ctx, doc in _blocks(batches, "_doc"):
        key, b = pair_keys(h, ctx), deal(h, ctx)
        docs, doc, n = np.unique(doc, return_inverse=True, return_counts=True)
        number = frequent.find(key)
        there = number >= 0
        own = frequent.sums(doc[there], number[there], len(docs))
        key, doc, b = key[~there] >> _U(8), doc[~there], b[~there]
        order = np.argsort((b << _U(40)) | (key >> _U(16)))  # keys that differ in the last 16 bits alone may mingle
        key, doc, edge, rows = key[order], doc[order], _edges(b[order], deal.buckets), []
        for k in np.flatnonzero(np.diff(edge)).tolist():
            x, d = key[edge[k] : edge[k + 1]], doc[edge[k] : edge[k + 1]]
            first = _starts(x)
            here = np.zeros(len(docs), bool)
            here[d] = True
            rows.append(message(k, "asked", None, put(x[first]), put(_sizes(first, len(x))), put((np.cumsum(here) - 1)[d]), put(np.diff(docs[here], prepend=np.int64(0)).view(_U))))
        yield batch_of([*rows, message(int(docs[0]) % deal.buckets, "own", None, *_put_sums(docs, n, *own))])


def _answer(pairs: pa.Table, rest: pa.Table, samples: list[Totals], deal: Deal, groups: int) -> pa.Table:
    """Sums by document of one bucket's tokens, and of those that blocks scored themselves."""
    found = by_kind(rest)
    out: dict[int, list[tuple]] = defaultdict(list)

    def send(docs: np.ndarray, *sums: np.ndarray) -> None:
        group = docs % groups
        for g in np.unique(group).tolist():
            out[g].append(tuple(x[group == g] for x in (docs, *sums)))

    if pairs.num_rows and found["asked"]:
        p = Pairs.read(pairs.to_pylist()[0])
        lookup = Lookup(pair_keys(p.words[p.ref], p.ctx[p.of]) >> _U(8), *_probabilities(p, found, samples, deal), samples[0])
        held = []
        for row in found["asked"]:
            docs = np.cumsum(get(row["d"])).view(np.int64)
            number = np.repeat(lookup.find(get(row["a"])), counts_of(row["b"]))
            held.append((docs, *lookup.sums(counts_of(row["c"]), number, len(docs))))
        doc, known, base, score = (np.concatenate(x) for x in zip(*held, strict=True))
        docs, of = np.unique(doc, return_inverse=True)
        send(docs, np.zeros(len(docs)), *[np.bincount(of, x, len(docs)) for x in (known, base, score)])
    for row in found["own"]:
        docs = np.cumsum(get(row["a"])).view(np.int64)
        send(docs, counts_of(row["b"]), counts_of(row["c"]), counts_of(row["d"]) / -_FIXED, counts_of(row["e"]) / -_FIXED)
    rows = []
    for g, held in out.items():
        doc, *sums = (np.concatenate(x) for x in zip(*held, strict=True))
        docs, of = np.unique(doc, return_inverse=True)
        rows.append(message(int(g), "sums", None, *_put_sums(docs, *[np.bincount(of, x, len(docs)) for x in sums])))
    return table_of(rows)


def _finish(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    docs, of = np.unique(np.concatenate([np.cumsum(get(r["a"])).view(np.int64) for r in rows]), return_inverse=True)
    n, known, base, score = (np.bincount(of, joined(rows, c), len(docs)) for c in "bcde")
    return pa.table({"_doc": pa.array(docs), "n_tokens": n.astype(np.int64), "n_known": known.astype(np.int64), "base_score": -base / _FIXED, "score": -score / _FIXED})


def language_model_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The model learns from all documents that are not held out and scores all. A-Z are lower-cased; tokens are the words
    ``[^\\x20\\x09-\\x0D]+`` and one end; a null or empty text is one end. ``score`` is the log10 probability of the whole
    text; ``base_score`` that of a unigram model with 0.5 added to each count. Each row is a text of its own, also where
    several share a doc_id or have none; sums are kept by a hash of id and text, so equal rows are scored together and
    have equal scores. A very long text is handled whole. An empty table gives an empty one. With no training tokens at all
    every token has the uniform probability. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(doc_id).cast("bigint"), F.col(text)).alias("_doc"), held_out(F.col(doc_id)).alias("held"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, size // BUCKET_BYTES + 1)
    bits = max(PARTS.bit_length() - 1, (buckets // 8).bit_length())
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // GROUP_BYTES + 1)
    with Scratch(spark, "pitman-yor") as scratch:
        # contexts that fill more than a fourth of a bucket
        share = max(1 / HOT, 1 / (4 * buckets))
        often = rows.select("text").mapInArrow(lambda b: _often(b, share), "ctx bigint, n bigint").groupBy("ctx").agg(F.sum("n").alias("n")).toPandas()  # 2 * HOT rows at most
        all_tokens = max(size / 6, float(often["n"].sum()), 1.0)
        often = often[often["n"] >= share * all_tokens].sort_values("ctx", key=lambda c: c.astype("uint64"))
        deal = Deal(buckets, often["ctx"].to_numpy(np.int64).view(_U), np.minimum(buckets, np.ceil(often["n"].to_numpy(float) / (share * all_tokens))).astype(_U))

        counted = rows.select("held", "text").mapInArrow(lambda b: _count_blocks(b, deal), MESSAGE)
        pairs = scratch.bucketed(counted.repartition(buckets, "key").groupBy("key").applyInArrow(_merge, MESSAGE), "key", buckets, "pairs")
        asks = pairs.mapInArrow(lambda b: _ask(b, bits, deal), MESSAGE)
        heard = scratch.written(asks.groupBy("key").applyInArrow(_vocabulary, MESSAGE), "answers")
        vocabulary = scratch.bucketed(heard.where("kind = 'words'").repartition(1 << bits, "key"), "key", 1 << bits, "words")
        nothing = spark.createDataFrame([], MESSAGE)

        def sums(df: DataFrame, kind: str) -> tuple[float, float]:
            got = df.where(F.col("kind") == kind).agg(F.sum("x"), F.sum("y")).first()
            return float(got[0] or 0), float(got[1] or 0)

        def of_hot(df: DataFrame) -> np.ndarray | None:
            """Sums of the very frequent contexts over the buckets that share them."""
            if not len(deal.hot):
                return None
            found = df.where("kind = 'hot'").select("a", "b").toArrow().to_pylist()
            return np.bincount(joined(found, "a"), joined(found, "b"), len(deal.hot))

        def discount(one: float, two: float) -> float:
            return float(np.clip(one / (one + 2 * two) if one else 0.5, 0.1, 0.95))

        n, v = sums(heard, "words")
        totals = Totals(int(n), int(v), discount(*sums(pairs, "pairs")), discount(*sums(heard, "kinds")), tables=v, hot_customers=of_hot(heard))

        def asked_of(df: DataFrame, others: list[DataFrame]) -> tuple:
            rest = others[0]
            for o in others[1:]:
                rest = rest.unionByName(o)
            return df.groupBy("key").cogroup(rest.groupBy("key"))

        def kinds(df: DataFrame, *kind: str) -> DataFrame:
            return df.where(F.col("kind").isin(*kind))

        def parent(totals: Totals, k: int, seats: DataFrame | None, before: DataFrame | None) -> tuple[DataFrame, Totals]:
            told = [*([kinds(seats, "up")] if seats is not None else []), *([kinds(before, "state")] if before is not None else [])]
            out = scratch.written(asked_of(vocabulary, told or [nothing]).applyInArrow(lambda w, r: _seat_parent(w, r, totals, (seed, k)), MESSAGE), f"parent{k}")
            customers, tables = sums(out, "state")
            return out, replace(totals, customers=customers, tables=tables)

        def contexts(totals: Totals, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
            return lambda p, r: _seat_contexts(p, r, totals, deal, bits, (seed, k))

        roots, totals = parent(totals, 0, None, None)
        seats, kept = None, []
        for k in range(1, burn_in + samples + 1):
            told = [kinds(roots, "down"), *([kinds(seats, "seat")] if seats is not None else [])]
            seats = scratch.written(asked_of(pairs, told).applyInArrow(contexts(totals, k), MESSAGE), f"seats{k}")
            roots, totals = parent(replace(totals, hot_tables=of_hot(seats)), k, seats, roots)
            if k > burn_in:
                kept.append((seats, roots, totals))
            if k <= burn_in + 1:  # what came before is no sample and has been read
                scratch.drop(f"parent{k - 1}")
                scratch.drop(f"seats{k - 1}")
        final = [t for _, _, t in kept]
        model = [kinds(heard, "known")]
        for k, (s, r, _) in enumerate(kept):
            model += [kinds(s, "seat").withColumn("kind", F.lit(f"seat{k}")), kinds(r, "down").withColumn("kind", F.lit(f"down{k}"))]
        with shuffles_cleared(spark):
            found = asked_of(pairs, model).applyInArrow(lambda p, r: _frequent(p, r, final, deal), MESSAGE).select("a", "b", "c").toArrow().to_pylist()  # FREQUENT pairs at most
        scores = np.concatenate([np.zeros(0), *[np.frombuffer(r["c"], "<f8") for r in found]])
        frequent = spark.sparkContext.broadcast(Lookup(np.concatenate([np.zeros(0, _U), *[get(r["a"]) for r in found]]), joined(found, "b"), scores, totals))
        asked = rows.select("_doc", "text").mapInArrow(lambda b: _ask_blocks(b, deal, frequent.value), MESSAGE)
        answers = asked_of(pairs, [*model, asked]).applyInArrow(lambda p, r: _answer(p, r, final, deal, groups), MESSAGE)
        out = answers.groupBy("key").applyInArrow(_finish, "_doc bigint, n_tokens bigint, n_known bigint, base_score double, score double")
        # sums of equal rows have come together: each row has its part of them
        times = rows.groupBy("_doc", "doc_id").agg(F.count(F.lit(1)).alias("times"))
        whole = [F.expr(f"{c} div times").alias(c) for c in ("n_tokens", "n_known")]
        out = times.join(out, "_doc").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))
        out = out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *whole, F.lit(int(n)).cast("bigint").alias("train_tokens"), *[(F.col(c) / F.col("times")).alias(c) for c in ("base_score", "score")])
        return scratch.result(out)
