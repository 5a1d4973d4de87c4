import base64
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hindcast.llm import bpe, kernels, mixing, pitman_yor, quality, seating, sharding, token_store
from hindcast.llm.shared import new_path
from hindcast.llm.shingle_join import shingle_classes
from hindcast.llm.substring_dedup import remove_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# ---------------------------------------------------------------- kernels


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="'sstrevdlm  \n\t é1٣!.AZ中", max_size=15), max_size=6))
def test_bpe_equals_the_library(texts):
    reference = test_bpe_equals_the_library.reference = getattr(test_bpe_equals_the_library, "reference", None) or tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(RANKS).rank, special_tokens={})
    ids, at = bpe._table(RANKS).encode_column(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [reference.encode_ordinary(t) for t in texts]
    data, _ = bpe.ranks(RANKS).decode(ids)
    assert data.tobytes() == "".join(texts).encode()


def test_words_and_hashes_of_slices():
    texts = ["a b", None, "", "  c d\n", "A B"]
    buf, off = kernels.text_buffer(pa.array(["x", *texts])[1:])
    s, e, at = kernels.words(buf, off)
    assert [[buf[s[k] : e[k]].tobytes().decode() for k in range(a, b)] for a, b in zip(at[:-1], at[1:], strict=True)] == [["a", "b"], [], [], ["c d"], ["A", "B"]]
    h = kernels.word_hashes(buf, s, e, lower=True)
    assert h[0] == h[3] and h[1] == h[4] and len(set(h.tolist())) == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500))
def test_directly_addressable_codes(ids):
    x = np.array(ids, np.uint32)
    levels = token_store.pack(x)
    assert (token_store.unpack(levels) == x).all()
    places = np.arange(len(x))[::-7]
    assert (token_store.at(levels, places) == x[places]).all()


# ---------------------------------------------------------------- token store, BPE


def test_token_store(spark, docs, rows, empty):
    path = new_path(spark, "tokens")
    token_store.write(docs, path, JSON, 0)
    got = {r["doc_id"]: r for r in token_store.read(spark, path).withColumn("crc", F.crc32("ids")).collect()}
    t = Tokenizer.from_file(JSON)
    every, start = [], 0
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["crc"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        every += ids
        start += len(ids)
    asked = [0, 5, len(every) - 1, len(every) // 2, len(every), -1, None, 5]
    found = token_store.lookup(spark, path, spark.createDataFrame([(p,) for p in asked], "position bigint"))
    assert {r["position"]: r["token_id"] for r in found.collect()} == {p: every[p] for p in asked if p is not None and 0 <= p < len(every)}
    other = new_path(spark, "tokens")
    token_store.write(empty, other, JSON, 0)
    assert token_store.read(spark, other).count() == 0


def test_added_tokens_in_texts_of_the_store(spark):
    end = "<|endoftext|>"
    texts = ["plain", f"a {end} b", end, f"{end}{end}", f"  {end}  x  ", f"don't{end}'s 1", "<|endoftext|", None, f"é{end}ü\n\n", f"<|endof{end}text|>", "after"]
    path = new_path(spark, "tokens")
    token_store.write(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1), path, JSON, 0)
    t, start = Tokenizer.from_file(JSON), 0
    for r in token_store.read(spark, path).orderBy("doc_id").collect():
        ids = [*t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0]
        assert (r["start"], np.frombuffer(r["ids"], "<u4").tolist()) == (start, ids)
        start += len(ids)


def test_null_and_repeated_ids_in_the_store(spark):
    path = new_path(spark, "tokens")
    token_store.write(spark.createDataFrame([(1, "b"), (None, "a"), (1, "b"), (2, None)], "doc_id bigint, text string"), path, JSON, 7)
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in token_store.read(spark, path).orderBy("start").collect()] == [(None, 0, 2), (1, 2, 2), (1, 4, 2), (2, 6, 1)]


def test_byte_bpe(clashing, rows, empty, reference):
    out = bpe.decode(bpe.encode(clashing, RANKS), RANKS)
    assert bpe.round_trip(clashing, RANKS).exceptAll(out).isEmpty()
    got = {r["doc_id"]: r for r in out.collect()}
    assert {"size", "group", "_key"} <= set(out.columns)
    for i, text in rows:
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == reference.encode_ordinary(text or "")
        assert bytes(got[i]["decoded"]) == (text or "").encode()
    assert bpe.decode(bpe.encode(empty, RANKS), RANKS).count() == 0


# ---------------------------------------------------------------- dedup


def kept_words(rows):
    seen, out = set(), {}
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_substring_dedup(clashing, rows, empty):
    out = remove_repeats(clashing)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()}
    assert got == kept_words(rows)
    assert sum(x[1] for x in got.values()) > 500
    assert remove_repeats(empty).count() == 0


def test_substring_dedup_of_null_and_repeated_ids(spark):
    text = " ".join(f"u{k}" for k in range(25))
    rows = [(5, text), (5, text), (None, text), (9, text + " more")]
    got = sorted((r["doc_id"] or -1, r["n_removed"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(-1, 25), (5, 0), (5, 0), (9, 25)]


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_shingle_join(docs, rows, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_classes(docs).collect()}
    assert got == components(rows)
    assert shingle_classes(empty).count() == 0


def test_shingle_join_finds_every_link_of_hard_families(spark):
    """Chains at the very threshold, and boilerplate that many share."""
    import random

    rng = random.Random(11)
    common = [f"c{k}" for k in range(40)]
    rows = [(k, " ".join([*common, *(f"d{rng.randrange(10**6)}" for _ in range(rng.choice([3, 5, 8, 13, 40])))])) for k in range(120)]
    base = [f"b{k}" for k in range(rng.randrange(8, 60))]
    for k in range(120, 180):
        base = [w if rng.random() > 0.03 else f"e{rng.randrange(10**6)}" for w in base] + ([f"t{k}"] if rng.random() < 0.3 else [])
        rows.append((k, " ".join(base)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == components(rows)


# ---------------------------------------------------------------- scores, mixing, shards


def test_language_model(docs, rows, empty, spark):
    got = {r["doc_id"]: r for r in pitman_yor.language_model_scores(docs).collect()}
    tokens = {i: [*WORD.findall((t or "").translate(LOWER)), "\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    count: dict[str, int] = {}
    for i, w in tokens.items():
        for x in w if not held[i] else []:
            count[x] = count.get(x, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, w in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(w), sum(x in count for x in w), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((count.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        assert r["score"] < 0
    assert pitman_yor.language_model_scores(empty).count() == 0
    # every row is a text of its own, without an id, with one that others have, and where it is repeated
    odd = [(None, "a"), (None, "b c"), (None, None), (7, "a b c"), (7, "d"), (7, "d"), (7, "d"), (8, "d")]
    each = pitman_yor.language_model_scores(spark.createDataFrame(odd, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in each) == sorted((i or 0, len((t or "").split()) + 1) for i, t in odd)
    same = {(round(r["base_score"], 6), round(r["score"], 6)) for r in each if r["doc_id"] in (7, 8) and r["n_tokens"] == 2}
    assert len(same) == 1


def test_language_model_learns_word_pairs(spark):
    """Words that follow one another in fixed pairs, where all first words end in the same byte."""
    import random

    rng = random.Random(2)
    text = lambda: " ".join(f"{k}x {k}y" for k in (rng.randrange(40) for _ in range(60)))
    rows = [(i, text()) for i in range(60)]
    broken = (1003, " ".join(f"{k}x {(k + 1) % 40}y" for k in range(40)))
    got = {r["doc_id"]: r for r in pitman_yor.language_model_scores(spark.createDataFrame([*rows, broken], "doc_id bigint, text string").repartition(3)).collect()}
    held = [r for i, r in got.items() if r["held_out"] and i < 1000]
    assert held
    for r in held:  # of two words, one follows from the other
        assert r["score"] > 0.65 * r["base_score"]
    assert got[1003]["held_out"] and got[1003]["score"] < got[1003]["base_score"]


def test_language_model_probabilities_add_up_to_one():
    totals = pitman_yor.Totals(100, 2, 0.5, 0.5, customers=5.0, tables=3.0)
    # two words with 3 and 2 customers at 2 and 1 tables of the parent, and the unknown; the first alone in a context
    root = totals.parent(np.array([3, 2, 0]), np.array([2, 1, 0]))
    assert root.sum() == pytest.approx(1)
    assert totals.predictive(np.array([10, 0, 0]), np.array([4, 0, 0]), np.full(3, 10.0), np.full(3, 4.0), root).sum() == pytest.approx(1)


def stirling(c, t, d):
    """Ways to seat c customers at t tables, each table of n customers weighing (1 - d) (2 - d) ... (n - 1 - d)."""
    row = [1.0]
    for n in range(1, c):
        row = [(row[k] * (n - d * (k + 1)) if k < len(row) else 0) + (row[k - 1] if k else 0) for k in range(n + 1)]
    return row[t - 1]


@pytest.mark.parametrize("c", [2, 3, 6, 20])
def test_tables_are_drawn_from_their_conditional(c):
    d, strength, p, n = 0.4, 3.0, 0.2, 200_000
    want = np.array([stirling(c, t, d) * p**t * np.prod([strength + d * k for k in range(t)]) for t in range(1, c + 1)])
    got = np.bincount(seating.sample_tables(np.full(n, c), np.full(n, strength), d, np.full(n, p), np.random.default_rng(3)), minlength=c + 1)[1:] / n
    assert np.abs(got - want / want.sum()).max() < 0.005


def test_tables_of_many_customers_are_drawn_alike():
    rng, n, c = np.random.default_rng(4), 1500, np.full(1500, seating.EXACT)
    for d, strength, p in ((0.5, 20.0, 0.1), (0.8, 500.0, 0.01), (0.3, 2.0, 0.5), (0.6, 3000.0, 0.3), (0.1, 1.0, 1e-6), (0.95, 1e6, 0.2)):
        exact, fast = (f(c, np.full(n, strength), d, np.full(n, p), rng) for f in (seating.sample_tables, seating.sample_large))
        assert fast.mean() == pytest.approx(exact.mean(), rel=0.03)
        assert fast.std() == pytest.approx(exact.std(), rel=0.1, abs=0.05)
    assert (seating.sample_tables(np.array([1, 1]), np.array([5.0, 5.0]), 0.5, np.array([0.5, 0.5]), rng) == 1).all()
    assert 1 <= seating.sample_large(np.array([10**8]), np.array([1e6]), 0.7, np.array([0.05]), rng)[0] <= 10**8


@pytest.mark.parametrize("bytes_of_a_bucket", [12 << 20, 40])
def test_language_model_where_seating_is_certain(spark, monkeypatch, bytes_of_a_bucket):
    """Every word once: each customer has a table of its own, and all probabilities follow by arithmetic. With small
    buckets, the context of first words is split over many."""
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", bytes_of_a_bucket)
    rows = [(i, " ".join(f"w{i}.{k}" for k in range(i % 4))) for i in range(30)]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    got = {r["doc_id"]: r for r in pitman_yor.language_model_scores(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    pairs: dict[tuple, int] = {}
    for i, t in rows:
        w = ["", *t.split(), ""]
        for pair in zip(w[:-1], w[1:], strict=True):
            pairs[pair] = pairs.get(pair, 0) + (not held[i])
    seen = {pair: c for pair, c in pairs.items() if c}
    assert {c for pair, c in seen.items() if pair != ("", "")} == {1}
    n, v = sum(seen.values()), len({b for _, b in seen})
    train = got[0]["train_tokens"]
    assert train == n
    # the empty text's pair alone has several customers; leave its tables out by looking at differences of other words
    c1 = {x: sum(c for (a, _), c in seen.items() if a == x) for x, _ in seen}
    for i, t in rows:
        r, w = got[i], t.split()
        assert r["n_tokens"] == len(w) + 1 and r["n_known"] == (len(w) + 1 if not held[i] else 1)
        if held[i]:  # unknown words score alike, and end follows each unknown context alike
            assert r["score"] < 0
    known = [got[i]["score"] for i, t in rows if not held[i] and len(t.split()) == 3]
    unknown = [got[i]["score"] for i, t in rows if held[i] and len(t.split()) == 3]
    assert max(known) - min(known) < 1e-6
    if len(unknown) > 1:
        assert max(unknown) - min(unknown) < 1e-6
    assert v and c1


def gibbs(docs, held, sweeps, burn_in, seed):
    """The same model in plain Python: single customers leave and come back, and predictive probabilities are averaged."""
    import random

    rng, theta = random.Random(seed), pitman_yor.THETA
    stream = {i: list(zip(["", *w], [*w, ""], strict=True)) for i, w in docs.items()}
    train = [pair for i, pairs in stream.items() if not held[i] for pair in pairs]
    count: dict[tuple, int] = {}
    for pair in train:
        count[pair] = count.get(pair, 0) + 1
    kinds: dict[str, int] = {}
    for _, b in count:
        kinds[b] = kinds.get(b, 0) + 1
    v = len(kinds)

    def discount(values):
        one, two = (sum(x == k for x in values) for k in (1, 2))
        return min(0.95, max(0.1, one / (one + 2 * two) if one else 0.5))

    d1, d0 = discount(count.values()), discount(kinds.values())
    seats: dict[tuple, list[int]] = {}  # of contexts: sizes of the tables of each dish
    roots: dict[str, list[int]] = {}
    tables, customers, root_tables, root_customers = {}, {}, [0], [0]

    def root_p(w):
        x = roots.get(w, [])
        return (sum(x) - d0 * len(x) + (theta + d0 * root_tables[0]) / (v + 1)) / (theta + root_customers[0])

    def sit(sizes, d, new):
        weights = [s - d for s in sizes] + [new]
        k = rng.choices(range(len(weights)), weights)[0]
        if k == len(sizes):
            sizes.append(1)
            return True
        sizes[k] += 1
        return False

    def leave(sizes):
        k = rng.choices(range(len(sizes)), sizes)[0]
        sizes[k] -= 1
        if not sizes[k]:
            del sizes[k]
            return True
        return False

    def root_add(w):
        root_tables[0] += sit(roots.setdefault(w, []), d0, (theta + d0 * root_tables[0]) / (v + 1))
        root_customers[0] += 1

    def root_drop(w):
        root_tables[0] -= leave(roots[w])
        root_customers[0] -= 1

    def add(pair):
        a, b = pair
        if sit(seats.setdefault(pair, []), d1, (theta + d1 * tables.get(a, 0)) * root_p(b)):
            tables[a] = tables.get(a, 0) + 1
            root_add(b)
        customers[a] = customers.get(a, 0) + 1

    for pair in train:
        add(pair)
    mean = dict.fromkeys({p for pairs in stream.values() for p in pairs}, 0.0)
    for s in range(sweeps):
        for pair in train:
            customers[pair[0]] -= 1
            if leave(seats[pair]):
                tables[pair[0]] -= 1
                root_drop(pair[1])
            add(pair)
        if s >= burn_in:
            for a, b in mean:
                x = seats.get((a, b), [])
                mean[a, b] += (sum(x) - d1 * len(x) + (theta + d1 * tables.get(a, 0)) * root_p(b)) / (theta + customers.get(a, 0)) / (sweeps - burn_in)
    return {i: sum(np.log10(mean[p]) for p in pairs) for i, pairs in stream.items()}


def test_language_model_equals_plain_gibbs_sampling(spark):
    import random

    rng = random.Random(9)
    docs = {i: rng.choices(["a", "b", "c", "d", "e", "f", *(f"r{k}" for k in range(40))], [9, 7, 5, 3, 2, 2, *[0.3] * 40], k=rng.randint(0, 25)) for i in range(50)}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    want = gibbs(docs, held, 400, 50, 1)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id bigint, text string").repartition(2)
    got = {r["doc_id"]: r for r in pitman_yor.language_model_scores(df.withColumns({"held": F.lit("x"), "_doc": F.lit(1)}), burn_in=3, samples=6).collect()}
    off = [got[i]["score"] - want[i] for i in docs]
    assert abs(sum(off)) / sum(r["n_tokens"] for r in got.values()) < 0.005  # of about 1.1 a token
    assert max(abs(x) / got[i]["n_tokens"] for i, x in zip(docs, off, strict=True) if len(docs[i]) >= 10) < 0.05


def test_quality_classifier(spark, empty):
    import random

    rng = random.Random(5)
    good = [" ".join(rng.choices(["the", "house", "is", "green,", "and", "people.", "walk"], k=rng.randint(3, 80))) for _ in range(150)]
    bad = [" ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in rng.choices(["the", "hou", "se"], k=rng.randint(3, 80))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(3, None), (None, 1), (7, 1)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    scored = quality.score(docs.withColumn("quality_score", F.lit("clash")), model)
    got = scored.withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    assert all((r["quality_score"] >= 0.5) == (r["doc_id"] < 150) for r in got)
    assert {r["held"] for r in got} == {True, False}
    assert [round(r["quality_score"], 6) for r in quality.score(docs, quality.fit(docs.repartition(7), labels)).orderBy("doc_id").collect()] == [round(r["quality_score"], 6) for r in sorted(got, key=lambda r: r["doc_id"])]
    nothing = quality.fit(docs, labels.limit(0))
    assert {r["quality_score"] for r in quality.score(docs, nothing).collect()} == {0.5}
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 100000)], "doc_id bigint, text string")
    assert all(0 <= r["quality_score"] <= 1 for r in quality.score(odd, model).collect())
    assert quality.score(empty, model).count() == 0


def test_mixing(clashing, rows, empty, spark):
    out = mixing.mix(clashing)
    got = out.collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(WORD.findall(t or "")) for i, t in rows}
    tokens = {(r["source"], r["lang"], r["topic"]): 0 for r in got}
    for r in got:
        tokens[r["source"], r["lang"], r["topic"]] += r["n_tokens"]
    for k, name in ((0, "source"), (2, "topic")):
        counted: dict[str, float] = {}
        for cell, n in tokens.items():
            counted[cell[k]] = counted.get(cell[k], 0) + n
        want = {c: n ** mixing.POWERS[name] for c, n in counted.items()}
        have: dict[str, float] = {}
        for r in got:
            have[r[name]] = have.get(r[name], 0) + r["n_tokens"] * r["factor"]
        for c, n in want.items():
            if counted[c]:
                assert have[c] / sum(h for k2, h in have.items() if counted[k2]) == pytest.approx(n / sum(x for k2, x in want.items() if counted[k2]), rel=1e-6)
    assert all(r["kept"] for r in got if r["probability"] == 1)
    assert [r["kept"] for r in out.orderBy("doc_id").collect()] == [r["kept"] for r in mixing.mix(clashing.repartition(3)).orderBy("doc_id").collect()]
    given = mixing.mix(clashing.drop("topic"), {"source": {"s0": 0.5, "s1": 0.25, "s2": 0.25}}, budget=1000.0)
    total = given.agg(F.sum(F.col("n_tokens") * F.col("probability"))).first()[0]
    assert total == pytest.approx(1000, rel=0.01)
    assert mixing.mix(empty).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert [r["kept"] for r in mixing.mix(nulls).collect()] in ([True, True], [False, False])


@pytest.mark.parametrize("most", [200_000, 5])
def test_mixing_equals_brute_force(clashing, docs, rows, monkeypatch, most):
    """Factors by raking in plain Python, probabilities, and the draw by Spark's hash; on the driver and on DataFrames."""
    monkeypatch.setattr(mixing, "MAX_CELLS", most)
    got = {r["doc_id"]: r for r in mixing.mix(clashing).collect()}
    cells: dict[tuple, int] = {}
    of = {}
    for i, t in rows:
        of[i] = (f"s{i % 3}", "en", got[i]["topic"])
        cells[of[i]] = cells.get(of[i], 0) + len(WORD.findall(t or ""))
    weight, total = {k: float(n) for k, n in cells.items()}, sum(cells.values())
    want = []
    for c, power in enumerate(mixing.POWERS[m] for m in mixing.MARGINS):
        by: dict[str, int] = {}
        for k, n in cells.items():
            by[k[c]] = by.get(k[c], 0) + n
        share = {v: n**power if n else 0 for v, n in by.items()}
        want.append({v: x / sum(share.values()) for v, x in share.items()})
    for _ in range(300):
        for c in range(3):
            now: dict[str, float] = {}
            for k, w in weight.items():
                now[k[c]] = now.get(k[c], 0) + w
            weight = {k: w * (want[c][k[c]] * total / now[k[c]] if now[k[c]] else 0) for k, w in weight.items()}
    factor = {k: weight[k] / n for k, n in cells.items() if n}
    # T: the largest at which values with too few tokens hold at most RARE of all
    counted = [{v: sum(n for k, n in cells.items() if k[c] == v) for v in want[c]} for c in range(3)]
    t_most = total
    for c in range(3):
        caps = {v: counted[c][v] / s for v, s in want[c].items() if s}
        t_most = min(t_most, max(cap for cap in caps.values() if sum(counted[c][v] for v, x in caps.items() if x < cap) <= mixing.RARE * total))
    sums = []
    for c in range(3):
        low, high = 0.0, 1e12  # the rate at which values, none above its tokens, sum to T
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(counted[c][v], s * mid) for v, s in want[c].items()) < t_most else (low, mid)
        sums.append({v: min(counted[c][v], s * high) for v, s in want[c].items()})
    fixed = {k for k in cells if any(sums[c][k[c]] >= counted[c][k[c]] - 1e-6 for c in range(3))}
    kept = {k: float(n) for k, n in cells.items()}
    for _ in range(300):
        for c in range(3):
            now, left = {}, dict(sums[c])
            for k, w in kept.items():
                if k in fixed:
                    left[k[c]] -= cells[k]
                else:
                    now[k[c]] = now.get(k[c], 0) + min(w, cells[k])
            kept = {k: w if k in fixed else w * (max(left[k[c]], 0) / now[k[c]] if now[k[c]] else 0) for k, w in kept.items()}
    for i, r in got.items():
        k = of[i]
        draw = (xxhash.xxh64_intdigest(b"mix", xxhash.xxh64_intdigest(str(i).encode(), 42)) >> 11) / 2**53
        want_p = min(kept[k], cells[k]) / cells[k] if cells[k] else 1.0
        assert (r["factor"], r["probability"]) == (pytest.approx(factor.get(k, 1.0), rel=1e-6), pytest.approx(want_p, abs=1e-5))
        assert r["kept"] == (draw < r["probability"])


@pytest.mark.parametrize("most", [200_000, 5])
def test_kept_shares_are_the_targets(spark, monkeypatch, most):
    """On a skewed corpus every value that has the tokens has its share of what is expected to be kept, and so have the
    drawn documents, up to chance."""
    monkeypatch.setattr(mixing, "MAX_CELLS", most)
    rng = np.random.default_rng(3)
    rows, signs = [], ["", " ||" * 40, " 12345" * 30]
    for i in range(6000):
        source = "hot" if rng.random() < 0.4 else f"s{rng.integers(12)}"
        lang = ["en", "de", "fr"][0 if rng.random() < 0.8 else int(rng.integers(1, 3))]
        rows.append((i, "w " * int(rng.integers(20, 80)) + signs[0 if rng.random() < 0.85 else int(rng.integers(1, 3))], lang, source))
    rows += [(7000, "w w", "xx", "tiny"), (7001, "w", None, None)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).cache()
    total = out.agg(F.sum(F.col("n_tokens") * F.col("probability")), F.sum("n_tokens")).first()
    assert 0.5 < total[0] / total[1] < 0.95
    for c in mixing.MARGINS:
        values = out.groupBy(F.coalesce(c, F.lit(""))).agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("probability")).alias("e"), F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("k")).collect()
        power = {r[0]: r["t"] ** mixing.POWERS[c] for r in values}
        for r in values:
            target = power[r[0]] / sum(power.values())
            if r["t"] >= 0.005 * total[1]:
                assert r["e"] / total[0] == pytest.approx(target, rel=0.01)
                assert r["k"] / sum(x["k"] for x in values) == pytest.approx(target, abs=0.02)
            else:
                assert r["e"] == pytest.approx(r["t"], rel=1e-3)  # all it has


def test_rare_sources_do_not_decide_how_much_is_kept(spark):
    def share(rows):
        out = mixing.mix(spark.createDataFrame([(i, "w " * n, "en", s) for i, (s, n) in enumerate(rows)], "doc_id bigint, text string, lang string, source string"))
        return out.agg(F.sum(F.col("n_tokens") * F.col("probability")) / F.sum("n_tokens")).first()[0], out

    usual = [("hot", 500)] * 190 + [(f"s{k}", 500) for k in range(19) for _ in range(20)]
    before, _ = share(usual)
    after, out = share([*usual, ("tiny", 1), (None, 2), (None, 1)])
    assert before == pytest.approx(0.84, abs=0.01) and after == pytest.approx(before, abs=0.01)
    assert {r["source"]: r["probability"] for r in out.select("source", "probability").distinct().collect() if r["source"] in ("tiny", None)} == {"tiny": 1.0, None: 1.0}


def shard_rows(df, **more):
    return sharding.assign_shards(df, F.xxhash64("text"), F.octet_length("text") + 1, ["doc_id"], **more)


@pytest.mark.parametrize("hot", [1715669780721960923, -(2**62) - 12345, 7])
def test_a_hot_key_is_dealt_over_many_ranges(spark, hot):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, hot).otherwise(F.xxhash64("id")).alias("k"), F.lit(10).alias("bytes"))
    ranges = sharding.ranged(rows, F.col("k"), F.col("bytes"), ["doc_id"], ranges=256)
    counts = {r["_range"]: (r["n"], r["hot"]) for r in ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") == hot).alias("hot")).collect()}
    assert max(n for n, _ in counts.values()) < 5 * 30_000 / 256
    assert sum(h > 0 for _, h in counts.values()) > 60
    placed = sharding.assign_shards(rows, F.col("k"), F.col("bytes"), ["doc_id"], ranges=256)
    shards = {r["shard"]: (r["n"], r["hot"]) for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") == hot).alias("hot")).collect()}
    assert all(abs(n - 1875) <= 1 for n, _ in shards.values())
    assert sum(h > 0 for _, h in shards.values()) <= 7  # copies stay side by side


def test_sharding(clashing, spark, empty):
    many = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE repeat(cast(id AS string), 1 + cast(id % 50 AS int)) END AS text")
    got = shard_rows(many, ranges=64).collect()
    assert len(got) == 4000
    by = {k: [r for r in got if r["shard"] == k] for k in range(16)}
    sizes = [sum(r["size"] for r in by[k]) for k in range(16)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by.values())
    hot = {r["shard"] for r in got if r["text"] == "hot"}
    assert len(hot) < 16 and sum(r["text"] == "hot" for r in got) == 1334
    odd = shard_rows(clashing)
    assert odd.count() == clashing.count() and {"fp", "group", "shard", "slot"} <= set(odd.columns)
    assert shard_rows(empty).count() == 0
    same = shard_rows(spark.createDataFrame([(None, None)] * 5 + [(1, "a")] * 5, "doc_id bigint, text string"))
    assert same.count() == 10 and same.select("shard", "slot").distinct().count() == 10
    plan = odd._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_pipeline_stages(spark, docs, rows, tmp_path):
    import corpus_pipeline as p

    labels = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id bigint, quality int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = docs
    for name, stage in p.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == p.COLUMNS, name
    near = p.near_duplicates(spark, docs, str(tmp_path))
    tops = components(rows)
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(i for i, (n, top) in tops.items() if top == i)
    clean = {r["doc_id"]: r["text"] for r in p.substring_dedup(spark, docs, str(tmp_path)).collect()}
    assert clean == {i: (kept_words(rows)[i][2] if kept_words(rows)[i][1] else t) for i, t in rows}
    # rows of one id go or stay by their own texts; repeated rows, null ids, an empty table and extra columns
    twice = [(1, rows[60][1]), (2, rows[61][1]), (2, "a text of its own " * 9), (3, "once more"), (3, "once more"), (None, rows[62][1]), (None, None), (4, None), (5, "")]
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in twice], docs.schema).withColumns({"fp": F.lit(1), "kept": F.lit("x"), "size": F.lit(2)})
    left = sorted((str(r["doc_id"]), r["text"] or "") for r in p.near_duplicates(spark, odd, str(tmp_path)).collect())
    assert left == sorted([("1", rows[60][1]), ("2", twice[2][1]), ("3", "once more"), ("None", rows[62][1]), ("None", ""), ("4", ""), ("5", "")])
    for table in (odd, odd.limit(0)):
        for name, stage in p.STAGES:
            out = stage(spark, table, str(tmp_path))
            assert out.count() <= table.count() and (name == "byte_bpe" or out.columns == p.COLUMNS)
    out = p.run(spark, str(tmp_path)).collect()
    assert out and all(r["round_trip"] for r in out) and len({r["doc_id"] for r in out}) == len(out)
    assert hashlib.sha256(bytes(out[0]["ids"])).digest()


def test_the_work_of_a_block_does_not_grow_with_the_buckets():
    """Anchors of one block, dealt to few and to very many buckets: the same entries in about the same time."""
    import time

    from hindcast.llm import substring_dedup as sd

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 400)) for _ in range(300)]
    texts += texts[:20]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "_key": pa.array(range(len(texts)), pa.int64())})
    took, entries = {}, {}
    for buckets in (8, 16_000, 60_000):
        began = time.perf_counter()
        rows = [r for b in sd._anchor_blocks([batch], buckets) for r in b.to_pylist()]
        took[buckets] = time.perf_counter() - began
        entries[buckets] = sum(len(r["entries"]) for r in rows)
        assert len({r["bucket"] for r in rows}) <= buckets
    assert len(set(entries.values())) == 1
    assert took[60_000] < 2.5 * took[16_000] + 1 and took[16_000] < 60


def test_a_full_word_table_keeps_what_comes_again():
    from hindcast.llm.wordpieces import WordTable

    asked = []

    def encode(words):
        asked.extend(words)
        return np.fromiter((b for w in words for b in w), np.uint32), np.array([len(w) for w in words])

    table = WordTable(encode, limit=40)
    for k in range(26):
        texts = ["the cat", *[f"q{chr(97 + k)}{chr(97 + i)}" for i in range(9)], None, f"the {chr(97 + k)}q"]
        ids, edge = table.encode_column(pa.array(texts, pa.string()))
        assert [bytes(ids[a:b].tolist()).decode() for a, b in zip(edge, edge[1:])] == [t or "" for t in texts]
        assert len(table.index) <= 40
    assert asked.count(b"the") == asked.count(b" cat") == 1 and len(asked) > 80
