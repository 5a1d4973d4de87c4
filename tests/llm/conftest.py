import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns with names that operators use inside.
EXTRA = {"size": "1", "shard": "'x'", "fp": "2", "_key": "'k'", "_doc": "3", "group": "'g'", "ids": "'i'", "kept": "true", "n_tokens": "4", "topic": "'t'", "quality_score": "0.5", "n_words": "9", "x": "7"}


def prose(rng, n, words=None):
    words = words or [f"w{i}" for i in range(3000)]
    return " ".join(rng.choices(words, k=n))


def corpus(seed=3):
    """Exact copies, near copies, shared passages, odd texts: (doc_id, text)."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(5, 120)) for _ in range(60)]
    base = prose(rng, 200)
    passage = prose(rng, 55)
    for k in range(12):
        w = base.split(" ")
        w[10 + 13 * k] = f"edit{k}"
        texts.append(" ".join(w))
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(10)]
    texts += [texts[0], texts[0], texts[5].upper(), "", None, " \t\n", "one", "one", "two words", "a b c d", "a b c d e", "é ü ß " * 30, "x" * 5000, "no-break space stays", "same " * 60, " ".join(["loop a b c d e f"] * 40), prose(rng, 20000)]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    return docs.selectExpr("*", *[f"{v} AS {k}" for k, v in EXTRA.items()])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
