"""Mixing sources to target weights: iterative proportional fitting.

Documents fall into cells of (source, language, topic). The cells' token counts are raked, margin by margin, until the
shares of sources, languages and topics are the targets; a cell's ``factor`` is its raked over its counted tokens.

What is kept is raked once more within bounds, as no document can be kept more than once: of a total T of tokens, each
value is to have its share, or all its tokens where these are less (the others then share the rest in proportion), and
no cell more than it has. A cell's ``probability`` is its bounded over its counted tokens, so the expected tokens of the
sample have the target shares but for values that lack the tokens. T is a budget, or as much as the values can give:
those that would lack tokens at T hold no more than ``RARE`` of all, so that no rare value decides how much is kept. The
draw is a hash of the id: the same at every run and on any cluster.

Up to ``MAX_CELLS`` cells are raked on the driver, and their factors broadcast; more of them are raked by grouped sums
on DataFrames, by the same rules.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.shared import Scratch, written

#: Cells (sources x languages x topics) that are collected and whose factors are broadcast.
MAX_CELLS = 200_000
MARGINS = ["source", "lang", "topic"]
ROUNDS, CLOSE = 200, 1e-10
#: Share of all tokens whose values may be kept whole because they have less than their target share.
RARE = 0.005
#: The same for raking within bounds, and how far above its tokens a cell may be raked there.
BOUNDED_CLOSE, MOST_OVER = 1e-7, 1e6
#: Sources are evened out most.
POWERS = {"source": 0.7, "lang": 0.9, "topic": 0.9}
SPACES = "[ \\t\\n\\x0B\\f\\r]+"


def token_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda w: w != "")), F.lit(0)).cast("bigint")


def topic(text: Column, tokens: Column) -> Column:
    """A coarse kind of text by its characters: table, shout, noise, figures, long or prose; ``empty`` without words."""

    signs = F.regexp_replace(text, "[^0-9|#$%&*]+", "")  # short, so that it costs little to count in it

    def count(chars: str) -> Column:
        return F.length(signs) - F.length(F.translate(signs, chars, ""))

    return (
        F.when(tokens == 0, "empty")
        .when(count("|") * 5 > tokens, "table")
        .when(F.length(text) - F.length(F.replace(text, F.lit("!!"), F.lit(""))) > tokens, "shout")
        .when(count("#$%&*") > tokens, "noise")
        .when(count("0123456789") * 2 > tokens, "figures")
        .when(tokens > 1000, "long")
        .otherwise("prose")
    )


def tempered(tokens: pd.Series, power: float) -> pd.Series:
    """Shares proportional to a power of the tokens: less than 1 lifts what is rare."""
    t = tokens.astype(float).clip(lower=0) ** power * (tokens > 0)
    return t / t.sum() if t.sum() else t


def rake(cells: pd.DataFrame, targets: dict[str, pd.Series]) -> np.ndarray:
    """Factors of the cells, of which ``tokens`` is the counted weight: after them, each margin has its target shares.

    Targets are brought to a sum of 1 over the values that have tokens; a value without a target gets nothing. If
    the targets contradict each other on the cells that exist, the factors are those of the last round.
    """
    counted = cells["tokens"].to_numpy(float)
    if not len(counted):
        return counted
    weight, total = counted.copy(), counted.sum()
    margins = []
    for column, target in targets.items():
        code, values = pd.factorize(cells[column], use_na_sentinel=False)
        share = np.array([float(target.get(v, 0.0)) for v in ("" if pd.isna(v) else v for v in values)]) * (np.bincount(code, counted, len(values)) > 0)
        margins.append((code, share / share.sum() if share.sum() else share))
    for _ in range(ROUNDS):
        worst = 0.0
        for code, share in margins:
            now = np.bincount(code, weight, len(share))
            step = np.divide(share * total, now, out=np.zeros(len(share)), where=now > 0)
            worst = max(worst, np.abs(now - share * total).max() / max(total, 1))
            weight = weight * step[code]
        if worst < CLOSE:
            break
    return np.divide(weight, counted, out=np.zeros(len(counted)), where=counted > 0)


def _total(tokens: np.ndarray, share: np.ndarray) -> float:
    """The largest T at which the values that lack tokens for their share hold at most ``RARE`` of all tokens."""
    some = (tokens > 0) & (share > 0)
    most, held = tokens[some] / share[some], tokens[some]
    order = np.argsort(most, kind="stable")
    most, held = most[order], held[order]
    lacking = (np.cumsum(held) - held)[np.searchsorted(most, most)]  # tokens of the values that give less
    return float(min(most[lacking <= RARE * tokens.sum()].max(initial=0.0), tokens[some].sum()))


def _bounded(tokens: np.ndarray, share: np.ndarray, total: float) -> np.ndarray:
    """Tokens by value: in proportion to the shares, none more than it has, together ``total`` (or all there are)."""
    whole = np.zeros(len(tokens), bool)
    while True:
        free = share[~whole].sum()
        rate = (total - tokens[whole].sum()) / free if free else 0.0
        more = ~whole & (share * rate >= tokens) & (share > 0)
        if not more.any():
            return np.where(whole, tokens, share * max(rate, 0.0))
        whole |= more


def bounded_rake(tokens: np.ndarray, margins: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights of cells, none above its tokens, whose sums by each margin (codes, wanted sums) are as wanted.

    Cells of a value that is wanted whole are whole; the others are raked to what is left."""
    fixed = np.zeros(len(tokens), bool)
    for code, want in margins:
        fixed |= (want >= np.bincount(code, tokens, len(want)) * (1 - 1e-12))[code]
    free, weight = np.where(fixed, 0.0, tokens), np.where(fixed, 0.0, tokens)
    left = [(code, np.maximum(want - np.bincount(code, tokens - free, len(want)), 0.0)) for code, want in margins]
    for _ in range(ROUNDS):
        worst = 0.0
        for code, want in left:
            now = np.bincount(code, np.minimum(free, weight), len(want))
            weight = np.minimum(weight * np.divide(want, now, out=np.zeros(len(want)), where=now > 0)[code], MOST_OVER * free)
            worst = max(worst, np.abs(now - want).max(initial=0.0) / max(tokens.sum(), 1))
        if worst < BOUNDED_CLOSE:
            break
    return np.where(fixed, tokens, np.minimum(free, weight))


def _few(cells: DataFrame, targets: dict[str, dict[str, float]] | None, powers: dict[str, float], budget: float | None) -> DataFrame:
    """Factors and probabilities of up to ``MAX_CELLS`` cells."""
    rows = cells.toPandas().sort_values(MARGINS).reset_index(drop=True)
    tokens = rows["tokens"].to_numpy(float)
    wanted = {c: pd.Series(targets[c], dtype=float) if targets and c in targets else tempered(rows.groupby(c)["tokens"].sum(), powers[c]) for c in MARGINS}
    factor = rake(rows, wanted)
    margins = []
    for c in MARGINS:
        code, values = pd.factorize(rows[c], use_na_sentinel=False)
        counted = np.bincount(code, tokens, len(values))
        share = np.array([float(wanted[c].get(v, 0.0)) for v in values]) * (counted > 0)
        margins.append((code, counted, share / share.sum() if share.sum() else share))
    total = min([budget if budget is not None else np.inf, *[_total(t, s) if budget is None else t[s > 0].sum() for _, t, s in margins]])
    weight = bounded_rake(tokens, [(code, _bounded(t, s, total)) for code, t, s in margins])
    rows["factor"] = np.where(tokens > 0, factor, 1.0)
    rows["probability"] = np.divide(weight, tokens, out=np.ones(len(rows)), where=tokens > 0)
    out = [tuple(r) for r in rows[[*MARGINS, "factor", "probability"]].itertuples(index=False)]
    return F.broadcast(cells.sparkSession.createDataFrame(out, ", ".join(f"{c} string" for c in MARGINS) + ", factor double, probability double"))


def _raked(scratch: Scratch, cells: DataFrame, want: str, most: Column, close: float, name: str) -> DataFrame:
    """``weight`` of the cells, raked from ``free`` to the sums in ``{want}_{margin}`` by grouped sums: each margin's step
    is a join with its values, and each round is written."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    cells = cells.withColumn("weight", F.col("free"))
    for k in range(ROUNDS):
        worst = []
        for c in MARGINS:
            now = cells.groupBy(c).agg(F.sum(F.least("weight", most)).alias("now"), F.max(f"{want}_{c}").alias("want"))
            worst.append(F.abs(F.col("now") - F.col("want")))
            step = now.select(c, worst[-1].alias(f"off_{c}"), F.when(F.col("now") > 0, F.col("want") / F.col("now")).otherwise(0.0).alias("step"))
            cells = cells.drop(f"off_{c}").join(step, c).withColumn("weight", F.least(F.col("weight") * F.col("step"), most * MOST_OVER)).drop("step")
        cells = scratch.written(cells, f"{name}-{k}")
        if k:
            scratch.drop(f"{name}-{k - 1}")
        if (cells.agg(F.max(F.greatest(*[f"off_{c}" for c in MARGINS]))).first()[0] or 0) < close * max(total, 1):
            break
    return cells.withColumn("weight", F.least("weight", most)).drop(*[f"off_{c}" for c in MARGINS])


def _many(cells: DataFrame, targets: dict[str, dict[str, float]] | None, powers: dict[str, float], budget: float | None) -> DataFrame:
    """The same on DataFrames. What one task holds is at most a row for each value of a margin."""
    spark = cells.sparkSession
    with Scratch(spark, "mixing") as scratch:
        every = float(cells.agg(F.sum("tokens")).first()[0] or 0)
        margins: dict[str, DataFrame] = {}
        totals = [every if budget is None else budget]
        for c in MARGINS:
            by = cells.groupBy(c).agg(F.sum("tokens").cast("double").alias("t"))
            if targets and c in targets:
                given = spark.createDataFrame([(k, float(v)) for k, v in targets[c].items()], f"{c} string, s double")
                by = by.join(given, c, "left").select(c, "t", F.when(F.col("t") > 0, F.coalesce("s", F.lit(0.0))).otherwise(0.0).alias("s"))
            else:
                by = by.withColumn("s", F.when(F.col("t") > 0, F.pow("t", F.lit(powers[c]))).otherwise(0.0))
            by = scratch.written(by, f"values-{c}")
            shares = float(by.agg(F.sum("s")).first()[0] or 1)
            margins[c] = by.withColumn("s", F.col("s") / shares)
            some = margins[c].where("t > 0 and s > 0").withColumn("most", F.col("t") / F.col("s"))
            totals.append(float(some.agg(F.sum("t")).first()[0] or 0))
            if budget is None:
                by_most = some.groupBy("most").agg(F.sum("t").alias("t"))
                lower = F.coalesce(F.sum("t").over(Window.orderBy("most").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
                totals.append(float(by_most.withColumn("lacking", lower).where(F.col("lacking") <= RARE * every).agg(F.max("most")).first()[0] or 0))
        total = min(totals)
        for c, by in margins.items():
            whole = F.lit(False)
            rate = 0.0
            while True:
                sums = by.agg(F.sum(F.when(~whole, F.col("s"))).alias("free"), F.sum(F.when(whole, F.col("t"))).alias("whole")).first()
                free, held = float(sums["free"] or 0), float(sums["whole"] or 0)
                rate = (total - held) / free if free else 0.0
                more = (F.col("s") * rate >= F.col("t")) & (F.col("s") > 0)
                if not by.where(~whole & more).limit(1).count():
                    break
                whole = whole | more
            bounded = F.when(whole, F.col("t")).otherwise(F.col("s") * max(rate, 0.0))
            cells = cells.join(by.select(c, (F.col("s") * every).alias(f"share_{c}"), bounded.alias(f"kept_{c}"), (bounded >= F.col("t") * (1 - 1e-12)).alias(f"whole_{c}")), c)
        cells = scratch.written(cells.withColumn("free", F.col("tokens").cast("double")), "cells")
        raked = _raked(scratch, cells, "share", F.lit(float("inf")), CLOSE, "factors").withColumnRenamed("weight", "raked")
        fixed = F.col("whole_source") | F.col("whole_lang") | F.col("whole_topic")
        raked = raked.withColumn("free", F.when(fixed, 0.0).otherwise(F.col("tokens").cast("double")))
        for c in MARGINS:
            held = raked.groupBy(c).agg(F.sum(F.col("tokens") - F.col("free")).alias("held"))
            raked = raked.join(held, c).withColumn(f"kept_{c}", F.greatest(F.col(f"kept_{c}") - F.col("held"), F.lit(0.0))).drop("held")
        kept = _raked(scratch, scratch.written(raked, "left"), "kept", F.col("free"), BOUNDED_CLOSE, "probabilities")
        some = F.col("tokens") > 0
        share = F.when(fixed, 1.0).otherwise(F.col("weight") / F.col("tokens"))
        return scratch.result(kept.select(*MARGINS, F.when(some, F.col("raked") / F.col("tokens")).otherwise(1.0).alias("factor"), F.when(some, share).otherwise(1.0).alias("probability")))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, powers: dict[str, float] = POWERS, budget: float | None = None, seed: str = "mix", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``topic``, ``factor``, ``probability`` and ``kept`` to ``docs(doc_id, text, source, lang)``.

    ``targets`` gives shares by value for "source", "lang" and "topic"; a margin that is not given is tempered: its
    shares are proportional to its tokens to the power in ``powers``. Null sources and languages count as the
    empty string. With ``budget``, so many tokens are kept in expectation (or all that the targets allow). Documents without words have no
    weight and are kept. Repeated rows are drawn alike; a null id is drawn as the empty string. A very long text is one
    document of its cell, counted whole. Other columns are kept; those with the new names are replaced. An empty table
    gives an empty one.
    """
    tokens = token_count(F.col(text))
    counted = docs.withColumn("n_tokens", tokens).withColumn("topic", topic(F.coalesce(F.col(text), F.lit("")), F.col("n_tokens")))
    counted = counted.withColumns({f"_{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang")})
    keys = ["_source", "_lang", "topic"]
    cells = written(counted.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")).withColumnsRenamed({"_source": "source", "_lang": "lang"}), "cells")
    small = (_few if cells.count() <= MAX_CELLS else _many)(cells, targets, powers, budget).withColumnsRenamed({"source": "_source", "lang": "_lang"})
    drawn = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(seed)), 11) / F.lit(float(1 << 53))
    out = counted.drop("factor", "probability", "kept").join(small, keys).withColumn("kept", drawn < F.col("probability"))
    new = ["n_tokens", "topic", "factor", "probability", "kept"]
    return out.select(*[c for c in docs.columns if c not in new], *new)
