"""Exact percentiles of groups of any size, by narrowing histograms.

The value at a rank is looked for in rounds: each counts the rows of equal parts of the range that is left, for all
groups in one aggregate, and goes on with the part that holds the rank. A part's range is that of its own rows, so far
outliers cost one round. Groups of which no more than ``SORTED`` rows are left are finished by sorting these rows; those
that start so small take Spark's own percentile. What a task holds is bounded by the parts of its groups and by
``SORTED``, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group that one task may sort, and parts of a round.
SORTED, PARTS = 1 << 16, 1 << 10
#: Searches (two a group at most) that are sent to all tasks; more of them are joined by key, hot groups in salted parts.
MOST_SENT, SALTS = 100_000, 32


def _part(value: Column, low: Column, high: Column) -> Column:
    """The part of a value: never falls while values rise, and the ends are in different parts. Halves do not overflow."""
    share = (value / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0))
    return F.when(value == high, PARTS - 1).when(share.isNull(), 0).otherwise(F.least(F.floor(share * (PARTS - 1)), F.lit(PARTS - 2))).cast("int")


def _found(rows: DataFrame, searches: DataFrame, many: bool) -> DataFrame:
    """The rows in the range of each search of their group."""
    if many:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int"))
        searches = searches.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = rows.join(searches, ["_g", "_salt"])
    else:
        both = rows.join(F.broadcast(searches), "_g")
    return both.where(F.col("_v").between(F.col("_low"), F.col("_high")))


def settled(searches: DataFrame) -> tuple[DataFrame, int]:
    """The searches without the plan that found them, and their number: few ones come to the driver, more are written to
    Spark's checkpoint folder."""
    rows = searches.limit(MOST_SENT + 1).collect()
    if len(rows) <= MOST_SENT:
        return searches.sparkSession.createDataFrame(rows, searches.schema), len(rows)
    written = searches.checkpoint()
    return written, written.count()


def sent(small: DataFrame) -> DataFrame:
    """A table for the small side of a join: sent to all tasks if it has no more than ``MOST_SENT`` rows, which is
    counted, and joined by its keys otherwise."""
    rows, n = settled(small)
    return F.broadcast(rows) if n <= MOST_SENT else rows


def finite(value: Column) -> Column:
    """A value as a double, or null where it is NaN or infinite."""
    v = value.cast("double")
    return F.when(F.abs(v) <= 1.7976931348623157e308, v)


def largest_group(df: DataFrame, by: list[str]) -> int:
    """The rows of the largest group."""
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def exact_percentile(df: DataFrame, by: list[str], value: Column, q: float, name: str = "percentile", sorted_rows: int = SORTED) -> DataFrame:
    """``(*by, name)``: the value at rank ``q * (n - 1)`` of each group, between its neighbours in proportion.

    Null, NaN and infinite values are left out; a group without others has null. Null keys are a group, an empty table
    gives no rows (also without keys). Rounds are run when this is called; the last pass, one for all groups, is lazy."""
    if not 0 <= q <= 1:
        raise ValueError(f"not a share: {q}")
    rows = df.select(F.struct(F.lit(0), *by).alias("_g"), finite(value).alias("_v"))
    columns = [F.col("_g")[c].alias(c) for c in by]
    few = F.col("n") <= sorted_rows
    stats = rows.groupBy("_g").agg(F.count("_v").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    groups, n = settled(stats.where(~few))
    # Spark's own percentile holds the values of a group: it is for groups of which that is little
    small = rows.join(F.broadcast(groups) if n <= MOST_SENT else groups, "_g", "left_anti") if n else rows
    small = small.groupBy("_g").agg(F.percentile("_v", q).alias(name))
    if not n:
        return small.select(*columns, name) if by else small.where(F.col("_g").isNotNull()).select(name)
    rows = rows.where("_v is not null")
    at = F.lit(q) * (F.col("n") - 1)
    ranks = F.array_distinct(F.array(F.floor(at), F.ceil(at)))
    # rank: of those that are left, 0 for the least
    searches = groups.select("_g", F.explode(ranks).alias("target"), F.col("n").alias("left"), "_low", "_high").withColumn("rank", F.col("target"))
    large = (F.col("_low") < F.col("_high")) & (F.col("left") > sorted_rows)
    ended = searches.where(~large)
    open_, n = settled(searches.where(large))
    while n:
        inside = _found(rows, open_, n > MOST_SENT)
        parts = inside.groupBy("_g", "target", "rank", _part(F.col("_v"), F.col("_low"), F.col("_high")).alias("part")).agg(F.count(F.lit(1)).alias("left"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        upto = F.sum("left").over(Window.partitionBy("_g", "target").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        chosen = parts.withColumn("upto", upto).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("left")))
        state, _ = settled(chosen.select("_g", "target", "left", "_low", "_high", (F.col("rank") - (F.col("upto") - F.col("left"))).alias("rank")))
        ended = ended.unionByName(state.where(~large))
        open_, n = settled(state.where(large))
    # both ranks of a group are mostly in one range: it is sorted once
    ended, n = settled(ended.groupBy("_g", "_low", "_high").agg(F.collect_list(F.struct("rank", "target")).alias("wanted")))
    inside = _found(rows, ended.where("_low < _high"), n > MOST_SENT)
    placed = inside.withColumn("_k", F.row_number().over(Window.partitionBy("_g", "_low").orderBy("_v")) - 1)
    placed = placed.select("_g", F.explode(F.filter("wanted", lambda w: w["rank"] == F.col("_k"))).alias("w"), "_v").select("_g", "w.target", F.col("_v").alias("v"))
    found = ended.where("_low = _high").select("_g", F.explode("wanted").alias("w"), F.col("_low").alias("v")).select("_g", "w.target", "v").unionByName(placed)
    ends = found.groupBy("_g").agg(F.min_by("v", "target").alias("a"), F.max_by("v", "target").alias("b"))
    out = groups.join(ends, "_g").withColumn("share", at - F.floor(at))
    out = out.select("_g", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias(name))
    return (out.unionByName(small) if by else out).select(*columns, name)
