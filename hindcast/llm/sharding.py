"""Sharding by sampled splitters, with DataFrame functions only.

A size-weighted sample of hashed keys gives quantile boundaries (splitters), records are range-partitioned by them, and
a range that one key overfills is subdivided: such a key shows as a repeated splitter, and its rows are dealt by a
hash of the record over as many ranges as it repeats. Exact row and byte counts of the ranges (a table of at most
``MOST_RANGES`` rows) then give every record its exact place in the whole order, so that shards differ in bytes by about
one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled keys for each range; the sample has about ``ranges * OVERSAMPLE`` keys at any input size.
OVERSAMPLE = 16
#: Bytes of records in a range, about, and the least and most ranges; the rows of one range are sorted by one task.
RANGE_BYTES, LEAST_RANGES, MOST_RANGES = 256 << 20, 1024, 65_536


def splitters(keyed: DataFrame, ranges: int | None = None) -> list[int]:
    """Weighted quantiles of ``_key``, repeated where one key fills several ranges: one fewer than there are ranges.

    ``_key`` has 53 bits at most, as quantiles are computed in doubles. A record weighs its share of the bytes plus its
    share of the rows, so that neither large records nor many small ones fill a range. The driver gets this list alone.
    The sample is drawn by a hash, so that a retried task draws the same rows.
    """
    total, rows = keyed.agg(F.sum("_size"), F.count(F.lit(1))).first()
    if not rows:
        return []
    ranges = ranges or min(MOST_RANGES, max(LEAST_RANGES, int(total) // RANGE_BYTES))
    chance = (F.col("_size") / F.lit(float(max(total, 1))) + F.lit(1 / rows)) * F.lit(ranges * OVERSAMPLE / 2)
    drawn = F.shiftrightunsigned(F.xxhash64("_key", "_tie", F.lit("sample")), 11) / F.lit(float(1 << 53)) < chance
    sample = keyed.where(drawn).select("_key", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), chance.cast("int")))))
    return sample.agg(F.percentile_approx("_key", [k / ranges for k in range(1, ranges)], max(100_000, 20 * ranges))).first()[0] or []


def _below(key: Column, bounds: Column, n: int, *, same: bool) -> Column:
    """How many of the sorted bounds are below the key (or the same), by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(n, 1).bit_length()))])

    def step(at: Column, s: Column) -> Column:
        bound = F.get(bounds, at + s - 1)
        return F.when((at + s <= n) & (bound <= key if same else bound < key), at + s).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def ranged(df: DataFrame, key: Column, size: Column, tie: list[str], ranges: int | None = None) -> DataFrame:
    """Add ``_hash`` (53 bits of the key's hash), ``_key``, ``_size``, ``_tie`` and ``_range``, which ascends with ``_hash``."""
    df = df.withColumns({"_key": F.coalesce(key, F.lit(0)).cast("bigint"), "_size": F.coalesce(size, F.lit(0)).cast("bigint"), "_tie": F.xxhash64(*tie)})
    df = df.withColumn("_hash", F.shiftrightunsigned(F.xxhash64("_key"), 11))
    bounds = splitters(df.select(F.col("_hash").alias("_key"), "_tie", "_size"), ranges)
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    low, high = (_below(F.col("_hash"), array, len(bounds), same=s) for s in (False, True))
    dealt = df.withColumns({"_low": low, "_high": high}).withColumn(
        "_range", F.when(F.col("_high") - F.col("_low") > 1, F.col("_low") + 1 + F.pmod(F.col("_tie"), F.col("_high") - F.col("_low"))).otherwise(F.col("_high")).cast("int")
    )
    return dealt.drop("_low", "_high")


def assign_shards(df: DataFrame, key: Column, size: Column, tie: list[str], shards: int = 16, ranges: int | None = None) -> DataFrame:
    """Add ``size``, ``shard`` (0 to ``shards - 1``) and ``slot`` (from 0, without gaps, in each shard).

    Records are ordered by a hash of ``key`` (equal keys side by side), then by the columns of ``tie``; consecutive
    records fill a shard up to its share of all bytes. A null ``key`` or ``size`` counts as 0. An empty table gives an
    empty one. Rows that are equal in ``key`` and ``tie`` get different slots, in any order. Columns of ``df`` named
    ``size``, ``shard`` or ``slot`` are replaced; others are kept. The number of ranges follows the bytes of the
    table unless ``ranges`` is given; what is broadcast is a row of three numbers for each range.
    """
    dealt = ranged(df, key, size, tie, ranges)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over at most MOST_RANGES rows
    sums = dealt.groupBy("_range").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    sums = sums.select("_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_bytes", "_rows")], F.sum("_bytes").over(Window.partitionBy()).alias("_total"))
    inside = Window.partitionBy("_range").orderBy("_hash", "_key", *tie)
    placed = (
        dealt.join(F.broadcast(sums), "_range")
        .withColumn("_place", F.col("_rows_before") + F.row_number().over(inside) - 1)
        .withColumn("_start", F.col("_bytes_before") + F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor((F.col("_start") + F.col("_size") / 2) * shards / F.greatest(F.col("_total"), F.lit(1)))).cast("int"))
    )
    firsts = placed.groupBy("shard").agg(F.min("_place").alias("_first"))
    out = placed.join(F.broadcast(firsts), "shard").withColumns({"size": F.col("_size"), "slot": (F.col("_place") - F.col("_first")).cast("bigint")})
    return out.drop("_hash", "_key", "_size", "_tie", "_range", "_bytes_before", "_rows_before", "_total", "_place", "_start", "_first")
