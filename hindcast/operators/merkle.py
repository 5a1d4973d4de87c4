"""Digests of tables as trees: equal tables have equal roots, and two trees tell where tables differ.

A row's leaf is given by the first digits of its key's md5, so it is the same however the table is partitioned, and a hot
range of keys is no hot leaf. A leaf's digest covers its rows' digests in order, a parent's those of its sixteen children.
No group is larger than a leaf, and the number of digits grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a leaf, about.
LEAF_ROWS = 4096


def digits_for(rows: int) -> int:
    """The digits of a leaf's name, so that a leaf has up to ``LEAF_ROWS`` rows on average."""
    digits = 1
    while rows > LEAF_ROWS * 16**digits:
        digits += 1
    return digits


def _text(columns: list[str]) -> Column:
    """A row as text: values apart, and null unlike the empty text."""
    return F.array_join(F.array(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]), chr(31))


def _md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def tree(df: DataFrame, key: list[str], columns: list[str], digits: int | None = None) -> DataFrame:
    """``(prefix, rows, digest)`` of all nodes; the root has the prefix ''. An empty table has no nodes.

    Repeated rows count as often as they stand; rows without a key, and all rows of one key, share a leaf. Without
    ``digits`` the rows are counted first."""
    digits = digits or digits_for(df.count())
    rows = df.select(F.substring(_md5(_text(key)), 1, digits).alias("prefix"), _md5(_text(columns)).alias("digest"))
    level = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("rows"), _md5(F.array_join(F.sort_array(F.collect_list("digest")), "")).alias("digest"))
    nodes = level
    for n in range(digits - 1, -1, -1):
        children = F.array_sort(F.collect_list(F.concat("prefix", "digest")))
        level = level.groupBy(F.substring("prefix", 1, n).alias("prefix")).agg(F.sum("rows").alias("rows"), _md5(F.array_join(children, "")).alias("digest"))
        nodes = nodes.unionByName(level)
    return nodes


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(prefix, left_rows, right_rows)`` of the leaves of two trees of one depth that differ or that one of them lacks."""
    deepest = F.length("prefix")
    both = left.select("prefix", F.col("rows").alias("left_rows"), F.col("digest").alias("a")).join(right.select("prefix", F.col("rows").alias("right_rows"), F.col("digest").alias("b")), "prefix", "full")
    both = both.where(~F.col("a").eqNullSafe(F.col("b")))
    leaf = both.agg(F.max(deepest)).first()[0] or 0
    return both.where(deepest == leaf).select("prefix", "left_rows", "right_rows")
