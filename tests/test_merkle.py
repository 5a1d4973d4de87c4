from pyspark.sql import functions as F

from hindcast.operators import merkle


def test_trees_tell_where_tables_differ(spark, monkeypatch):
    df = spark.range(500).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), "id")).alias("v"))
    root = lambda d, n=None: merkle.tree(d, ["k"], ["k", "v"], n).where("prefix = ''").first()
    one = root(df, 2)
    assert one["rows"] == 500 and one == root(df.repartition(7, "v").orderBy(F.rand(1)), 2)
    other = df.withColumn("v", F.when(F.col("k") == 14, "").otherwise(F.col("v")))  # null and the empty text differ
    assert root(other, 2) != one and root(df.unionByName(df.where("k = 3")), 2) != one
    trees = [merkle.tree(d, ["k"], ["k", "v"], 2) for d in (df, other.where("k <> 20"))]
    found = merkle.differences(*trees).collect()
    assert {r["prefix"] for r in found} == {r[0] for r in df.where("k in (14, 20)").select(F.substring(F.md5(F.concat(F.lit("="), "k").cast("binary")), 1, 2)).collect()}
    assert merkle.differences(trees[0], trees[0]).collect() == [] and merkle.tree(df.where("false"), ["k"], ["k"]).collect() == []
    monkeypatch.setattr(merkle, "LEAF_ROWS", 1)
    assert merkle.digits_for(500) == 3 and root(df)["rows"] == 500
