from pyspark.sql import functions as F

from cohortloom.operators.skew import heavy_keys
from cohortloom.operators.tree import dominant_keys, tree_aggregate, tree_rounds

LEAF = {"n": F.count, "s": F.sum}


def both(df, **kw):
    leaf = {"n": F.count(F.lit(1)), "s": F.sum("v"), "m": F.max("v")}
    tree = tree_aggregate(df, ["k"], leaf, {"n": F.sum, "s": F.sum, "m": F.max}, **kw)
    plain = df.groupBy("k").agg(*[c.alias(n) for n, c in leaf.items()])
    rows = lambda d: sorted(map(tuple, d.select("k", "n", "s", "m").collect()), key=str)
    return rows(tree), rows(plain)


def test_same_as_one_aggregation(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"), F.lit(1).alias("n"))
    for kw in ({}, {"chunk_rows": 10, "fan_in": 2, "rounds": 6}, {"rounds": 1}):
        tree, plain = both(df, **kw)
        assert tree == plain


def test_leaves_grow_with_the_input(spark):
    for rows in (0, 1, 65_536 * 8, 65_536 * 8 + 1, 10**9, 10**12):
        assert 8 ** tree_rounds(rows) * 65_536 >= rows
    assert tree_rounds(0) == 1 and tree_rounds(65_536 * 8) == 1 and tree_rounds(65_536 * 8 + 1) == 2
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("v"), F.lit(1).alias("n"))
    tree, plain = both(df, chunk_rows=10, fan_in=2)
    assert tree == plain


def test_empty_and_dominant(spark):
    df = spark.createDataFrame([], "k string, v long, n int")
    assert both(df) == ([], [])
    counts = spark.createDataFrame([("a", 50), ("b", 5), (None, 45), ("c", 4)], "k string, n long")
    assert {r.k for r in dominant_keys(counts, "k", "n", 100, 0.05).collect()} == {"a", "b"}


def test_heavy_keys_are_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert heavy_keys(df, ["k"], shard_rows=50, max_keys=3).count() == 3
    assert heavy_keys(df, ["k"], shard_rows=100).count() == 0
