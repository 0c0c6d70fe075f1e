"""Lookups by size, and rows without a key."""

from pyspark.sql import functions as F

from aerolag.operators import joins


def _hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or "broadcast" in df._jdf.queryExecution().logical().toString()


def test_wide_rows_are_not_broadcast(spark):
    narrow = spark.range(100).select("id", F.lit("x").alias("v"))
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 2_000_000).alias("v"))
    assert _hinted(joins.broadcast_if_small(narrow))
    assert not _hinted(joins.broadcast_if_small(wide))
    assert not _hinted(joins.broadcast_if_small(narrow, max_rows=50))
    assert not _hinted(joins.broadcast_if_small(narrow, max_bytes=100))


def test_keyless_rows_on_both_routes(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (None, "b"), (3, "c"), (None, None)], "k int, v string")
    lookup = spark.createDataFrame([(1, 10.0), (3, 30.0)], "key int, x double")
    want = sorted(map(repr, [(1, "a", 10.0), (2, None, None), (None, "b", None), (3, "c", 30.0), (None, None, None)]))
    for rows in (1000, 1):
        out = joins.lookup_join(fact, lookup, {"k": "key"}, {"x": "got"}, max_rows=rows)
        assert out.columns == ["k", "v", "got"]
        assert sorted(map(repr, map(tuple, out.collect()))) == want
