"""Exact top-k search against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from aerolag.llm import catalog, topk

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
    # names that the operator uses inside
    T.StructField("row", T.StringType()), T.StructField("id", T.StringType()), T.StructField("v", T.StringType()),
    T.StructField("dim", T.StringType()), T.StructField("score", T.StringType()), T.StructField("rank", T.StringType()),
])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c", "d", "e", "f") for i, v in rows], VECTORS)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain(rows, step, k, scale=64):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if usable(v)]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % step:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), j is None, j or 0, j)
                  for b, (j, v) in enumerate(kept) if a != b and len(v) == len(q)]
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()], key=repr)


@pytest.mark.parametrize("lists", [1, 3, 4, 64])
def test_same_as_all_pairs_in_small_cells(spark, lists):
    rng = random.Random(lists)
    centre = [[rng.gauss(0, 0.3) for _ in range(10)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in centre[i % 4]]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies that tie
    out = topk.search(vectors(spark, rows), topk.every("vec_id", 20), k=5, lists=lists, query_block=4, row_block=50)
    assert got(out) == plain(rows, 20, 5)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.5]), (0, [0.5, -0.5]), (20, [0.0, 0.0]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]),
        (100, [1.0, -inf]), (None, [0.25, 0.25]), (1, [0.5, -0.5]), (-20, [-1.0, 1.0]), (120, []), (121, []),
        (140, [1.0, 2.0, 3.0]), (2, [100.0, 100.0]), (3, [-0.001, 0.001]),
    ]
    assert got(topk.search(vectors(spark, rows), topk.every("vec_id", 20), k=4)) == plain(rows, 20, 4)
    # fewer rows than asked for, no query, no rows
    assert got(topk.search(vectors(spark, rows[:3]), topk.every("vec_id", 20), k=9)) == plain(rows[:3], 20, 9)
    assert got(topk.search(vectors(spark, [(1, [1.0])]), topk.every("vec_id", 20))) == []
    assert got(topk.search(vectors(spark, []), topk.every("vec_id", 20))) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(1 << 16) + i, -float(1 << 16)]) for i in range(0, 80)]
    assert got(topk.search(vectors(spark, rows), topk.every("vec_id", 20), k=3)) == plain(rows, 20, 3)
    with pytest.raises(ArithmeticError):
        topk.list_heads(np.array([[1 << 30]]), np.array([0]), np.array([[1 << 30]]), np.array([1]), 1, 1)


def test_most_rows_are_settled_by_the_threshold():
    """Rows of other clusters never come to the exact phase."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-30, 30, (10, 32))
    x = centres[np.arange(2000) % 10] + rng.integers(-3, 4, (2000, 32))
    q, q_row, x_row = x[:50], np.arange(50), np.arange(2000)
    which, score = topk.list_heads(q, q_row, x, x_row, 20, 4)
    cutoff = np.array([score[which == i].min() for i in range(50)], float)
    exact = np.sort(np.where(np.eye(50, 2000, dtype=bool), -10**9, q @ x.T), axis=1)[:, -20]
    assert (cutoff <= exact).all()  # the cutoff is safe
    (_, scores), = topk._chunks(q, q_row, x, x_row, 4)
    left = topk.sufficient(scores, cutoff)
    assert left.mean() < 0.15
    assert (left.sum(axis=1) >= 20).all()


def test_query_reads_every_vector(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(130)]
    vectors(spark, rows).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert got(catalog.QUERIES["op11_uniform_threshold_topk"](spark, str(tmp_path))) == plain(rows, 20, 20)
