"""Vector codes against k-means that compares every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from aerolag.llm import catalog, codes

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
    # names that the operator uses inside
    T.StructField("id", T.StringType()), T.StructField("v", T.StringType()), T.StructField("code", T.StringType()),
    T.StructField("codes", T.StringType()), T.StructField("distances", T.StringType()), T.StructField("error", T.StringType()),
])


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], VECTORS)


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    x = np.array([v for _, v, _ in kept], dtype=object)
    w = x.shape[1] // parts
    code, error, books = [], 0, []
    for p in range(parts):
        mine = [tuple(v[p * w:(p + 1) * w]) for v in x]
        book = list(mine[:entries])
        for turn in range(rounds + 1):
            far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in book] for v in mine]
            at = [d.index(min(d)) for d in far]
            if turn < rounds:
                for e in range(len(book)):
                    ball = [v for v, a in zip(mine, at) if a == e]
                    if ball:
                        book[e] = tuple(sum(column) // len(ball) for column in zip(*ball))
        code.append(at)
        error = error + np.array([min(d) for d in far], dtype=object)
        books += [y for c in book for y in c]
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    sums = {}
    for e, (_, _, label) in zip(error, kept):
        sums[label] = sums.get(label, 0) + e
    return sorted(((i, "".join(f"{code[p][n]:02x}" for p in range(parts)), int(error[n]), int(sums[label]), digest)
                   for n, (i, _, label) in enumerate(kept)), key=repr)


def got(df):
    return sorted([(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()], key=repr)


def clusters(seed, n, width=8, spread=0.05):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 0.5) for _ in range(width)] for _ in range(12)]
    return [(i, [c + rng.gauss(0, spread) for c in centre[rng.randrange(12)]], rng.choice([1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("entries,spread", [(16, 0.05), (40, 0.5), (256, 0.05)])
def test_same_as_plain(spark, entries, spread):
    rows = clusters(entries, 300, spread=spread)
    rows += [(500 + i, rows[3][1], 2) for i in range(100)]  # copies
    assert got(codes.compress(vectors(spark, rows), entries=entries)) == plain(rows, entries=entries)


def test_ties_and_equal_entries(spark):
    """Coarse components make many ties; equal starting entries leave the later ones unused."""
    rng = random.Random(8)
    rows = [(i, [rng.randint(-2, 2) / 4 for _ in range(4)], 0) for i in range(200)]
    assert got(codes.compress(vectors(spark, rows), entries=32, scale=4)) == plain(rows, entries=32, scale=4)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(5, [0.5, -0.5, 0.25, 1.0], None), (5, [0.5, -0.5, 0.25, 1.0], 3), (None, [0.1, 0.2, 0.3, 0.4], 3)]
    rows = [*good, (1, None, 1), (2, [nan, 0.0, 0.0, 0.0], 1), (3, [0.0, None, 0.0, 0.0], 1), (4, [0.0, 0.0, 0.0, -inf], None),
            (9, [0.0, 0.0], 1)]
    assert got(codes.compress(vectors(spark, rows))) == plain(rows)
    empty = codes.compress(vectors(spark, []))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.collect() == []
    assert codes.compress(vectors(spark, rows[3:7])).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        codes.compress(vectors(spark, [(1, [1.0, 2.0, 3.0], 1)]))


def test_balls_save_distances():
    """Cores and rings: after the first round most parts meet few entries, with the result of meeting all."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-2000, 2000, (64, 4))
    x = centre[rng.integers(0, 64, 5000)] + rng.integers(-60, 61, (5000, 4))
    entries = centre[None] + 3
    index, distance = codes.nearest(x, entries[0])
    moved = entries + rng.integers(-20, 21, entries.shape) * (np.arange(64) % 2)[None, :, None]
    radius = np.array([[np.sqrt(distance[index == e].max(initial=0)) for e in range(64)]])
    step = np.sqrt(((moved - entries) ** 2).sum(2))
    balls = codes.Balls(moved, radius + step, step > 0)
    tables = balls.neighbours(0)
    at, d, compared = codes.settle(x, balls, 0, index, distance, tables)
    expected, far = codes.nearest(x, moved[0])
    assert (at == expected).all() and (d == far).all()
    assert compared < 0.1 * x.shape[0] * 64
    assert any(tables[2])  # balls whose entry and neighbours stayed


def test_values_too_large_are_refused():
    with pytest.raises(ArithmeticError):
        codes.check_size(np.zeros((1, 1, 4)), np.array([[1 << 27] * 4]))


def test_query_reads_every_vector(spark, tmp_path):
    rows = clusters(11, 400, 16)
    vectors(spark, rows).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert got(catalog.QUERIES["op13_ball_kmeans_codes"](spark, str(tmp_path))) == plain(rows)
