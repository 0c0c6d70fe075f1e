import datetime as dt
import math
import random
import struct
from decimal import Context, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from aerolag.operators import folds, outliers, profile
from aerolag.operators.ranking import _double_key, exact_quantiles, global_position


def _rank(values, p):
    values = sorted(v for v in values if v is not None)
    return values[max(1, math.ceil(p * len(values))) - 1]


@pytest.mark.parametrize("bits,few", [(16, 1 << 16), (16, 0), (11, 0), (4, 30)])
def test_quantiles_narrowing(spark, bits, few):
    rng = random.Random(3)
    a = [rng.gauss(0, 10) for _ in range(4000)] + [None] * 50
    b = [float(rng.choice([1, 1, 1, 2, 3])) for _ in range(4050)]
    df = spark.createDataFrame(list(zip(a, b, [None] * 4050)), "a double, b double, c double").repartition(7)
    got = exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5, 0.75], bits=bits, few=few)
    assert got["a"] == [_rank(a, p) for p in (0.25, 0.5, 0.75)]
    assert got["b"] == [_rank(b, p) for p in (0.25, 0.5, 0.75)]
    assert got["c"] == []


def test_double_digits_are_the_ordered_bits(spark):
    rng = random.Random(4)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [s * m * 2.0**e for e in range(-1074, 1024, 7) for m in (1.0, 1 + 2**-52, 2 - 2**-52) for s in (1, -1) if e < 1023]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf,
               -math.inf, 1e-310, 0.1, 1 / 3]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")

    def bits(v):
        n = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        return -n if v < 0 else n

    assert [r[0] for r in df.select(_double_key("v")).collect()] == [bits(v) for v in values]
    nan = spark.createDataFrame([(math.nan,), (math.inf,)], "v double").select(_double_key("v")).collect()
    assert nan[0][0] > nan[1][0]


@pytest.mark.parametrize("kind,make", [
    ("bigint", lambda r: r.choice([-1, 1]) * (2**53 + r.randrange(2**62 - 2**53))),
    ("bigint", lambda r: 2**60 + r.randrange(5)),
    ("int", lambda r: r.randrange(-2**31, 2**31)),
    ("smallint", lambda r: r.randrange(-2**15, 2**15)),
    ("decimal(38,10)", lambda r: Decimal(r.randrange(-10**37, 10**37)).scaleb(-10, Context(prec=60))),
    ("decimal(38,38)", lambda r: Decimal(r.randrange(-10**37, 10**37)).scaleb(-38, Context(prec=60))),
    ("decimal(38,0)", lambda r: Decimal(r.randrange(-10**38 + 1, 10**38))),
    ("decimal(38,38)", lambda r: Decimal(r.randrange(-3, 4)).scaleb(-38)),
    ("decimal(20,18)", lambda r: Decimal(r.randrange(-10**20 + 1, 10**20)).scaleb(-18, Context(prec=60))),
    ("decimal(18,18)", lambda r: Decimal(r.randrange(-10**18 + 1, 10**18)).scaleb(-18, Context(prec=60))),
    ("decimal(18,0)", lambda r: Decimal(r.randrange(-10**18 + 1, 10**18))),
    ("decimal(9,2)", lambda r: Decimal(r.randrange(-500, 500)).scaleb(-2)),
    ("float", lambda r: struct.unpack("<f", struct.pack("<f", r.gauss(0, 1)))[0]),
    ("date", lambda r: dt.date(1960, 1, 1) + dt.timedelta(days=r.randrange(40_000))),
])
def test_quantiles_keep_every_digit(spark, kind, make):
    rng = random.Random(kind)
    values = [make(rng) for _ in range(700)] + [None] * 9
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    for few in (0, 50, 1 << 16):
        got = exact_quantiles(df, ["v"], [0.1, 0.25, 0.5, 0.75, 1.0], few=few)["v"]
        assert got == [_rank(values, p) for p in (0.1, 0.25, 0.5, 0.75, 1.0)]


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError, match="no ranks"):
        exact_quantiles(spark.createDataFrame([("a",)], "v string"), ["v"], [0.5])


def test_trim_bounds_keep_every_digit(spark):
    big = 2**60
    values = [big + i for i in range(101)] + [big + 176, big + 10**6, big - 50]
    df = spark.createDataFrame([(v, Decimal(v)) for v in values], "a bigint, d decimal(30,3)")
    # quartiles are the 26th and 78th of 104 values
    ranked = sorted(values)
    q1, q3 = ranked[25], ranked[77]
    assert outliers.iqr_bounds(df, ["a"])["a"] == (math.ceil(q1 - Fraction(3, 2) * (q3 - q1)), math.floor(q3 + Fraction(3, 2) * (q3 - q1)))
    kept = [v for v in values if q1 - Fraction(3, 2) * (q3 - q1) <= v <= q3 + Fraction(3, 2) * (q3 - q1)]
    for c in ("a", "d"):
        assert sorted(int(r[0]) for r in outliers.iqr_trim(df, [c]).select(c).collect()) == sorted(kept)


def test_trim_reads_its_input_once_for_the_bounds(spark, tmp_path):
    """Whatever the number of columns: the input is scanned to stage them, and by the result."""
    spark.range(500).selectExpr("id % 50 a", "id % 70 b", "id % 90 c").write.parquet(f"{tmp_path}/t")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.read.parquet(f"{tmp_path}/t").mapInArrow(seen, "a long, b long, c long")
    out = outliers.iqr_trim(df, ["a", "b", "c"])
    assert reads.value == 500
    assert out.count() == 500 and reads.value == 1000


def test_quartiles_of_nothing(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    got = {r["column"]: tuple(r)[1:] for r in profile.quartiles(df, ["a", "b"]).collect()}
    assert got == {"a": (1.0, 1.0, 1.0), "b": (None, None, None)}


def test_positions(spark):
    df = spark.range(5000).withColumn("k", F.col("id") % 3).repartition(13)
    got = {r["id"]: r["position"] for r in global_position(df, ["k", "id"]).collect()}
    expected = sorted(range(5000), key=lambda i: (i % 3, i))
    assert [got[i] for i in expected] == list(range(1, 5001))


def test_trim_depends_on_order_only_when_sequential(spark):
    rows = [(float(i), float(i % 7)) for i in range(100)] + [(1000.0, 50.0), (None, 1.0), (50.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert outliers.iqr_trim(df, ["a", "b"]).count() == 100
    assert outliers.iqr_trim(df, ["a", "b"], mode="onepass").count() == 100
    with_empty = df.withColumn("c", F.lit(None).cast("double"))
    assert outliers.iqr_trim(with_empty, ["a", "c", "b"]).count() == 100
    assert outliers.iqr_trim(df, ["a", "b"], error=0.01).count() == 100


def test_folds_cover_all_rows_with_ties_and_missing_times(spark):
    """Two thirds of the rows in one minute, some without a time."""
    n = 3000
    when = F.when(F.col("id") % 50 == 0, None).when(
        F.col("id") % 3 > 0, F.lit("2020-01-01 10:00:00").cast("timestamp_ntz")
    ).otherwise(F.lit("2020-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int")))
    df = spark.range(n).select(F.col("id").alias("FLIGHT_ID"), when.alias("DEP_TS"))
    rows = df.collect()
    order = sorted(rows, key=lambda r: (r["DEP_TS"] is not None, str(r["DEP_TS"]), r["FLIGHT_ID"]))
    place = {r["FLIGHT_ID"]: i for i, r in enumerate(order)}
    ranges = folds.fold_ranges(n)
    expected = {
        (r["FLIGHT_ID"], i, "train" if place[r["FLIGHT_ID"]] < val else "val")
        for r in rows for i, (lo, val, hi) in enumerate(ranges) if lo <= place[r["FLIGHT_ID"]] < hi
    }
    got = [(r["FLIGHT_ID"], r["foldCol"], r["split"]) for r in folds.assign_folds(df).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert {g[0] for g in got} == set(range(n))


def test_fold_ranges_share_a_tenth():
    ranges = folds.fold_ranges(7300)
    assert len(ranges) == 8 and ranges[0][0] == 0 and ranges[-1][2] == 7300
    for (_, _, end), (start, _, _) in zip(ranges, ranges[1:]):
        assert end - start == 100


def test_histogram_counts_kept_rows(spark):
    df = spark.createDataFrame([(float(i % 40),) for i in range(2000)] + [(1e6,), (None,)], "v double")
    rows = profile.histogram(df, "v").collect()
    assert len(rows) == 30 and sum(r["n"] for r in rows) == 2000
    constant = profile.histogram(spark.createDataFrame([(2.0,)] * 5, "v double"), "v")
    assert sum(r["n"] for r in constant.collect()) == 5


def test_folds_ignore_the_session_zone(spark):
    start = F.lit("2020-03-08 01:00:00").cast("timestamp_ntz")
    df = spark.range(1000).select(
        F.col("id").alias("FLIGHT_ID"), (start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("DEP_TS"))
    here = sorted(map(tuple, folds.assign_folds(df).drop("DEP_TS").collect()))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        there = sorted(map(tuple, folds.assign_folds(df).drop("DEP_TS").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert here == there


def test_sketches_merge_over_any_range(spark):
    rng = random.Random(8)
    rows = [(i % 9, rng.gauss(i % 9, 3) if i % 11 else None, None) for i in range(6000)]
    df = spark.createDataFrame(rows, "day int, v double, empty double").repartition(5)
    stored = profile.quantile_sketches(df, ["v", "empty"], ["day"])
    for low, high in ((0, 8), (3, 3), (2, 6)):
        some = df.filter(F.col("day").between(low, high))
        found = profile.merged_quantiles(stored.filter(F.col("day").between(low, high)), ["v", "empty"])
        got = {r["column"]: r for r in found.collect()}
        assert got["v"]["n"] == some.select("v").dropna().count()
        assert tuple(got["empty"])[1:] == (0, None, None, None)
        errors = {r["column"]: tuple(r)[2:] for r in profile.rank_errors(some, found, ["v", "empty"]).collect()}
        assert max(errors["v"]) <= 0.01 and errors["empty"] == (None, None, None)
