import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerolag.functions import clock
from aerolag.functions.clock import local_timestamp, whole_minutes
from aerolag.operators import history


def _picked(spark, gaps, delays, guard):
    now = dt.datetime(2017, 1, 7, 20, 0)
    when = [None if g is None else now - dt.timedelta(minutes=g) for g in gaps]
    names = [f"PREV_{s}_{c}_{i}" for s in ("ARR", "DEP") for c in ("DATETIME_UTC", "DELAY") for i in (1, 2, 3)]
    types = ["timestamp_ntz"] * 3 + ["double"] * 3
    schema = "CRS_DEP_DATETIME_UTC timestamp_ntz, " + ", ".join(f"{n} {t}" for n, t in zip(names, types * 2))
    df = spark.createDataFrame([(now, *when, *delays, *when, *delays)], schema)
    row = history.pick_history(df, guard=guard).first()
    assert row["HIST_ARR_DELAY"] == row["HIST_DEP_DELAY"]
    return row["HIST_ARR_DELAY"], row["HIST_ARR_FLT_NUM"]


@pytest.mark.parametrize("gaps,delays,strict,loose", [
    ((20, 100, 360), (15.0, 0.0, 50.0), (50.0, 3), (50.0, 3)),
    ((150, 300, 400), (7.0, 1.0, 2.0), (7.0, 1), (7.0, 1)),
    ((20, 100, 110), (15.0, 0.0, 50.0), (None, None), (50.0, 3)),
    ((None, None, None), (None, None, None), (None, None), (None, 3)),
    ((120, 300, 400), (7.0, 1.0, 2.0), (7.0, 1), (7.0, 1)),
    ((None, 300, 400), (9.0, 1.0, 2.0), (1.0, 2), (2.0, 3)),
])
def test_pick(spark, gaps, delays, strict, loose):
    assert _picked(spark, gaps, delays, "strict") == strict
    assert _picked(spark, gaps, delays, "reference") == loose


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minutes_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2015-03-08 06:30:00' a, timestamp_ntz'2015-03-08 07:30:00' b")
        assert df.select(whole_minutes(F.col("b"), F.col("a"))).first()[0] == 60
        gap = spark.sql("SELECT timestamp_ntz'2015-03-08 02:30:00' a, timestamp_ntz'2015-03-08 02:29:01' b")
        assert gap.select(whole_minutes(F.col("b"), F.col("a"))).first()[0] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clock_numbers(spark):
    df = spark.createDataFrame([("2015-01-01", c) for c in (5, 905, 2400, 2401, 965, None)] + [("x", 5)], "d string, c int")
    got = [r[0] for r in df.select(local_timestamp(F.col("d"), F.col("c"))).collect()]
    day = dt.datetime(2015, 1, 1)
    assert got == [day + dt.timedelta(minutes=5), day + dt.timedelta(hours=9, minutes=5), day + dt.timedelta(days=1),
                   None, None, None, None]


def _expected(rows, n):
    by_key = {}
    for r in rows:
        if r[1] is not None and not r[4]:
            by_key.setdefault(r[1], []).append(r)
    out = {r[0]: (None,) * n for r in rows}
    for group in by_key.values():
        group.sort(key=lambda r: (r[2] is not None, r[2] or dt.datetime.min, r[0]))
        for i, r in enumerate(group):
            out[r[0]] = tuple(group[i - j][3] if i >= j else None for j in range(1, n + 1))
    return out


@pytest.mark.parametrize("parts", [1, 2, 40, 300])
def test_lags_with_a_hot_key_ties_and_gaps(spark, parts):
    """A third of the rows on one key, equal times, missing keys and times."""
    rng = random.Random(7)
    start = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(900):
        key = rng.choice(["hot"] + [f"k{rng.randrange(12)}"] + [None if rng.random() < 0.3 else "k0"])
        when = None if rng.random() < 0.02 else start + dt.timedelta(minutes=rng.randrange(300))
        rows.append((i, key, when, float(i), rng.random() < 0.1))
    df = spark.createDataFrame(rows, "FLIGHT_ID long, TAIL_NUM string, t timestamp_ntz, v double, gone boolean").repartition(5)
    out = history.lag_features(df, order="t", cols=["v"], n=3, exclude=F.col("gone"), parts=parts)
    assert out.columns == [*df.columns, "PREV_v_1", "PREV_v_2", "PREV_v_3"]
    got = {r["FLIGHT_ID"]: tuple(r)[-3:] for r in out.collect()}
    assert got == _expected(rows, 3) and out.count() == len(rows)


def test_arrival_rules(spark):
    flights = spark.createDataFrame(
        [(1, "2015-07-01", 1000, 10.0, 20.0, 60.0), (2, "2015-07-01", 1000, None, None, None)],
        "ORIGIN_AIRPORT_ID int, FL_DATE string, CRS_DEP_TIME int, DEP_DELAY double, ARR_DELAY double, ACTUAL_ELAPSED_TIME double")
    offsets = spark.createDataFrame([(1, 5.5)], "ORIGIN_AIRPORT_ID int, UTC_offset_hours double")
    known = history.add_utc_times(flights, offsets).filter("ORIGIN_AIRPORT_ID = 1").first()
    assert known["CRS_DEP_DATETIME_UTC"] == dt.datetime(2015, 7, 1, 15, 30)
    assert known["ARR_DATETIME_UTC"] == dt.datetime(2015, 7, 1, 16, 40)
    twice = history.add_utc_times(flights, offsets, "reference").filter("ORIGIN_AIRPORT_ID = 1").first()
    assert twice["ARR_DATETIME_UTC"] == dt.datetime(2015, 7, 1, 17, 0)
    lost = history.add_utc_times(flights, offsets).filter("ORIGIN_AIRPORT_ID = 2").first()
    assert lost["CRS_DEP_DATETIME_UTC"] is None


@pytest.mark.parametrize("parts", [None, 50])
def test_rows_without_key_or_id_have_no_history(spark, parts):
    start = dt.datetime(2020, 1, 1)
    rows = [(None, None, start + dt.timedelta(hours=i), float(i)) for i in range(3)]
    rows += [(i, "a", start + dt.timedelta(hours=i), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "FLIGHT_ID long, TAIL_NUM string, t timestamp_ntz, v double")
    out = history.lag_features(df, order="t", cols=["v"], n=1, parts=parts).collect()
    assert [r["PREV_v_1"] for r in out if r["TAIL_NUM"] is None] == [None] * 3
    assert {r["FLIGHT_ID"]: r["PREV_v_1"] for r in out if r["TAIL_NUM"]} == {
        i: float(i - 1) if i else None for i in range(200)}


def test_one_instant_is_cut(spark):
    """A key whose times are all equal, or all missing, is still spread over many partitions."""
    when = dt.datetime(2020, 1, 1)
    rows = [(i, "same", when, float(i)) for i in range(2000)] + [(5000 + i, "none", None, float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "FLIGHT_ID long, TAIL_NUM string, t timestamp_ntz, v double")
    out = history.lag_features(df, order="t", cols=["v"], n=1, parts=40)
    assert {r["FLIGHT_ID"]: r["PREV_v_1"] for r in out.collect()} == {
        **{i: float(i - 1) if i else None for i in range(2000)},
        **{5000 + i: float(i - 1) if i else None for i in range(2000)}}
    placed = df.repartitionByRange(40, "TAIL_NUM", "t", "FLIGHT_ID").withColumn("__part", F.spark_partition_id())
    ends = history._partition_ends(placed, "TAIL_NUM", "t", "FLIGHT_ID", ["v"], 3).collect()
    assert len(ends) >= 30 and all(len(r["__halo"]) == 3 for r in ends)


def test_the_window_needs_no_shuffle(spark):
    """Rows move once, by range, before they are written; the window reads them in buckets."""
    df = spark.range(5000).select(
        F.col("id").alias("FLIGHT_ID"), F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("TAIL_NUM"),
        F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    out = history.lag_features(df, order="t", cols=["v"], n=3, parts=16).filter("TAIL_NUM is not null")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert out.count() == 5000


def test_a_key_in_many_tiny_partitions(spark):
    """Partitions with fewer rows of a key than it looks back: history comes from several of them."""
    rows = [(p * 10 + i, "k", p * 10 + i, p) for p, n in enumerate([1, 2, 1, 1, 5, 1]) for i in range(n)]
    df = spark.createDataFrame(rows, "FLIGHT_ID long, TAIL_NUM string, t long, __part int")
    halos = {r["__part"]: [s["t"] for s in r["__halo"]] for r in history._partition_ends(
        df, "TAIL_NUM", "t", "FLIGHT_ID", ["t"], 3).collect()}
    assert halos == {1: [0], 2: [11, 10, 0], 3: [20, 11, 10], 4: [30, 20, 11], 5: [44, 43, 42]}


def test_zone_rules(spark):
    """Skipped and repeated times, zones without changes, a change of half an hour, no zone; in any session zone."""
    rows = [
        ("America/New_York", dt.datetime(2021, 3, 14, 2, 30)), ("America/New_York", dt.datetime(2021, 11, 7, 1, 30)),
        ("America/New_York", dt.datetime(2021, 7, 1, 12, 0)), ("America/Phoenix", dt.datetime(2021, 3, 14, 2, 30)),
        ("Asia/Kolkata", dt.datetime(2021, 1, 1, 0, 0)), ("Australia/Lord_Howe", dt.datetime(2021, 4, 4, 1, 45)),
        ("Europe/London", dt.datetime(2021, 3, 28, 1, 0)), (None, dt.datetime(2021, 1, 1)), ("Asia/Tokyo", None),
    ]
    df = spark.createDataFrame(rows, "zone string, t timestamp_ntz")
    want = [
        ("never", dt.datetime(2021, 3, 14, 7, 30), dt.datetime(2021, 3, 14, 7, 30)),
        ("twice", dt.datetime(2021, 11, 7, 5, 30), dt.datetime(2021, 11, 7, 6, 30)),
        ("once", dt.datetime(2021, 7, 1, 16, 0), dt.datetime(2021, 7, 1, 16, 0)),
        ("once", dt.datetime(2021, 3, 14, 9, 30), dt.datetime(2021, 3, 14, 9, 30)),
        ("once", dt.datetime(2020, 12, 31, 18, 30), dt.datetime(2020, 12, 31, 18, 30)),
        ("twice", dt.datetime(2021, 4, 3, 14, 45), dt.datetime(2021, 4, 3, 15, 15)),
        ("never", dt.datetime(2021, 3, 28, 1, 0), dt.datetime(2021, 3, 28, 1, 0)),
        (None, None, None), (None, None, None),
    ]
    zone, t = F.col("zone"), F.col("t")
    out = df.select(clock.clock_state(t, zone), clock.zone_to_utc(t, zone), clock.zone_to_utc(t, zone, "second"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in (before, "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session)
            assert [tuple(r) for r in out.collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(ValueError):
        clock.zone_to_utc(t, zone, "third")
