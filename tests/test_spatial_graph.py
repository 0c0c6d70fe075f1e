import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from aerolag.operators import enrich, graph, spatial
from aerolag.operators.joins import lookup_join
from aerolag.sources.stage import Stages


def _km(a, b):
    la, lb = math.radians(a[1]), math.radians(b[1])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return round(2 * 6371.0 * math.asin(math.sqrt(min(1.0, h))), 6)


@pytest.mark.parametrize("seed", range(3))
def test_nearest_against_all_pairs(spark, seed):
    """Clustered stations with copies, poles and the date line."""
    rng = random.Random(seed)
    stations = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)]
    stations += [(100 + i, 40 + rng.gauss(0, 0.01), -73 + rng.gauss(0, 0.01)) for i in range(60)]
    stations += [(300 + i, 10.0, 179.9) for i in range(20)] + [(400, 89.9, 0.0), (401, -90.0, 12.0), (402, 10.0, 180.0)]
    airports = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(80)]
    airports += [(90, 10.0, -179.95), (91, 90.0, 0.0), (92, -89.99, -100.0), (93, 40.0, -73.0), (94, 41.0, -73.0)]
    schema = "{} long, lat double, lon double"
    out = spatial.nearest_station(
        spark.createDataFrame(airports, schema.format("airport")), spark.createDataFrame(stations, schema.format("station")))
    got = {r["airport"]: (r["closest_station"], r["distance_km"]) for r in out.collect()}
    for a in airports:
        km, station = min((_km(a, s), s[0]) for s in stations)
        assert got[a[0]][1] == pytest.approx(km, abs=2e-6)
        assert got[a[0]][0] == station or abs(_km(a, next(s for s in stations if s[0] == got[a[0]][0])) - km) < 2e-6


def test_weather_two_hours_ahead_over_midnight(spark):
    flights = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 2, 1, 15), 7), (2, dt.datetime(2020, 1, 2, 9, 0), 7), (3, dt.datetime(2020, 1, 2, 1, 0), None)],
        "FLIGHT_ID long, DEP_TS timestamp_ntz, closest_station long")
    obs = spark.createDataFrame(
        [(7, dt.datetime(2020, 1, 1, 23, 5), "early"), (7, dt.datetime(2020, 1, 1, 23, 55), "late"),
         (7, dt.datetime(2020, 1, 2, 0, 1), "after"), (8, dt.datetime(2020, 1, 1, 23, 56), "elsewhere")],
        "station long, obs_ts timestamp_ntz, TMP string")
    got = {r["FLIGHT_ID"]: r["TMP"] for r in spatial.join_weather(flights, obs, ["TMP"]).collect()}
    assert got == {1: "late", 2: None, 3: None}


def test_rank_sums_to_vertices_with_sinks(spark):
    edges = [(2020, 1, "a", "b", 3), (2020, 1, "a", "c", 1), (2020, 1, "b", "a", 1), (2020, 2, "x", "y", 5)]
    df = spark.createDataFrame(edges, "YEAR int, QUARTER int, src string, dst string, flights long")
    rows = graph.pagerank(df, tol=1e-6).collect()
    totals = {}
    for r in rows:
        key = (r["YEAR"], r["QUARTER"])
        totals[key] = totals.get(key, 0) + r["pagerank"]
    assert totals[(2020, 1)] == pytest.approx(3) and totals[(2020, 2)] == pytest.approx(2)
    # Fixed point by hand: x gets only the reset, y the reset plus all of x.
    second = {r["id"]: r["pagerank"] for r in rows if r["QUARTER"] == 2}
    assert second["y"] / second["x"] == pytest.approx((0.15 + 0.85 * 0.15) / 0.15, rel=1e-5)


def test_ranks_do_not_depend_on_stage_length(spark):
    df = spark.range(3000).select(
        F.lit(2020).alias("YEAR"), F.lit(1).alias("QUARTER"), (F.col("id") * 7 % 11).cast("string").alias("ORIGIN"),
        (F.col("id") * F.col("id") % 13).cast("string").alias("DEST"))
    edges = graph.season_edges(df)
    runs = [
        {r["id"]: round(r["pagerank"], 9) for r in graph.pagerank(edges, tol=None, max_iter=4, steps_per_stage=k).collect()}
        for k in (1, 3, 4)
    ]
    assert runs[0] == runs[1] == runs[2]


def test_settled_ranks_match_all_steps_and_seasons_stop_alone(spark):
    """Pushing only what still moves ends where repeating whole steps does, with less work for quick seasons."""
    rng = random.Random(3)
    edges = [(2020, 2, "x", "y", 5)]
    edges += [(2020, 3, str(rng.randrange(30)), str(rng.randrange(30)), rng.randint(1, 9)) for _ in range(120)]
    df = spark.createDataFrame(edges, "YEAR int, QUARTER int, src string, dst string, flights long")
    df = df.groupBy("YEAR", "QUARTER", "src", "dst").agg(F.sum("flights").alias("flights"))
    settled = {(r["QUARTER"], r["id"]): r for r in graph.pagerank(df, tol=1e-5).collect()}
    whole = {(r["QUARTER"], r["id"]): r for r in graph.pagerank(df, tol=None, max_iter=30, steps_per_stage=6).collect()}
    assert settled.keys() == whole.keys()
    assert all(settled[k]["pagerank"] == pytest.approx(whole[k]["pagerank"], abs=1e-3) for k in whole)
    steps = {q: settled[k]["steps"] for k in settled for q in [k[0]]}
    assert steps[2] < steps[3] and steps[2] <= 2
    with Stages(spark) as stages:
        links, vertices = graph._links(stages, df, ["YEAR", "QUARTER"])
        state = graph._settle(stages, links, vertices, ["YEAR", "QUARTER"], 0.15, 1e-5, 1000, 2)
        sent = {r["QUARTER"]: r["n"] for r in state.groupBy("QUARTER").agg(F.sum("sent").alias("n")).collect()}
        third = sum(k[0] == 3 for k in settled)
        assert sent[2] <= 2 and sent[3] < steps[3] * third
    with pytest.raises(RuntimeError, match="still moves"):
        graph.pagerank(df, tol=1e-5, max_iter=2)


@pytest.mark.parametrize("now,later", [((2015, 4), (2016, 1)), ((2015, 1), (2015, 2))])
def test_season_shift(spark, now, later):
    row = enrich.shift_season(spark.createDataFrame([now], "YEAR int, QUARTER int")).first()
    assert (row["YEAR_NEW"], row["QUARTER_NEW"]) == later


def test_repeated_lookup_keys_are_refused(spark):
    ranks = spark.createDataFrame([(2015, 1, "a", 1.0)] * 2, "YEAR_NEW int, QUARTER_NEW int, id string, pagerank double")
    flights = spark.createDataFrame([(2015, 1, "a")], "YEAR int, QUARTER int, ORIGIN string")
    with pytest.raises(ValueError):
        enrich.join_centrality(flights, ranks)


def test_holiday_window(spark):
    holidays = spark.createDataFrame(
        [(dt.datetime(2015, 7, 4), "United States", True), (dt.datetime(2015, 8, 1), "United States", None),
         (dt.datetime(2015, 9, 1), "United States", False), (dt.datetime(2015, 10, 1), "Elsewhere", True)],
        "date timestamp_ntz, countryOrRegion string, isPaidTimeOff boolean")
    dates = enrich.paid_holidays(holidays, "United States", dt.date(2015, 1, 1), dt.date(2019, 12, 31))
    days = ["2015-06-30", "2015-07-01", "2015-07-07", "2015-07-08", "2015-08-01", "2015-09-01", "2015-10-01", None]
    flagged = enrich.flag_near_dates(spark.createDataFrame([(d,) for d in days], "FL_DATE string"), dates)
    assert {r["FL_DATE"]: r["isHoliday"] for r in flagged.collect()} == dict(zip(days, (0, 1, 1, 0, 0, 0, 0, 0)))


def test_large_lookup_is_not_broadcast(spark):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    lookup = spark.range(500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = lookup_join(fact, lookup, {"k": "key"}, {"v": "v"})
        large = lookup_join(fact, lookup, {"k": "key"}, {"v": "v"}, max_rows=100)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (small, large)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)


def test_volume_ignores_the_test_year(spark):
    rows = [("a", "b", 2018)] * 4 + [("a", "b", 2017)] * 2 + [("b", "a", 2019)] * 9
    df = spark.createDataFrame(rows, "ORIGIN string, DEST string, YEAR int")
    volume = enrich.airport_volume(df, 2019)
    assert [tuple(r) for r in volume.collect()] == [("a", 3.0)]
    joined = enrich.join_volume(df, volume)
    assert joined.count() == 15
    assert {tuple(r) for r in joined.select("ORIGIN", "origin_yr_flights", "dest_yr_flights").distinct().collect()} == {
        ("a", 3.0, None), ("b", None, 3.0)}


def test_cells_with_many_stations_are_quartered(spark):
    """Ten thousand stations in a cell a few kilometres wide: none meets a site in more than a few leaves."""
    k = F.col("id")
    town = lambda name: spark.range(10_000).select(
        k.alias(name), (F.lit(40.0) + (k * 7919 % 10007) * 3e-6).alias("lat"), (F.lit(-73.0) + (k * 104729 % 10009) * 3e-6).alias("lon"))
    cells, leaves = spatial._station_grid(town("station"), "station", 32)
    assert leaves.selectExpr("max(size(places))").first()[0] <= 32
    assert leaves.selectExpr("sum(size(places))").first()[0] == 10_000
    assert cells.selectExpr("max(depth)").first()[0] <= 10
    sites = town("airport").limit(300).withColumn("lat", F.col("lat") + 1e-6)
    got = {r["airport"]: r["distance_km"] for r in spatial.nearest_station(sites, town("station")).collect()}
    stations = [tuple(r) for r in town("station").collect()]
    for a in sites.limit(40).collect():
        assert got[a["airport"]] == pytest.approx(min(_km(tuple(a), s) for s in stations), abs=2e-6)


def test_sites_walk_as_blocks(spark, monkeypatch):
    """Sites of one town descend the grid together: the walk has far fewer rows than there are sites."""
    k = F.col("id")
    town = lambda name, n: spark.range(n).select(
        k.alias(name), (F.lit(40.0) + (k * 7919 % 10007) * 3e-6).alias("lat"), (F.lit(-73.0) + (k * 104729 % 10009) * 3e-6).alias("lon"))
    walked, real = [], spatial.stage_table

    def staged(df, label="stage"):
        out = real(df, label)
        if label == "walk":
            walked.append(out.count())
        return out

    monkeypatch.setattr(spatial, "stage_table", staged)
    assert spatial.nearest_station(town("airport", 10_000), town("station", 3000)).count() == 10_000
    assert walked and max(walked) < 2000


@pytest.mark.parametrize("leaf_places", [1, 4])
def test_nearest_far_from_clusters(spark, leaf_places):
    """Clusters at a pole, at the date line and in a town, seen from within, from near and from afar."""
    rng = random.Random(leaf_places)
    middles = [(89.98, 30.0), (-17.0, 179.999), (51.5, 0.0)]
    stations = [(i, max(-90.0, min(90.0, la + rng.gauss(0, 0.01))), (lo + rng.gauss(0, 0.01) + 180) % 360 - 180)
                for i, (la, lo) in enumerate(middles * 40)]
    airports = []
    for i in range(150):
        (la, lo), spread = middles[i % 3], (0.01, 1.0, 60.0)[i // 3 % 3]
        airports.append((i, max(-90.0, min(90.0, la + rng.gauss(0, spread))), (lo + rng.gauss(0, spread) + 180) % 360 - 180))
    airports += [(200, None, 1.0), (201, 0.0, 180.0), (202, 0.0, -180.0), (203, -90.0, 5.0)]
    schema = "{} long, lat double, lon double"
    got = {r["airport"]: r["distance_km"] for r in spatial.nearest_station(
        spark.createDataFrame(airports, schema.format("airport")), spark.createDataFrame(stations, schema.format("station")),
        leaf_places=leaf_places).collect()}
    assert got.keys() == {a[0] for a in airports if a[1] is not None}
    for a in airports:
        if a[1] is not None:
            assert got[a[0]] == pytest.approx(min(_km(a, s) for s in stations), abs=2e-6)


def test_no_stations(spark):
    none = spark.createDataFrame([(1, None, 0.0)], "station long, lat double, lon double")
    sites = spark.createDataFrame([(1, 1.0, 2.0)], "airport long, lat double, lon double")
    assert spatial.nearest_station(sites, none).collect() == []
    one = spark.createDataFrame([(7, 1.0, 2.0), (3, 1.0, 2.0)], "station long, lat double, lon double")
    assert [tuple(r) for r in spatial.nearest_station(sites, one).collect()] == [(1, 3, 0.0)]


def test_volume_known_at_a_fold(spark):
    when = [dt.datetime(2019, 12, 31), dt.datetime(2020, 1, 5), dt.datetime(2020, 1, 9), dt.datetime(2020, 1, 9, 0, 0, 1), None]
    rows = [(o, t.year if t else 2020, t) for t in when for o in ("A", "B")] + [("C", 2020, dt.datetime(2020, 2, 1))]
    df = spark.createDataFrame(rows, "ORIGIN string, YEAR int, DEP_TS timestamp_ntz")
    starts = spark.createDataFrame(
        [(0, dt.datetime(2020, 1, 9)), (1, dt.datetime(2021, 1, 1)), (2, dt.datetime(2020, 1, 9)), (3, dt.datetime(2000, 1, 1))],
        "foldCol int, start timestamp_ntz")
    got = {(r["foldCol"], r["airport"]): r["avg_yr_flights"] for r in enrich.fold_volume(df, starts).collect()}
    assert got == {**{(f, o): 1.0 for f in (0, 2) for o in "AB"}, (1, "A"): 2.0, (1, "B"): 2.0, (1, "C"): 0.5}
    assert enrich.fold_volume(df, starts.limit(0)).count() == 0
    joined = enrich.join_fold_volume(
        spark.createDataFrame([(1, "A", "C"), (0, "A", "C"), (3, "A", None)], "foldCol int, ORIGIN string, DEST string"),
        enrich.fold_volume(df, starts))
    assert sorted(tuple(r)[0:1] + tuple(r)[3:] for r in joined.collect()) == [(0, 1.0, None), (1, 2.0, 0.5), (3, None, None)]
