"""The whole job on flights of the declared input schema."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerolag.operators import folds, history, sampling
from aerolag.plans import pipeline
from aerolag.schema import FLIGHTS_SCHEMA, FeatureSpec
from aerolag.sources.stage import stage_table

NAMES = FLIGHTS_SCHEMA.fieldNames()


@pytest.fixture(scope="module")
def flights(spark):
    """Four quarters over two years, with nothing beyond the declared columns."""
    rng, rows = random.Random(11), []
    days = [dt.date(2022, 5, 1), dt.date(2022, 8, 1), dt.date(2022, 11, 1), dt.date(2023, 2, 1)]
    for first in days:
        for i in range(600):
            day = first + dt.timedelta(days=rng.randrange(20))
            hour, late = rng.randrange(24), rng.random() < 0.4
            src, dst = rng.sample(range(6), 2)
            rows.append({
                "QUARTER": (day.month + 2) // 3, "MONTH": day.month, "DAY_OF_WEEK": day.isoweekday(),
                "DAY_OF_MONTH": day.day, "YEAR": day.year, "FL_DATE": str(day), "OP_UNIQUE_CARRIER": f"C{i % 3}",
                "ORIGIN": f"A{src}", "DEST": f"A{dst}", "ORIGIN_AIRPORT_ID": src, "DEST_AIRPORT_ID": dst,
                "TAIL_NUM": f"N{i % 20}", "DEP_TIME_BLK": f"{hour:02d}00-{hour:02d}59",
                "ARR_TIME_BLK": f"{hour:02d}00-{hour:02d}59", "CRS_DEP_TIME": hour * 100 + rng.randrange(60),
                "CRS_ARR_TIME": 100, "CRS_ELAPSED_TIME": 60.0, "ACTUAL_ELAPSED_TIME": 50.0 + rng.randrange(30),
                "DISTANCE": 100.0 + rng.randrange(900), "DEP_DELAY": 40.0 if late else 0.0, "ARR_DELAY": 30.0 if late else 0.0,
                "DEP_DEL15": None if i % 97 == 0 else float(late), "CANCELLED": 0.0,
                "WND": f"{rng.randrange(360):03d},1,N,{rng.randrange(200):04d},1", "CIG": f"{rng.randrange(25000):05d},5,M,N",
                "VIS": f"{rng.randrange(16000):06d},5,N,1", "TMP": f"+{rng.randrange(400):04d},1",
                "DEW": f"+{rng.randrange(250):04d},1", "SLP": f"{9800 + rng.randrange(600):05d},1",
                "AW1": "RA" if i % 7 == 0 else None,
            })
    data = [tuple(r.get(c) for c in NAMES) for r in rows]
    return spark.createDataFrame(data, FLIGHTS_SCHEMA)


@pytest.fixture(scope="module")
def lookups(spark):
    holidays = spark.createDataFrame([(dt.date(2022, 5, 5),), (dt.date(2023, 2, 10),)], "date date")
    offsets = spark.createDataFrame([(i, 5.0 + i % 3) for i in range(6)], "ORIGIN_AIRPORT_ID int, UTC_offset_hours double")
    return holidays, offsets


def test_whole_job(spark, flights, lookups):
    out = pipeline.run(flights, *lookups, test_year=2023, spec=FeatureSpec(), kind="lr_baseline", k=4)
    folds = {(r.foldCol, r.split) for r in out["folds"].select("foldCol", "split").distinct().collect()}
    assert folds == {(i, s) for i in range(4) for s in ("train", "val")}
    assert out["fold_metrics"].count() == 8
    assert {r["split"] for r in out["blind_test"].collect()} == {"train", "test"}
    features = out["features"]
    assert "TAIL_NUM" not in features.columns and "ceiling_height" not in features.columns
    # only departures of the training years count
    seen = {r.ORIGIN: r.n for r in flights.filter("YEAR <> 2023").groupBy("ORIGIN").agg(F.count("*").alias("n")).collect()}
    assert {(r.ORIGIN, r.origin_yr_flights) for r in features.select("ORIGIN", "origin_yr_flights").distinct().collect()} == {
        (k, float(v)) for k, v in seen.items()}


def test_held_out_rows_change_no_training_feature(spark, flights, lookups):
    held = flights.filter("YEAR = 2023")
    more = flights.unionByName(held.withColumn("ORIGIN", F.lit("A1")).withColumn("TAIL_NUM", F.concat("TAIL_NUM", F.lit("x"))))

    def training(df):
        df = pipeline.prepare_flights(df)
        rows = pipeline.build_features(df, *lookups, known=F.col("YEAR") != 2023).filter("YEAR <> 2023")
        return sorted(map(repr, rows.select(sorted(rows.columns)).collect()))

    assert training(flights) == training(more)


def test_missing_columns_are_named(flights):
    with pytest.raises(ValueError, match="TAIL_NUM"):
        pipeline.prepare_flights(flights.drop("TAIL_NUM"))
    ready = pipeline.prepare_flights(flights.drop("AW7"))
    assert {"AW7", "FLIGHT_ID", "DEP_TS"} <= set(ready.columns)


@pytest.mark.parametrize("mode,copies", [("sequential", "full_row"), ("onepass", "row_id")])
def test_cleaning_modes(spark, flights, lookups, mode, copies):
    ready = pipeline.prepare_flights(flights.unionByName(flights.limit(50)))
    features = stage_table(pipeline.build_features(ready, *lookups, known=F.col("YEAR") != 2023), "features")
    rows = pipeline.build_training(
        features, FeatureSpec(), k=3, trim=["wind_speed"], trim_mode=mode, copies=copies)
    rows = stage_table(rows, "training")
    assert rows.count() > 0 and rows.filter("wind_speed is null").count() == 0
    keys = ["FLIGHT_ID", "foldCol"] if copies == "row_id" else [
        c for c in rows.columns if c not in ("ORIGIN", "DEST", "FL_DATE", "CANCELLED", "YEAR", "FLIGHT_ID", "DEP_TS")]
    assert rows.dropDuplicates(keys).count() == rows.count()


def test_only_copies_are_shuffled_to_drop_them(spark):
    """Ids that repeat, and rows without an id, lose their copies; a table without copies stays as it lies."""
    ids = [1, 2, 2, 3, None, None, 4, 4, 4]
    rows = [(i, fold, "x") for fold in (0, 1) for i in ids]
    df = spark.createDataFrame(rows, "id long, foldCol int, v string").repartition(5)
    source = spark.createDataFrame([(i,) for i in ids], "id long")
    got = sampling.drop_rare_copies(df, ["id", "foldCol"], "id", source)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, df.dropDuplicates(["id", "foldCol"]).collect()))
    assert "Aggregate" not in sampling.drop_rare_copies(
        df.filter("id = 1"), ["id", "foldCol"], "id", source.filter("id = 1"))._jdf.queryExecution().optimizedPlan().toString()


def test_places_of_folds_by_hand(spark):
    """Rows in order, some without a time, cut by position; equal times are told apart by id."""
    rows = [(i, None if i < 7 else f"2024-01-01 {i // 13 % 24:02d}:00:00") for i in range(260)]
    df = spark.createDataFrame(rows, "FLIGHT_ID long, t string").select(
        "FLIGHT_ID", F.col("t").cast("timestamp_ntz").alias("DEP_TS")).repartition(4)
    placed = folds.assign_folds(df, k=4).collect()
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    want = sorted(
        (order[p][0], i, "val" if p >= val else "train")
        for i, (start, val, end) in enumerate(folds.fold_ranges(len(rows), 4)) for p in range(start, end))
    assert sorted((r["FLIGHT_ID"], r["foldCol"], r["split"]) for r in placed) == want


def test_columns_that_nothing_reads_are_not_carried_into_the_history(spark, flights, monkeypatch):
    seen = []
    real = history.lag_features
    monkeypatch.setattr(history, "lag_features", lambda df, *a, **o: seen.append(df.columns) or real(df, *a, **o))
    more = pipeline.prepare_flights(flights).withColumn("note", F.lit("of no use"))
    holidays = spark.createDataFrame([(dt.date(2022, 8, 4),)], "date date")
    offsets = spark.createDataFrame([(i, float(i)) for i in range(6)], "ORIGIN_AIRPORT_ID int, UTC_offset_hours double")
    lean = pipeline.build_features(more, holidays, offsets)
    full = pipeline.build_features(more, holidays, offsets, keep_helpers=True)
    assert not {"note", "UTC_offset", "ceiling_height"} & set(seen[0]) and "note" in seen[1]
    assert lean.columns == [c for c in full.columns if c in lean.columns] and "note" not in lean.columns
    assert sorted(map(str, lean.collect())) == sorted(map(str, full.select(lean.columns).collect()))
