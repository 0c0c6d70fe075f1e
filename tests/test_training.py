import random

import numpy as np
import pytest
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import functions as F

from aerolag.operators import encode, evaluate, metrics, models, perceptrons, sampling, search
from aerolag.operators.ledger import TrialLedger, search_id
from aerolag.plans import queries_models
from aerolag.plans.catalog import QUERIES
from aerolag.schema import FeatureSpec
from aerolag.session import stage_root
from aerolag.sources import list_folder, read_table, stage_table, write_table

SPEC = FeatureSpec(one_hot=("carrier",), binary=("flag",), min_max=("x",), standard=("z",), label="y", row_id="id")


@pytest.fixture(scope="module")
def rows(spark):
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    df = spark.range(1500).select(
        "id", F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("carrier"), (F.col("id") % 2).cast("int").alias("flag"),
        F.when(F.col("id") % 17 != 0, h * 10 - 4).alias("x"), ((F.col("id") * 7) % 100).cast("double").alias("z"),
        F.when(h + (F.col("id") % 5) / 20 > 0.6, 1.0).otherwise(0.0).alias("y"))
    placed = df.withColumn("foldCol", (F.col("id") / 500).cast("int")).withColumn(
        "split", F.when(F.col("id") % 500 < 400, "train").otherwise("val"))
    return stage_table(placed, "rows")


def _conf(spark, *counts):
    return spark.createDataFrame([counts], "tp long, fp long, fn long, tn long")


def test_metric_values(spark):
    row = metrics.metrics(_conf(spark, 8, 2, 4, 6)).first()
    assert row["precision"] == pytest.approx(0.8) and row["recall"] == pytest.approx(2 / 3)
    assert row["accuracy"] == pytest.approx(0.7) and row["fbeta"] == pytest.approx(0.769231, abs=1e-6)
    p, r = row["precision"], row["recall"]
    assert row["fbeta"] == pytest.approx(1.25 * p * r / (0.25 * p + r)) and row["f1"] == pytest.approx(2 * p * r / (p + r))


def test_metrics_of_nothing(spark):
    row = metrics.metrics(_conf(spark, 0, 0, 3, 0)).first()
    assert [row[m] for m in metrics.METRICS] == [0.0] * 6


def test_counts_add_up(spark, rows):
    conf = metrics.confusion(rows.withColumn("prediction", F.col("flag").cast("double")), "y").first()
    assert sum(conf) == 1500


def test_recency_weights(spark):
    df = spark.createDataFrame([("val", 0, 0.5), ("val", 1, 0.8)], "split string, foldCol int, fbeta double")
    assert metrics.weighted_fold_mean(df, ["fbeta"]).first()["fbeta"] == pytest.approx(0.7)


def test_undersampling_balances_either_class(spark, rows):
    for df in (rows, rows.withColumn("y", 1.0 - F.col("y"))):
        n0, n1 = sampling.class_counts(sampling.undersample(df, "y", "id"), "y")
        assert abs(n0 - n1) < 0.15 * min(n0, n1)
    same = sampling.undersample(rows, "y", "id")
    again = sampling.undersample(rows.repartition(17), "y", "id")
    assert same.exceptAll(again).count() == 0 and same.count() == again.count()


def test_folds_must_be_numbered_from_zero(spark, rows):
    assert sampling.fold_numbers(rows) == [0, 1, 2]
    with pytest.raises(ValueError):
        sampling.fold_numbers(rows.filter("foldCol > 0"))


def test_encoder_width_and_names(spark, rows):
    encoded = encode.encoder_pipeline(SPEC).fit(rows).transform(rows)
    names = encode.vector_slots(encoded, SPEC)
    # Four carriers and the slot for unknown ones, the flag, and two numbers.
    assert encode.vector_width(encoded) == len(names) == 8 and names[-2:] == ["x", "z"]
    unseen = rows.limit(1).withColumn("carrier", F.lit("new"))
    assert encode.encoder_pipeline(SPEC).fit(rows).transform(unseen).first()["final_features"][4] == 1.0


def test_shift_is_learnt_and_saved(spark, rows):
    shift = encode.ShiftNonNegative(inputCols=["x", "z"], outputCols=["x2", "z2"], buffer=0.5)
    model = Pipeline(stages=[shift]).fit(rows)
    out = model.transform(rows)
    low = out.agg(F.min("x2"), F.min("z2"), F.min("z")).first()
    assert low[0] == pytest.approx(0.5) and low[1] == low[2]
    path = f"{stage_root(spark)}/shift-{spark.sparkContext.applicationId}"
    model.write().overwrite().save(path)
    below = spark.createDataFrame([(-100.0, 1.0)], "x double, z double")
    assert PipelineModel.load(path).transform(below).first()["x2"] == 0.0


@pytest.mark.parametrize("kind,params", [("lr_baseline", {}), ("nb", {}), ("rf", {"maxDepth": 4}), ("mlp1", {"maxIter": 30})])
def test_models_beat_a_constant_and_repeat(spark, rows, kind, params):
    train, test = rows.filter("foldCol < 2"), rows.filter("foldCol = 2")
    first, fitted = evaluate.blind_test(train, test, kind, SPEC, **params)
    second, _ = evaluate.blind_test(train, test, kind, SPEC, **params)
    assert first.orderBy("split").collect() == second.orderBy("split").collect()
    score = {r["split"]: r for r in first.collect()}
    assert sum(score["test"][c] for c in ("tp", "fp", "fn", "tn")) == 500
    if kind != "nb":
        share = test.agg(F.avg("y")).first()[0]
        assert score["test"]["accuracy"] > max(share, 1 - share) + 0.1
    if kind in ("lr_baseline", "rf"):
        assert evaluate.model_importance(fitted, train, SPEC).first()["feature"] == "x"


def test_permutation_finds_the_driver(spark, rows):
    _, fitted = evaluate.blind_test(rows, rows, "lr_baseline", SPEC)
    table = evaluate.permutation_importance(fitted, rows, SPEC)
    assert table.first()["feature"] == "x" and table.count() == 4


def test_search_records_failures_and_prunes(spark, rows):
    space = {"smoothing": search.Choice((1.0, -5.0, 2.0))}
    table = search.random_search(rows, "nb", SPEC, trials=6, space=space, startup=1, parallelism=1)
    got = table.collect()
    assert len(got) == 6
    failed = [r for r in got if r["status"] == "failed"]
    assert all(r["failure_reason"] and r["params"]["smoothing"] == "-5.0" for r in failed)
    done = [r for r in got if r["status"] == "complete"]
    assert done and all(r["folds_run"] == 3 and len(r["fold_metrics"]) == 6 for r in done)
    folds = search.trial_folds(table)
    assert folds.columns == ["trial", "foldCol", "split", "metric", "value"]


def test_forward_groups_grow(spark, rows):
    groups = {"numbers": ("x",), "rest": ("carrier", "flag", "z")}
    table = search.forward_groups(rows, "lr_baseline", SPEC, groups).collect()
    assert [(r["step"], r["columns"]) for r in table] == [(0, 1), (0, 1), (1, 4), (1, 4)]


def test_encoders_learn_from_the_fold_only(spark, rows):
    inside = evaluate.encoded_folds(rows, SPEC)
    leaky = evaluate.encoded_folds(rows, SPEC, per_fold=False)
    assert len(inside) == len(leaky) == 3
    assert inside[0]["train"].first()["final_features"] != leaky[0]["train"].first()["final_features"]


def test_tables_are_checked_and_not_overwritten(spark, rows):
    path = f"{stage_root(spark)}/t-{spark.sparkContext.applicationId}"
    write_table(rows.select("id", "x"), path)
    with pytest.raises(Exception):
        write_table(rows.select("id"), path)
    assert read_table(spark, path, rows.select("x").schema).columns == ["x"]
    with pytest.raises(ValueError, match="expected string"):
        read_table(spark, path, rows.select(F.col("x").cast("string")).schema)
    assert list_folder(spark, path).filter(F.col("length") > 0).count() > 0


def test_many_folds_are_all_seen(spark):
    many = spark.range(20_000).selectExpr("cast(id AS int) AS foldCol")
    assert sampling.fold_numbers(many) == list(range(20_000))
    with pytest.raises(ValueError, match="numbered"):
        sampling.fold_numbers(many.filter("foldCol <> 7"))


def test_search_is_repeatable_and_gives_parameters_back(spark, rows):
    space = {"smoothing": search.Real(0.1, 5.0), "impute": search.Choice(("mean", "median"))}
    runs = [search.random_search(rows, "nb", SPEC, trials=5, space=space, startup=2, parallelism=n) for n in (1, 3)]
    assert runs[0].collect() == runs[1].collect()
    best = search.best_trial(runs[0], "nb", space=space)
    assert isinstance(best["smoothing"], float) and best["impute"] in ("mean", "median")


def test_search_goes_on_where_it_stopped(spark, rows, monkeypatch):
    """A driver lost in the third fold: only what is missing is fitted, and the table is the same."""
    space = {"smoothing": search.Choice((1.0, -5.0, 2.0, 1e6))}
    options = {"trials": 6, "space": space, "startup": 2, "parallelism": 2}
    whole = search.random_search(rows, "nb", SPEC, **options).collect()
    path = f"{stage_root(spark)}/ledger-{spark.sparkContext.applicationId}"
    assert TrialLedger(spark, path).table().count() == 0
    real, fits = search.fit_folds, []

    def breaks(parts, kind, spec, **params):
        if len(fits) >= limit:
            raise RuntimeError("driver lost")
        fits.append(params["smoothing"])
        return real(parts, kind, spec, **params)

    monkeypatch.setattr(search, "fit_folds", breaks)
    limit = sum(1 for r in whole if r["status"] == "failed") + 2 * sum(1 for r in whole if r["folds_run"] > 1)
    with pytest.raises(RuntimeError):
        search.random_search(rows, "nb", SPEC, ledger=path, **options)
    before, limit = len(fits), 1000
    assert search.random_search(rows, "nb", SPEC, ledger=path, **options).collect() == whole
    recorded = TrialLedger(spark, path).table().count()
    assert recorded == len(fits) == sum(max(1, r["folds_run"]) for r in whole) > before > 0
    assert search.random_search(rows, "nb", SPEC, ledger=path, **options).collect() == whole
    assert len(fits) == recorded
    # More trials reuse those before; other rows are another search.
    more = search.random_search(rows, "nb", SPEC, ledger=path, **{**options, "trials": 7})
    assert more.count() == 7 and len(fits) - recorded == max(1, more.filter("trial = 6").first()["folds_run"])
    names = {search_id(df, "nb", SPEC, seed=1) for df in (rows, rows.repartition(3), rows.filter("id > 0"))}
    assert len(names) == 2


def test_trial_records_cover_every_outcome(spark):
    got = QUERIES["trial_records"](spark, "/root/testdata/sf0.001").collect()
    assert {r["outcome"] for r in got} == {"complete", "pruned", "failed"}
    assert all((r["val_fbeta"] is None) == (r["status"] == "failed") == (r["outcome"] == "failed") for r in got)


def test_grid_covers_perceptrons_and_folds_without_a_value(spark, rows):
    # A carrier that only the last fold has makes the other folds' vectors wider than its own.
    rare = rows.withColumn("carrier", F.when(F.col("id") >= 1490, F.lit("rare")).otherwise(F.col("carrier")))
    grid = [{"maxIter": n, "blockSize": 64, "hidden": (2,)} for n in (1, 30)]
    got = search.grid_folds(rare, "mlp1", SPEC, grid, parallelism=2).collect()
    assert len(got) == 2 and got[0]["mean"] >= got[1]["mean"] and all(0 <= r["mean"] <= 1 for r in got)
    whole = queries_models.perceptron_grid(84)
    assert len(whole) == 27
    assert {name: {p[name] for p in whole} for name in whole[0]} == {
        "maxIter": {10, 50, 100}, "blockSize": {64, 128, 256}, "hidden": {(21,), (42,), (84,)}}


def test_grid_fits_rows_in_few_partitions_whatever_their_layout(spark, rows, monkeypatch):
    """Each iteration is a job: rows must not come in more tasks than they fill, nor with the plan that made them."""
    seen = []
    real = search.make_model

    class Watched:
        def __init__(self, model):
            self.model = model

        def fit(self, df):
            rdd = df.rdd
            seen.append((df.count(), rdd.getNumPartitions(), rdd.toDebugString().decode().count("ShuffledRowRDD")))
            return self.model.fit(df)

    monkeypatch.setattr(search, "make_model", lambda *a, **p: Watched(real(*a, **p)))
    monkeypatch.setattr(search, "DEALT_ROWS", 500)
    grid = [{"maxIter": n, "blockSize": 64, "hidden": (2,)} for n in (3, 20)]
    found = [
        {r["params"]["maxIter"]: r["mean"] for r in search.grid_folds(df, "mlp1", SPEC, grid).collect()}
        for df in (rows.repartition(7), rows.coalesce(1))
    ]
    assert found[0] == pytest.approx(found[1], abs=1e-9) and set(found[0]) == {"3", "20"}
    assert all(parts == -(-n // 500) and shuffles >= 1 for n, parts, shuffles in seen)


def test_perceptrons_fitted_together_are_those_of_spark(spark, rows, monkeypatch):
    """Every point of a grid gets the weights that a fit of its own gives, with short last blocks and any number of layers."""
    encoded = encode.encoder_pipeline(SPEC).fit(rows).transform(rows)
    dealt = search._dealt(encoded, SPEC, 4 * search.DEALT_ROWS).cache()
    one = spark.createDataFrame(dealt.limit(1).collect(), dealt.schema)
    grid = [{"maxIter": n, "blockSize": block, "hidden": hidden}
            for n in (0, 3, 12) for block in (1, 64, 2000) for hidden in ((3,), (4, 3, 2))]
    tried = [models.make_model("mlp1", SPEC, encode.vector_width(encoded), **point) for point in grid]
    assert all(perceptrons.fits_together(m) for m in tried) and not perceptrons.fits_together(tried[0].copy().setSolver("gd"))
    assert perceptrons.weights_of_all([], dealt, one) == []
    alone = [m.fit(dealt).weights.toArray() for m in tried]
    together = perceptrons.weights_of_all(tried, dealt, one)
    monkeypatch.setattr(perceptrons, "FEW_PARTITIONS", 1)
    added_by_tasks = perceptrons.weights_of_all(tried[:6], dealt, one)
    for point, a, b in [*zip(grid, alone, together), *zip(grid, alone, added_by_tasks)]:
        assert b == pytest.approx(a, rel=1e-6, abs=1e-8), point
    model = perceptrons.scorer(tried[-1], together[-1], one)
    assert model.weights.toArray().tolist() == together[-1].tolist()
    with pytest.raises(Exception, match="whole numbers"):
        perceptrons.weights_of_all(tried[:1], dealt.withColumn("y", F.lit(2.0)), one)


def test_line_search_that_fails_ends_a_way():
    """Losses that never fall: once more along the slope, then the weights stay, as for a loss that is flat at once."""
    def walked(loss):
        walk = perceptrons._descend(np.ones(2), [0, 4], 1e-6)
        at = next(walk)
        for n in range(500):
            try:
                at = walk.send(loss(n, at))
            except StopIteration as end:
                return end.value, n

    stuck, asked = walked(lambda n, at: (float(n), np.ones(2)))
    assert asked > 10 and stuck[4].tolist() == [1.0, 1.0]
    flat, asked = walked(lambda n, at: (1.0, np.zeros(2)))
    assert asked == 0 and flat[4].tolist() == [1.0, 1.0]
    bowl, _ = walked(lambda n, at: (float(at @ at), 2 * at))
    assert bowl[0].tolist() == [1.0, 1.0] and abs(bowl[4]).max() < 1e-6


def test_grid_takes_a_step_of_all_perceptrons_per_job(spark, rows):
    """A job per step and point kept a grid from ending: points of a fold share theirs."""
    grid = [{"maxIter": n, "blockSize": block, "hidden": (2,)} for n in (5, 20, 40) for block in (32, 64, 128, 256)]
    spark.sparkContext.setJobGroup("grid-steps", "grid")
    try:
        got = search.grid_folds(rows, "mlp1", SPEC, grid, parallelism=2).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {tuple(sorted(r["params"].items())) for r in got} == {
        tuple(sorted((k, str(v)) for k, v in point.items())) for point in grid}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("grid-steps"))
    assert 0 < jobs < 3 * sum(point["maxIter"] for point in grid) * 0.7


def test_query_searches_whole_grid_and_all_trials(spark, rows, monkeypatch):
    seen = {}
    monkeypatch.setattr(queries_models, "training_rows", lambda s, d: rows)
    monkeypatch.setattr(queries_models, "training_folds", lambda s, d: rows)
    monkeypatch.setattr(queries_models, "held_out", lambda s, d: rows)
    monkeypatch.setattr(queries_models, "SPEC", SPEC)
    monkeypatch.setattr(search, "grid_folds", lambda df, kind, spec, grid, **o: seen.update(kind=kind, grid=grid))
    real = search.random_search
    monkeypatch.setattr(search, "random_search", lambda *a, **o: seen.update(trials=real(*a, **o)) or seen["trials"])
    QUERIES["grid_search"](spark, "")
    assert seen["kind"] == "mlp1" and len(seen["grid"]) == 27
    QUERIES["search_then_blind_test"](spark, "")
    assert seen["trials"].count() == 10


def test_exact_area_under_the_curve(spark):
    """All pairs by hand, with ties, missing scores and a single class."""
    rng = random.Random(6)
    rows = [(float(rng.random() < 0.3), rng.choice([0.1, 0.2, 0.5, 0.5, 0.9, rng.random()]), float(rng.random() < 0.5)) for _ in range(400)]
    rows += [(None, 0.3, 1.0), (1.0, None, 1.0), (0.0, 0.2, None)]
    df = spark.createDataFrame(rows, "DEP_DEL15 double, s double, prediction double").repartition(7)
    got = metrics.ranking_table(df, "s").first()
    whole = [r for r in rows if None not in r]
    pos, neg = ([s for y, s, _ in whole if y == c] for c in (1.0, 0.0))
    area = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got["auc_roc"] == pytest.approx(area, abs=1e-12)

    def f1(c):
        tp = sum(y == c == p for y, _, p in whole)
        return 2 * tp / (sum(y == c for y, _, _ in whole) + sum(p == c for _, _, p in whole))

    assert got["f1_macro"] == pytest.approx((f1(1.0) + f1(0.0)) / 2)
    assert got["f1_weighted"] == pytest.approx((f1(1.0) * len(pos) + f1(0.0) * len(neg)) / len(whole))
    assert metrics.ranking_table(df.filter("DEP_DEL15 = 1"), "s").first()["auc_roc"] is None


def test_perceptron_encoders_are_fitted_once(spark, rows):
    """The pipeline holds fitted encoders and an open classifier; another kind holds open encoders."""
    stages = models.model_pipeline("mlp1", SPEC, rows).getStages()
    assert isinstance(stages[-1], Estimator) and not any(isinstance(s, Estimator) for s in stages[:-1])
    assert any(isinstance(s, Estimator) for s in models.model_pipeline("lr", SPEC, rows).getStages()[:-1])


def test_forest_keeps_the_nodes_of_rows(spark, rows):
    """Rows are not led down from the roots at every level; the trees are those of a plain forest."""
    encoded = encode.encoder_pipeline(SPEC).fit(rows).transform(rows)
    keeps, plain = (models.make_model("rf", SPEC, **o) for o in ({}, {"cacheNodeIds": False}))
    assert keeps.getCacheNodeIds() and not plain.getCacheNodeIds()
    assert keeps.fit(encoded).toDebugString.split("\n")[1:] == plain.fit(encoded).toDebugString.split("\n")[1:]


def test_fold_is_held_apart_for_all_choices(spark, rows, monkeypatch):
    """The rows of a fold are held once, however many groups are tried, and the figures are those of each choice alone."""
    held, real = [], evaluate.held
    monkeypatch.setattr(evaluate, "held", lambda *frames: held.extend(frames) or real(*frames))
    specs = [SPEC.only("x"), SPEC]
    both = evaluate.cross_validate_specs(rows, "lr_baseline", specs)
    assert len(held) == 1 + 3
    assert [{r["foldCol"] for r in f.select("foldCol").distinct().collect()} for f in held[1:]] == [{0}, {1}, {2}]
    for spec, table in zip(specs, both):
        alone = evaluate.fit_folds(evaluate.encoded_folds(rows, spec), "lr_baseline", spec)
        assert [r.asDict() for r in table.orderBy("foldCol", "split").collect()] == [
            {k: r[k] for k in table.columns} for r in sorted(alone, key=lambda r: (r["foldCol"], r["split"]))]
