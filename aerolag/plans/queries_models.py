"""Queries: feature table, encoders, models and search."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolag.operators import evaluate, folds, graph, metrics, search
from aerolag.operators.encode import ShiftNonNegative, encoder_pipeline, vector_slots, vector_width
from aerolag.operators.ledger import TrialLedger
from aerolag.operators.models import model_pipeline
from aerolag.operators.sampling import prepare_test
from aerolag.plans import inputs, pipeline
from aerolag.plans.oracle import HELD_OUT_FROM, metrics_sql, sql
from aerolag.plans.queries_profile import parsed
from aerolag.plans.queries_training import fold_metrics
from aerolag.plans.registry import query, rounded
from aerolag.schema import FeatureSpec
from aerolag.session import stage_root
from aerolag.sources.stage import stage_table
from aerolag.sources.tables import read_many, read_table, write_csv, write_table

SPEC = FeatureSpec()
_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def feature_table(spark: SparkSession, d: str) -> DataFrame:
    """Flights with all features. The data covers one month, so the season
    that centrality lags by is the day."""
    return pipeline.build_features(
        inputs.weather_flights(spark, d), inputs.flight_holidays(spark, d), inputs.utc_lookup(spark, d),
        known=~_held_out(), season="DAY_OF_MONTH", period=31, rank_tol=1e-9,
    )


def _held_out() -> Column:
    return F.col("DEP_TS") >= F.lit(HELD_OUT_FROM).cast("timestamp_ntz")


def _staged(spark: SparkSession, d: str, name: str, build) -> DataFrame:
    """Build once per application; later queries read the stage table."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _STAGES:
        _STAGES[key] = stage_table(build(), name)
    return _STAGES[key]


def staged_features(spark: SparkSession, d: str) -> DataFrame:
    return _staged(spark, d, "features", lambda: feature_table(spark, d))


def training_folds(spark: SparkSession, d: str, k: int = 8) -> DataFrame:
    """Balanced folds of what is not held out."""
    return _staged(spark, d, f"folds-{k}", lambda: pipeline.build_training(
        staged_features(spark, d).filter(~_held_out()), SPEC, k=k))


def training_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training rows once each; those of two folds with the first of them."""
    first = Window.partitionBy(SPEC.row_id).orderBy("foldCol")
    rows = training_folds(spark, d).withColumn("__n", F.row_number().over(first))
    return rows.filter("__n = 1").drop("__n")


def held_out(spark: SparkSession, d: str) -> DataFrame:
    """The last week, as it comes."""
    return prepare_test(staged_features(spark, d).filter(_held_out()))


def stage_inputs(spark: SparkSession, d: str) -> None:
    """Build what the model queries read, so that none of them pays for it."""
    training_folds(spark, d)


_FEATURES = ("FLIGHT_ID", *SPEC.features, SPEC.label)
_DOUBLES = {*SPEC.numeric, SPEC.label}


@query("feature_table", sql("SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in _FEATURES) + " FROM features", "features"))
def _(spark, d):
    return rounded(feature_table(spark, d).select(*_FEATURES))


@query("training_folds")
def _(spark, d):
    return training_folds(spark, d).groupBy("foldCol", "split", SPEC.label).agg(F.count("*").alias("n"))


_SMALL = FeatureSpec(one_hot=(), binary=(), min_max=("visibility", "DISTANCE"), standard=("temperature", "wind_direction"))


def _minmax_sql(c: str) -> str:
    v = f"coalesce({c}, (SELECT avg({c}) FROM parsed))"
    return f"round(({v} - (SELECT min({c}) FROM parsed)) / (SELECT max({c}) - min({c}) FROM parsed), 6) AS {c}_scaled"


def _standard_sql(c: str) -> str:
    filled = f"(SELECT coalesce({c}, (SELECT avg({c}) FROM parsed)) AS v FROM parsed)"
    return (f"round((coalesce({c}, (SELECT avg({c}) FROM parsed)) - (SELECT avg(v) FROM {filled}))"
            f" / (SELECT stddev_samp(v) FROM {filled}), 6) AS {c}_scaled")


@query("impute_scale", sql("SELECT FLIGHT_ID, " + ", ".join(
    [_minmax_sql(c) for c in _SMALL.min_max] + [_standard_sql(c) for c in _SMALL.standard]) + " FROM parsed", "parsed"))
def _(spark, d):
    table = parsed(spark, d)
    encoded = encoder_pipeline(_SMALL).fit(table).transform(table)
    vector = vector_to_array("final_features")
    return rounded(encoded.select("FLIGHT_ID", *[vector[i].alias(f"{c}_scaled") for i, c in enumerate(_SMALL.numeric)]))


@query("impute_median", sql("""
    SELECT FLIGHT_ID, round(coalesce(temperature, (SELECT quantile_disc(temperature, 0.5) FROM parsed)), 6) AS temperature
    FROM parsed""", "parsed"))
def _(spark, d):
    table = parsed(spark, d)
    only = _SMALL.only("temperature")
    encoded = encoder_pipeline(only, impute="median", median_error=1e-5).fit(table).transform(table)
    return rounded(encoded.select("FLIGHT_ID", F.col("temperature_imputed").alias("temperature")))


@query("one_hot", sql("""
    SELECT FLIGHT_ID, f.OP_UNIQUE_CARRIER, i AS index, cast(i + 1 AS bigint) AS slot, 13 AS slots
    FROM flights f JOIN (SELECT OP_UNIQUE_CARRIER,
        cast(row_number() OVER (ORDER BY count(*) DESC, OP_UNIQUE_CARRIER) - 1 AS double) AS i
      FROM flights GROUP BY 1) USING (OP_UNIQUE_CARRIER)""", "flights"))
def _(spark, d):
    table = inputs.flights(spark, d)
    spec = SPEC.only("OP_UNIQUE_CARRIER")
    encoded = encoder_pipeline(spec).fit(table).transform(table)
    slots = vector_to_array("final_features")
    return encoded.select(
        "FLIGHT_ID", "OP_UNIQUE_CARRIER", F.col("OP_UNIQUE_CARRIER_index").alias("index"),
        F.array_position(slots, 1.0).alias("slot"), F.size(slots).alias("slots"),
    )


@query("shift_non_negative", sql("""
    SELECT FLIGHT_ID, round(temperature - (SELECT min(temperature) FROM parsed) + 1, 6) AS temperature,
      round(visibility, 6) AS visibility FROM parsed""", "parsed"))
def _(spark, d):
    table = parsed(spark, d).select("FLIGHT_ID", F.col("temperature").alias("t"), F.col("visibility").alias("v"))
    shift = ShiftNonNegative(inputCols=["t", "v"], outputCols=["temperature", "visibility"], buffer=1.0)
    return rounded(shift.fit(table).transform(table).select("FLIGHT_ID", "temperature", "visibility"))


@query("vector_slots")
def _(spark, d):
    features = staged_features(spark, d).filter("pagerank is not null")
    encoded = encoder_pipeline(SPEC).fit(features).transform(features)
    rows = [(i, n) for i, n in enumerate(vector_slots(encoded, SPEC))]
    return spark.createDataFrame(rows, "slot int, name string")


def _fit_score(kind: str, **params):
    def run(spark: SparkSession, d: str) -> DataFrame:
        found, _ = evaluate.blind_test(training_folds(spark, d), held_out(spark, d), kind, SPEC, **params)
        return rounded(found)

    return run


for _name, _kind in (
    ("lr_baseline_fit_score", "lr_baseline"), ("blind_test", "lr"), ("nb_fit_score", "nb"), ("mlp_fit_score", "mlp1"),
    ("mlp_two_layer_fit_score", "mlp2"), ("rf_fit_score", "rf"), ("gbt_fit_score", "gbt"),
):
    query(_name)(_fit_score(_kind))
query("lr_fit_score")(_fit_score("lr", threshold=0.5))


@query("model_threshold_sweep")
def _(spark, d):
    train = training_rows(spark, d)
    fitted = model_pipeline("lr", SPEC, train).fit(train)
    scored = metrics.positive_probability(fitted.transform(held_out(spark, d)))
    return rounded(metrics.threshold_sweep(scored, [0.5, 0.6, 0.7], SPEC.label))


@query("ranking_scores")
def _(spark, d):
    train = training_rows(spark, d)
    fitted = model_pipeline("lr", SPEC, train).fit(train)
    found = metrics.ranking_scores(fitted.transform(held_out(spark, d)), SPEC.label)
    return spark.createDataFrame(list(found.items()), "metric string, value double")


@query("cross_validate")
def _(spark, d):
    return rounded(evaluate.cross_validate(training_folds(spark, d), "lr_baseline", SPEC))


@query("random_search")
def _(spark, d):
    trials = search.random_search(training_folds(spark, d), "nb", SPEC)
    return trials.select("trial", "status", "failure_reason", "params", "folds_run", "train_fbeta", "val_fbeta")


def perceptron_grid(width: int) -> list[dict]:
    """Iterations, block sizes and hidden layers (a quarter, a half and all of the vector's width).

    Step sizes are left out: the default solver does not use one.
    """
    # Iterations and block sizes of the grid.
    return [
        {"maxIter": n, "blockSize": block, "hidden": (hidden,)}
        for n in (10, 50, 100) for block in (64, 128, 256) for hidden in (width // 4, width // 2, width)
    ]


@query("grid_search")
def _(spark, d):
    """The encoders are part of what is fitted, so held-out folds stay unseen."""
    train = training_rows(spark, d)
    width = vector_width(encoder_pipeline(SPEC).fit(train).transform(train))
    return search.grid_folds(train, "mlp1", SPEC, perceptron_grid(width), parallelism=4)


@query("forward_group_selection")
def _(spark, d):
    return rounded(search.forward_groups(training_folds(spark, d), "lr_baseline", SPEC))


@query("search_then_blind_test")
def _(spark, d):
    """The best trial of a search, fitted on all training rows and tested blind."""
    train = training_folds(spark, d)
    best = search.best_trial(search.random_search(train, "nb", SPEC), "nb")
    found, _ = evaluate.blind_test(train, held_out(spark, d), "nb", SPEC, **best)
    return rounded(found)


@query("feature_importance")
def _(spark, d):
    train = training_rows(spark, d)
    fitted = model_pipeline("rf", SPEC, train).fit(train)
    return evaluate.model_importance(fitted, train, SPEC)


@query("coefficient_importance")
def _(spark, d):
    train = training_rows(spark, d)
    return evaluate.model_importance(model_pipeline("lr", SPEC, train).fit(train), train, SPEC)


@query("class_probability_importance")
def _(spark, d):
    train = training_rows(spark, d)
    return evaluate.model_importance(model_pipeline("nb", SPEC, train).fit(train), train, SPEC)


@query("permutation_importance")
def _(spark, d):
    train = training_rows(spark, d)
    fitted = model_pipeline("mlp1", SPEC, train).fit(train)
    return evaluate.permutation_importance(fitted, held_out(spark, d), SPEC, list(SPEC.features))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@query("yearly_files", sql('SELECT "YEAR", "QUARTER", src, dst, flights FROM edges', "edges"))
def _(spark, d):
    """Edges written in two folders by year and read back as one table."""
    edges = graph.season_edges(inputs.routes(spark, d))
    paths = [_folder(spark, "early"), _folder(spark, "late")]
    write_table(edges.filter("YEAR <= 1998"), paths[0])
    write_table(edges.filter("YEAR > 1998"), paths[1], mode="overwrite")
    return read_many(spark, paths, read_table(spark, paths[0]).schema)


@query("csv_sink", sql(f"SELECT foldCol, split, {metrics_sql()} FROM fold_confusion", "fold_confusion"))
def _(spark, d):
    """Fold metrics written as CSV and read back."""
    table = rounded(fold_metrics(spark, d)).select("foldCol", "split", *metrics.METRICS)
    path = _folder(spark, "csv")
    write_csv(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


# Two columns that tell late flights apart, for a model that SQL can follow.
TRIED = FeatureSpec(one_hot=(), binary=(), min_max=("DISTANCE", "ARR_DELAY"), standard=())
TRIED_SPACE = {"smoothing": search.Choice((0.5, 1e5, 3e6, 1e9, -1.0))}
TRIALS, STARTUP = 8, 2


def _bayes_sql() -> str:
    """The search's trials by hand: Naive Bayes per trial and fold, and which trials stop where."""
    drawn = ", ".join(f"({t}, {p['smoothing']!r}::double)" for t, p in enumerate(search.draws(TRIED_SPACE, TRIALS)))
    both = [f"{s}_{m}" for s in ("train", "val") for m in metrics.METRICS]
    exact = metrics_sql().replace("round(", "(").replace(", 6)", ")")
    return f"""{sql('', 'folds')},
    drawn(trial, smoothing) AS (VALUES {drawn}),
    plain AS (SELECT foldCol, split, DEP_DEL15 AS y, DISTANCE AS a, ARR_DELAY AS b FROM folds WHERE DEP_DEL15 IS NOT NULL),
    moves AS (SELECT foldCol, CASE WHEN min(b) < 0 THEN 1 - min(b) ELSE 0 END AS move FROM plain
      WHERE split = 'train' GROUP BY foldCol),
    moved AS (SELECT foldCol, split, y, a, greatest(b + move, 0) AS b FROM plain JOIN moves USING (foldCol)),
    learnt AS (SELECT trial, foldCol, y, ln(n + smoothing) AS prior,
        ln(sa + smoothing) - ln(sa + sb + 2 * smoothing) AS wa, ln(sb + smoothing) - ln(sa + sb + 2 * smoothing) AS wb
      FROM (SELECT foldCol, y, count(*) AS n, sum(a) AS sa, sum(b) AS sb FROM moved WHERE split = 'train' GROUP BY ALL), drawn
      WHERE smoothing >= 0),
    told AS (SELECT l1.trial, m.foldCol, split, m.y,
        CASE WHEN l1.prior + a * l1.wa + b * l1.wb > l0.prior + a * l0.wa + b * l0.wb THEN 1 ELSE 0 END AS p
      FROM moved m JOIN learnt l1 ON l1.foldCol = m.foldCol AND l1.y = 1
        JOIN learnt l0 ON l0.foldCol = m.foldCol AND l0.y = 0 AND l0.trial = l1.trial),
    counted AS (SELECT trial, foldCol, split, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
        count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn FROM told GROUP BY ALL),
    exact AS (SELECT trial, foldCol, split, {exact} FROM counted),
    wide AS (SELECT trial, foldCol, {', '.join(
        f"max({m}) FILTER (split = '{s}') AS {s}_{m}" for s in ('train', 'val') for m in metrics.METRICS)}
      FROM exact GROUP BY ALL),
    curves AS (SELECT *, sum(val_fbeta * (foldCol + 1)) OVER upto / sum(foldCol + 1) OVER upto AS goal FROM wide
      WINDOW upto AS (PARTITION BY trial ORDER BY foldCol)),
    starters AS (SELECT trial FROM drawn WHERE smoothing >= 0 ORDER BY trial LIMIT {STARTUP}),
    middles AS (SELECT foldCol, median(goal) AS middle FROM curves WHERE trial IN (FROM starters) GROUP BY foldCol),
    ends AS (SELECT trial, min(foldCol) AS last FROM curves JOIN middles USING (foldCol)
      WHERE goal < middle AND foldCol < 7 AND trial NOT IN (FROM starters) GROUP BY trial)
    SELECT trial, foldCol, 'scored' AS status, CASE WHEN last IS NULL THEN 'complete' ELSE 'pruned' END AS outcome,
      smoothing, {', '.join(f'round({c}, 6) AS {c}' for c in both)}
    FROM curves JOIN drawn USING (trial) LEFT JOIN ends USING (trial) WHERE last IS NULL OR foldCol <= last
    UNION ALL SELECT trial, 0, 'failed', 'failed', smoothing, {', '.join('NULL' for _ in both)}
    FROM drawn WHERE smoothing < 0"""


@query("trial_records", _bayes_sql())
def _(spark, d):
    """The ledger of a search: a record per trial and fold, with what became of the trial."""
    placed = stage_table(folds.assign_folds(inputs.flights(spark, d)), "tried")
    path = _folder(spark, "trials")
    trials = search.random_search(
        placed, "nb", TRIED, trials=TRIALS, space=TRIED_SPACE, startup=STARTUP, parallelism=4, ledger=path)
    outcome = trials.select("trial", F.col("status").alias("outcome"))
    kept = [f"{s}_{m}" for s in ("train", "val") for m in metrics.METRICS]
    records = TrialLedger(spark, path).table().withColumn("smoothing", F.col("params.smoothing").cast("double"))
    return rounded(records.join(outcome, "trial").select("trial", "foldCol", "status", "outcome", "smoothing", *kept))
