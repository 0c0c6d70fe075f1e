"""Hyper-parameter search and feature selection over folds."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from statistics import mean, median, pstdev

from pyspark import inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.operators.encode import FEATURES, encoder_pipeline, vector_width
from aerolag.operators.evaluate import cross_validate_specs, encoded_fold, fit_folds
from aerolag.operators.ledger import TrialLedger, search_id
from aerolag.operators.metrics import METRICS, weighted_fold_mean
from aerolag.operators.models import make_model, scaling_for
from aerolag.operators.perceptrons import fits_together, scorer, weights_of_all
from aerolag.operators.sampling import fold_numbers
from aerolag.schema import FEATURE_GROUPS, FeatureSpec
from aerolag.sources.stage import held
from aerolag.sources.tables import records_table


@dataclass(frozen=True)
class Whole:
    """Whole numbers of a closed range."""

    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.low, self.high)


@dataclass(frozen=True)
class Real:
    """Numbers of a range, spread evenly or by order of magnitude."""

    low: float
    high: float
    log: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.log:
            return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class Choice:
    """One of several values."""

    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


@dataclass(frozen=True)
class Layers:
    """Sizes of hidden layers."""

    sizes: tuple[Whole, ...]

    def draw(self, rng: random.Random) -> tuple[int, ...]:
        return tuple(s.draw(rng) for s in self.sizes)


def space_for(kind: str, width: int = 85) -> dict:
    """The ranges searched per kind of model. The step size of a perceptron is
    left out: its default solver does not use one."""
    # Ranges per hyper-parameter.
    return {
        "mlp1": {"hidden": Layers((Whole(10, 2 * width),)), "maxIter": Whole(10, 100)},
        "mlp2": {"hidden": Layers((Whole(10, 2 * width), Whole(10, width))), "maxIter": Whole(10, 100),
                 "blockSize": Whole(50, 128)},
        "lr": {"elasticNetParam": Real(0.0, 1.0), "regParam": Choice((0.0, 0.001, 0.01, 0.1, 1.0)),
               "threshold": Choice((0.5, 0.6, 0.7)), "impute": Choice(("mean", "median"))},
        "nb": {"smoothing": Real(0.01, 10.0, log=True), "impute": Choice(("mean", "median"))},
        "rf": {"numTrees": Whole(10, 30), "maxDepth": Whole(3, 20),
               "featureSubsetStrategy": Choice(("auto", "sqrt", "log2")), "minInstancesPerNode": Whole(1, 20),
               "impurity": Choice(("gini", "entropy")), "minInfoGain": Real(0.0, 1.0)},
        "gbt": {"maxIter": Whole(10, 30), "maxDepth": Whole(3, 20), "subsamplingRate": Real(0.1, 1.0)},
    }[kind]


TRIAL_SCHEMA = (
    "trial int, status string, failure_reason string, params map<string,string>, folds_run int, "
    + ", ".join(f"{split}_{m} double" for split in ("train", "val") for m in METRICS)
    + ", fold_metrics array<struct<foldCol:int,split:string,"
    + ",".join(f"{m}:double" for m in METRICS) + ">>"
)


def _recency_means(done: Sequence[Mapping]) -> dict[str, float]:
    means = {}
    for split in ("train", "val"):
        rows = [r for r in done if r["split"] == split]
        weight = sum(r["foldCol"] + 1 for r in rows)
        for m in METRICS:
            means[f"{split}_{m}"] = sum(r[m] * (r["foldCol"] + 1) for r in rows) / weight
    return means


def draws(space: Mapping, trials: int, seed: int = 42) -> list[dict]:
    """Parameters of each trial; they depend on the seed and the trial number only."""
    drawn = []
    for t in range(trials):
        rng = random.Random(seed * 1_000_003 + t)
        drawn.append({name: p.draw(rng) for name, p in space.items()})
    return drawn


def _as_text(params: Mapping) -> dict[str, str]:
    return {k: str(v) for k, v in params.items()}


def random_search(
    df: DataFrame,
    kind: str,
    spec: FeatureSpec,
    trials: int = 10,
    space: Mapping | None = None,
    goal: str = "val_fbeta",
    seed: int = 42,
    parallelism: int = 2,
    startup: int = 5,
    ledger: str | None = None,
    **fixed,
) -> DataFrame:
    """Try drawn parameters over the folds; one row per trial, best first.

    All trials fit one fold before any fits the next, so only one fold's encoded
    rows are held at a time. Draws depend on the seed and the trial number only. A
    trial whose parameters the model refuses is recorded with its reason and
    the search goes on; any other error ends the search. The first ``startup``
    trials that do not fail see all folds; another one stops after the fold at
    which its running goal falls below the median of theirs. The same search
    therefore gives the same table on any cluster.

    With a folder named ``ledger`` each trial's scores on a fold are recorded
    there as soon as they are known. The same search on the same rows takes
    what it finds there and fits the rest only, so one that lost its driver goes on
    where it stopped, and one with more trials reuses those before. A fold whose
    trials are all recorded is not encoded. Give staged rows.

    Each trial's jobs run in a scheduler pool of their own, which shares the
    cluster evenly where ``spark.scheduler.mode`` is FAIR, and in a job group
    named after the trial.
    """
    df = df.filter(F.col(spec.label).isNotNull())
    spark = df.sparkSession
    space = space_for(kind) if space is None else space
    drawn = draws(space, trials, seed)
    done: list[list[dict]] = [[] for _ in drawn]
    curves: list[list[float]] = [[] for _ in drawn]
    reasons: dict[int, str] = {}
    stopped: set[int] = set()

    with held(df):
        book, name, known = None, "search", {}
        if ledger is not None:
            book = TrialLedger(spark, ledger)
            name = search_id(df, kind, spec, space=space, seed=seed, fixed=fixed)
            known = book.found(name)
        numbers = fold_numbers(df)
        # Trials only wait for Spark jobs; the scheduler shares the cluster among them.
        pool = ThreadPool(max(1, min(parallelism, trials)))
        try:
            for i in numbers:
                active = [t for t in range(trials) if t not in reasons and t not in stopped]
                missing = [t for t in active if (t, i) not in known]
                encoded = {
                    impute: encoded_fold(df, i, spec, impute, scaling_for(kind))
                    for impute in sorted({drawn[t].get("impute", "mean") for t in missing})
                }

                def run(t: int, i: int = i, encoded: Mapping = encoded) -> list[dict] | str:
                    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{t}")
                    spark.sparkContext.setJobGroup(f"{name}-{t}", f"trial {t}, fold {i}")
                    params = dict(drawn[t])
                    part = encoded[params.pop("impute", "mean")]
                    try:
                        rows = [{**r, "foldCol": i} for r in fit_folds([part], kind, spec, **{**fixed, **params})]
                    except (IllegalArgumentException, TypeError, ValueError) as e:
                        rows = re.sub(r"_[0-9a-f]{12}\b", "", str(e))  # less the model's random name
                    if book is not None:
                        book.record(name, t, i, _as_text(drawn[t]), rows)
                    return rows

                with held(*[f for part in encoded.values() for f in part.values()]):
                    fitted = pool.map(inheritable_thread_target(spark)(run), missing, chunksize=1)
                found = {**known, **{(t, i): rows for t, rows in zip(missing, fitted)}}
                for t in active:
                    rows = found[t, i]
                    if isinstance(rows, str):
                        reasons[t] = rows
                    else:
                        done[t] += rows
                        curves[t].append(_recency_means(done[t])[goal])
                first = [t for t in range(trials) if t not in reasons][:startup]
                if i != numbers[-1] and len(first) == startup and first:
                    middle = median(curves[t][-1] for t in first)
                    stopped |= {t for t in active if t not in reasons and t not in first and curves[t][-1] < middle}
        finally:
            pool.close()
    records = []
    for t, params in enumerate(drawn):
        record = {"trial": t, "params": _as_text(params), "folds_run": len(curves[t])}
        if t in reasons:
            records.append({**record, "status": "failed", "failure_reason": reasons[t]})
            continue
        per_fold = [tuple([r["foldCol"], r["split"], *[r[m] for m in METRICS]]) for r in done[t]]
        records.append({**record, "status": "pruned" if t in stopped else "complete", **_recency_means(done[t]),
                        "fold_metrics": per_fold})
    table = records_table(spark, records, spark.createDataFrame([], TRIAL_SCHEMA).schema)
    return table.orderBy(F.desc_nulls_last(goal), "trial")


def typed_params(kind: str, params: Mapping[str, str], space: Mapping | None = None) -> dict:
    """Parameters of a trial's record as the values that were drawn."""
    space = space_for(kind) if space is None else space
    out = {}
    for name, text in params.items():
        p = space[name]
        if isinstance(p, Choice):
            out[name] = next(v for v in p.values if str(v) == text)
        else:
            out[name] = int(text) if isinstance(p, Whole) else float(text)
    return out


def best_trial(trials: DataFrame, kind: str, goal: str = "val_fbeta", space: Mapping | None = None) -> dict:
    """Typed parameters of the best complete trial, ready for ``blind_test``."""
    row = trials.filter("status = 'complete'").orderBy(F.desc_nulls_last(goal), "trial").select("params").first()
    if row is None:
        raise ValueError("no trial is complete")
    return typed_params(kind, row["params"], space)


def trial_folds(trials: DataFrame) -> DataFrame:
    """Fold metrics of all trials in long form."""
    per_fold = trials.select("trial", F.explode("fold_metrics").alias("f")).select("trial", "f.*")
    return per_fold.unpivot(["trial", "foldCol", "split"], list(METRICS), "metric", "value")


# Rows per partition of an encoded fold (fixed value): an iteration over them takes longer than scheduling its task.
DEALT_ROWS = 8_192


def _dealt(encoded: DataFrame, spec: FeatureSpec, rows: int) -> DataFrame:
    """Label and vector of ``rows`` encoded rows, in partitions and an order that depend on the row ids only."""
    parts = max(1, math.ceil(rows / DEALT_ROWS))
    dealt = encoded.select(spec.row_id, spec.label, FEATURES).repartition(parts, spec.row_id)
    return dealt.sortWithinPartitions(spec.row_id).select(spec.label, FEATURES)


def _work(point: Mapping) -> int:
    """How long a point of a grid takes, relative to others of its kind."""
    return point.get("maxIter", 1) * (1 + sum(point.get("hidden", ())))


def grid_folds(
    df: DataFrame, kind: str, spec: FeatureSpec, grid: Sequence[Mapping], parallelism: int = 1, evaluator=None,
    impute: str = "mean",
) -> DataFrame:
    """Cross-validation on the fold column over parameters of :func:`make_model`; one row per point, best first.

    Each fold is held out in turn and the others train, which differs from
    :func:`random_search`, where every fold has rows of its own for both. Encoders are fitted once per fold, on the rows that train, and shared by all
    points. A perceptron's first layer is as wide as that fold's vector,
    which is narrower where a rare value is in the held-out fold only.

    An iteration of a fit is a Spark job of its own, so a fold's encoded rows
    are dealt, by row id, to as many partitions as their number asks for and
    shuffled into them once: tasks then carry no plan of the steps before, and
    none of them is smaller than its scheduling.

    ``parallelism`` points are fitted at a time, those with the most work first. Perceptrons of a
    fold are fitted together, a step of all of them per job (:mod:`aerolag.operators.perceptrons`), and
    half as many folds at a time, so that tasks of one fold run while the driver takes the step of another.
    """
    df = df.filter(F.col(spec.label).isNotNull())
    spark = df.sparkSession
    evaluator = evaluator or BinaryClassificationEvaluator(labelCol=spec.label)
    longest_first = sorted(range(len(grid)), key=lambda j: -_work(grid[j]))
    pool = ThreadPool(max(1, min(parallelism, len(grid))))
    fold_pool = ThreadPool(max(1, parallelism // 2 if kind.startswith("mlp") else 1))
    try:
        with held(df):
            numbers = fold_numbers(df)
            sizes = {r["foldCol"]: r["count"] for r in df.groupBy("foldCol").count().collect()}  # one row per fold

            def scores_of(i: int) -> list[float]:
                spark._jvm.System.gc()  # what many small jobs left is else kept until the driver's memory runs short
                train, val = df.filter(F.col("foldCol") != i), df.filter(F.col("foldCol") == i)
                encoder = encoder_pipeline(spec, impute, scaling_for(kind)).fit(train)
                rows = (sum(sizes.values()) - sizes[i], sizes[i])
                parts = [_dealt(encoder.transform(p), spec, n) for p, n in zip((train, val), rows)]
                width = vector_width(parts[0])
                models = [make_model(kind, spec, width, **point) for point in grid]
                together = [j for j, model in enumerate(models) if fits_together(model)]
                # A row for what Spark does once per perceptron, without a step.
                one = spark.createDataFrame(parts[0].limit(1).collect(), parts[0].schema).coalesce(1) if together else None
                with held(*parts, *([one] if together else [])):
                    learnt = dict(zip(together, weights_of_all([models[j] for j in together], parts[0], one)))

                    def run(j: int) -> float:
                        fitted = scorer(models[j], learnt[j], one) if j in learnt else models[j].fit(parts[0])
                        return evaluator.evaluate(fitted.transform(parts[1]))

                    found = pool.map(inheritable_thread_target(spark)(run), longest_first, chunksize=1)
                by_point = dict(zip(longest_first, found))
                return [by_point[j] for j in range(len(grid))]

            scored = fold_pool.map(inheritable_thread_target(spark)(scores_of), numbers, chunksize=1)
    finally:
        fold_pool.close()
        pool.close()
    rows = [
        ({name: str(v) for name, v in point.items()}, float(mean(found)), float(pstdev(found)))
        for point, *found in zip(grid, *scored)
    ]
    table = spark.createDataFrame(rows, "params map<string,string>, mean double, stddev double")
    return table.orderBy(F.desc("mean") if evaluator.isLargerBetter() else F.asc("mean"))


def forward_groups(
    df: DataFrame, kind: str, spec: FeatureSpec, groups: Mapping[str, Sequence[str]] | None = None, **params
) -> DataFrame:
    """Recency-weighted metrics as groups of features are added in order."""
    steps, used = [], []
    for name, members in (groups or FEATURE_GROUPS).items():
        used = used + [c for c in members if c in spec.features]
        steps.append((name, used))
    found = cross_validate_specs(df, kind, [spec.only(*used) for _, used in steps], **params)
    table = None
    for step, ((name, used), records) in enumerate(zip(steps, found)):
        row = weighted_fold_mean(records).select(
            F.lit(step).alias("step"), F.lit(name).alias("added"), F.lit(len(used)).alias("columns"), "*")
        table = row if table is None else table.unionByName(row)
    return table.orderBy("step", "split")
