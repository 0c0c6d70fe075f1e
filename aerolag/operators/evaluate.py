"""Fitting and scoring: folds, blind test and importance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.operators.encode import encoder_pipeline, vector_slots, vector_width
from aerolag.operators.metrics import METRICS, confusion, metrics
from aerolag.operators.models import make_model, model_pipeline, scaling_for
from aerolag.operators.ranking import global_position
from aerolag.operators.sampling import fold, fold_numbers
from aerolag.schema import FeatureSpec
from aerolag.sources.stage import held
from aerolag.sources.tables import records_table


def scores(scored: Mapping[str, DataFrame], spec: FeatureSpec) -> dict[str, dict[str, float]]:
    """Metrics of several scored tables, one aggregate each."""
    found = {}
    for name, df in scored.items():
        row = metrics(confusion(df, spec.label)).first()
        found[name] = row.asDict()
    return found


def table_of_scores(spark, found: Mapping[str, Mapping[str, float]], key: str = "split") -> DataFrame:
    records = [{key: name, **values} for name, values in found.items()]
    names = ("tp", "fp", "fn", "tn")
    schema = f"{key} string, " + ", ".join(f"{n} bigint" for n in names) + ", " + ", ".join(f"{m} double" for m in METRICS)
    return records_table(spark, records, spark.createDataFrame([], schema).schema)


def blind_test(
    train: DataFrame, test: DataFrame, kind: str, spec: FeatureSpec, impute: str = "mean", **params
) -> tuple[DataFrame, PipelineModel]:
    """Fit on all training rows; score them and the held-out rows.

    Training rows that stand in two folds count once.
    """
    train = train.drop("foldCol", "split").dropDuplicates([spec.row_id])
    with held(train):
        fitted = model_pipeline(kind, spec, train, impute, **params).fit(train)
        found = scores({"train": fitted.transform(train), "test": fitted.transform(test)}, spec)
    return table_of_scores(train.sparkSession, found), fitted


def encoded_folds(
    df: DataFrame, spec: FeatureSpec, impute: str = "mean", scaling: str = "scaled", per_fold: bool = True
) -> list[dict[str, DataFrame]]:
    """Training and validation rows of each fold as label and vector.

    The encoders learn from each fold's training rows only. ``per_fold=False``
    learns them once from all rows, which lets validation rows leak in.
    """
    shared = None if per_fold else encoder_pipeline(spec, impute, scaling).fit(df)
    return [encoded_fold(df, i, spec, impute, scaling, shared) for i in fold_numbers(df)]


def encoded_fold(
    df: DataFrame, i: int, spec: FeatureSpec, impute: str = "mean", scaling: str = "scaled",
    encoder: PipelineModel | None = None,
) -> dict[str, DataFrame]:
    """One fold of :func:`encoded_folds`, by encoders fitted on its training rows unless given."""
    train, val = fold(df, i)
    encoder = encoder or encoder_pipeline(spec, impute, scaling).fit(train)
    return {
        name: encoder.transform(part).select(spec.label, "final_features")
        for name, part in (("train", train), ("val", val))
    }


def fit_folds(
    folds: Sequence[Mapping[str, DataFrame]], kind: str, spec: FeatureSpec, after_fold=None, **params
) -> list[dict]:
    """Fit and score a model on each encoded fold, oldest first.

    ``after_fold(done)`` is told the records so far and may return True to
    stop early.
    """
    done: list[dict] = []
    for i, part in enumerate(folds):
        fitted = make_model(kind, spec, vector_width(part["train"]), **params).fit(part["train"])
        for name, values in scores({n: fitted.transform(f) for n, f in part.items()}, spec).items():
            done.append({"foldCol": i, "split": name, **values})
        if after_fold is not None and after_fold(done):
            break
    return done


FOLD_SCHEMA = (
    "foldCol int, split string, tp bigint, fp bigint, fn bigint, tn bigint, "
    + ", ".join(f"{m} double" for m in METRICS)
)


def cross_validate(df: DataFrame, kind: str, spec: FeatureSpec, impute: str = "mean", **params) -> DataFrame:
    """Metrics per fold and split."""
    return cross_validate_specs(df, kind, [spec], impute, **params)[0]


def cross_validate_specs(
    df: DataFrame, kind: str, specs: Sequence[FeatureSpec], impute: str = "mean", **params
) -> list[DataFrame]:
    """:func:`cross_validate` for several choices of features of the same rows.

    Encoders and models read their rows a dozen times. The rows of one fold are held
    apart from the others while all choices are fitted on them, so each reading costs by that fold and not by the table.
    """
    df = df.filter(F.col(specs[0].label).isNotNull())
    spark = df.sparkSession
    done: list[list[dict]] = [[] for _ in specs]
    with held(df):
        for i in fold_numbers(df):
            mine = df.filter(F.col("foldCol") == i)
            with held(mine):
                for found, spec in zip(done, specs):
                    part = encoded_fold(mine, i, spec, impute, scaling_for(kind))
                    found += [{**r, "foldCol": i} for r in fit_folds([part], kind, spec, **params)]
    schema = spark.createDataFrame([], FOLD_SCHEMA).schema
    return [records_table(spark, found, schema) for found in done]


def model_importance(fitted: PipelineModel, sample: DataFrame, spec: FeatureSpec) -> DataFrame:
    """What the model itself says of each slot, largest first.

    Impurity gain for trees, coefficients for logistic regression, and the
    difference of class log probabilities for Naive Bayes. ``sample`` is any
    table the model can encode; only its schema is used.
    """
    model = fitted.stages[-1]
    names = vector_slots(fitted.transform(sample), spec)
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        weights = model.coefficients.toArray()
    elif hasattr(model, "theta"):
        theta = model.theta.toArray()
        weights = theta[1] - theta[0]
    else:
        raise ValueError("this kind of model has no weight per feature; use permutation_importance")
    rows = [(n, float(w), float(abs(w))) for n, w in zip(names, weights)]
    table = sample.sparkSession.createDataFrame(rows, "feature string, weight double, size double")
    return table.orderBy(F.desc("size"), "feature")


def permutation_importance(
    fitted: PipelineModel, df: DataFrame, spec: FeatureSpec, features: Sequence[str] | None = None, metric: str = "fbeta"
) -> DataFrame:
    """How far a metric falls when one feature is taken from another row.

    Every row is paired with one other row of the table by joining its place
    in id order with the place in a hash order, once for all features. Each row
    then stands once as it is and once per feature with that one exchanged; all
    of them are encoded and scored in one pass and counted by feature.
    """
    features = list(features or spec.features)
    rows = df.filter(F.col(spec.label).isNotNull()).select(spec.row_id, spec.label, *spec.features)
    shuffled = F.md5(F.col(spec.row_id).cast("string"))
    own = global_position(rows, [spec.row_id], "__place")
    other = global_position(
        rows.select(spec.row_id, *features), [shuffled, spec.row_id], "__place"
    ).select("__place", *[F.col(c).alias(f"__other_{c}") for c in features])
    paired = own.join(other, "__place")
    copies = paired.withColumn("__taken", F.explode(F.array(F.lit(""), *[F.lit(c) for c in features])))
    exchanged = copies.withColumns({
        c: F.when(F.col("__taken") == c, F.col(f"__other_{c}")).otherwise(F.col(c)) for c in features})
    counted = metrics(confusion(fitted.transform(exchanged), spec.label, by=["__taken"]))
    found = {r["__taken"]: r.asDict() for r in counted.collect()}  # one row per feature
    none = dict.fromkeys(METRICS, 0.0)  # of a table without rows
    base = found.pop("", none)[metric]
    lines = [(c, base, found.get(c, none)[metric], base - found.get(c, none)[metric]) for c in features]
    table = df.sparkSession.createDataFrame(lines, "feature string, base double, permuted double, drop double")
    return table.orderBy(F.desc("drop"), "feature")
