"""Classifiers with the hyper-parameters found best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame

from aerolag.operators.encode import FEATURES, encoder_stages, vector_width
from aerolag.schema import FeatureSpec

# Best hyper-parameters per kind of model. The boosted trees were
# tuned in a library with options Spark has no counterpart for (dropping trees,
# a least gain per leaf); their depth is not known and left at Spark's default.
BEST: dict[str, dict] = {
    "lr_baseline": {"maxIter": 10},
    "lr": {"elasticNetParam": 0.2, "regParam": 0.0, "threshold": 0.6},
    "nb": {"smoothing": 1.7},
    "mlp1": {"hidden": (21,), "maxIter": 88, "blockSize": 128},
    "mlp2": {"hidden": (14, 15), "maxIter": 82, "blockSize": 128},
    "rf": {
        "numTrees": 23, "maxDepth": 19, "featureSubsetStrategy": "log2", "minInstancesPerNode": 14,
        "maxBins": 96, "impurity": "gini", "minInfoGain": 0.0,
    },
    "gbt": {"maxIter": 29, "subsamplingRate": 0.48},
}
_CLASSES = {
    "lr_baseline": LogisticRegression, "lr": LogisticRegression, "nb": NaiveBayes,
    "mlp1": MultilayerPerceptronClassifier, "mlp2": MultilayerPerceptronClassifier,
    "rf": RandomForestClassifier, "gbt": GBTClassifier,
}
SEED = 42
# How trees are grown, not what they become: the node that each row has reached is kept
# with it, or every level would send all trees out and lead each row down again from their roots.
_GROWING = {"rf": {"cacheNodeIds": True}}


def scaling_for(kind: str) -> str:
    return "shifted" if kind == "nb" else "scaled"


def make_model(kind: str, spec: FeatureSpec, width: int | None = None, **params) -> Estimator:
    """A classifier of a kind, with its best parameters unless given others.

    Perceptrons take ``hidden`` layer sizes and need the vector ``width``.
    """
    settings = {**_GROWING.get(kind, {}), **BEST[kind], **params}
    if "hidden" in settings:
        hidden: Sequence[int] = settings.pop("hidden")
        if width is None:
            raise ValueError("a perceptron needs the width of the feature vector")
        settings["layers"] = [width, *(int(h) for h in hidden), 2]
    model = _CLASSES[kind](featuresCol=FEATURES, labelCol=spec.label, **settings)
    return model.setSeed(SEED) if model.hasParam("seed") and kind != "nb" else model


def model_pipeline(kind: str, spec: FeatureSpec, train: DataFrame, impute: str = "mean", **params) -> Pipeline:
    """Encoders and classifier as one estimator, to be fitted on ``train``.

    A perceptron needs the encoders' result to know its width, so its encoders
    are fitted here and stand in the pipeline as they are.
    """
    encoders, width = encoder_stages(spec, impute, scaling_for(kind)), None
    if kind.startswith("mlp"):
        fitted = Pipeline(stages=encoders).fit(train)
        encoders, width = fitted.stages, vector_width(fitted.transform(train))
    return Pipeline(stages=[*encoders, make_model(kind, spec, width, **params)])
