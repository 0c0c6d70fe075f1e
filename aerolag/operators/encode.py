"""Feature encoding with Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import (
    Imputer,
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.schema import FeatureSpec

FEATURES = "final_features"


class _Shift(HasInputCols, HasOutputCols):
    buffer = Param(
        Params._dummy(), "buffer", "distance kept between zero and the least value of a moved column",
        typeConverter=TypeConverters.toFloat,
    )

    def getBuffer(self) -> float:
        return self.getOrDefault(self.buffer)


class ShiftNonNegative(Estimator, _Shift, DefaultParamsReadable, DefaultParamsWritable):
    """Move columns that go below zero to the right of it.

    The least value of each column is learnt from the training rows, in one
    aggregate for all columns.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, buffer=1.0):
        super().__init__()
        self._setDefault(buffer=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ShiftNonNegativeModel":
        names = self.getInputCols()
        least = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in names]).first()
        moves = [self.getBuffer() - least[c] if least[c] is not None and least[c] < 0 else 0.0 for c in names]
        return self._copyValues(ShiftNonNegativeModel(moves=moves))


class ShiftNonNegativeModel(Model, _Shift, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the learnt move; values still below zero become zero."""

    moves = Param(Params._dummy(), "moves", "what is added to each column", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, moves=None):
        super().__init__()
        self._setDefault(buffer=1.0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault(self.moves))
        return df.withColumns({
            out: F.when(F.col(c).isNotNull(), F.greatest(F.col(c).cast("double") + move, F.lit(0.0)))
            for c, out, move in columns
        })


def _ending(names: Sequence[str], end: str) -> list[str]:
    return [f"{c}_{end}" for c in names]


def encoder_stages(
    spec: FeatureSpec, impute: str = "mean", scaling: str = "scaled", median_error: float = 0.001
) -> list:
    """Stages from raw columns to one vector.

    Text becomes one-hot slots by falling frequency, with a slot for unseen and
    missing text; numbers are imputed with the training mean or median. With
    "scaled" they are then min-max scaled or standardised; with "shifted" they
    are moved above zero instead, as Naive Bayes needs. Medians are read from
    sketches; ``median_error`` bounds their error in rank.
    """
    stages, parts = [], []
    if spec.one_hot:
        stages += [
            StringIndexer(inputCols=list(spec.one_hot), outputCols=_ending(spec.one_hot, "index"), handleInvalid="keep"),
            OneHotEncoder(inputCols=_ending(spec.one_hot, "index"), outputCols=_ending(spec.one_hot, "ohe"), dropLast=False),
        ]
        parts += _ending(spec.one_hot, "ohe")
    parts += spec.binary
    if spec.numeric:
        stages.append(Imputer(
            strategy=impute, relativeError=median_error,
            inputCols=list(spec.numeric), outputCols=_ending(spec.numeric, "imputed"),
        ))
    if scaling == "shifted":
        if spec.numeric:
            stages.append(ShiftNonNegative(
                inputCols=_ending(spec.numeric, "imputed"), outputCols=_ending(spec.numeric, "shifted")))
        parts += _ending(spec.numeric, "shifted")
    elif scaling == "scaled":
        scalers = (
            (spec.min_max, "minmax", MinMaxScaler()),
            (spec.standard, "standard", StandardScaler(withMean=True, withStd=True)),
        )
        for names, name, scaler in scalers:
            if names:
                stages += [
                    VectorAssembler(inputCols=_ending(names, "imputed"), outputCol=f"{name}_features"),
                    scaler.setInputCol(f"{name}_features").setOutputCol(f"scaled_{name}_features"),
                ]
                parts.append(f"scaled_{name}_features")
    else:
        raise ValueError(f"unknown scaling {scaling!r}")
    return [*stages, VectorAssembler(inputCols=parts, outputCol=FEATURES)]


def encoder_pipeline(
    spec: FeatureSpec, impute: str = "mean", scaling: str = "scaled", median_error: float = 0.001
) -> Pipeline:
    return Pipeline(stages=encoder_stages(spec, impute, scaling, median_error))


def vector_width(df: DataFrame, col: str = FEATURES) -> int:
    """Slots of an encoded column, read from its metadata without a job."""
    return df.schema[col].metadata["ml_attr"]["num_attrs"]


def vector_slots(df: DataFrame, spec: FeatureSpec | None = None, col: str = FEATURES) -> list[str]:
    """Names of the slots of an encoded column, in order.

    With a spec, scaled slots are named after the columns they come from.
    """
    attrs = df.schema[col].metadata["ml_attr"]["attrs"]
    found = sorted((a["idx"], a.get("name")) for kind in attrs.values() for a in kind)
    names = {idx: name for idx, name in found}
    if spec is not None:
        origin = {}
        for group, members in (("scaled_minmax_features", spec.min_max), ("scaled_standard_features", spec.standard)):
            origin.update({f"{group}_{i}": c for i, c in enumerate(members)})
        names = {idx: origin.get(name, name) for idx, name in names.items()}
    return [names.get(i) or f"{col}_{i}" for i in range(vector_width(df, col))]
