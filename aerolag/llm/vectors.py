"""Integer vectors from floating ones, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))  # not true of NaN either

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int, *extra: str) -> DataFrame:
    """(id, extra columns, v) of the rows whose vector takes part."""
    kept = df.where(usable(F.col(vector_col)))
    return kept.select(F.col(id_col).alias("id"), *extra, scaled(F.col(vector_col), scale).alias("v"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, all of one length, as an int64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def largest(values: np.ndarray) -> int:
    """Largest absolute value, as a Python integer, so that bounds made of it cannot overflow."""
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
