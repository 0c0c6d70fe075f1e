"""Where queries and their SQL counterparts are kept."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, only: Iterable[str] | None = None) -> DataFrame:
    """Round fractional columns, for comparison with another engine."""
    names = set(only) if only is not None else {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}

    def out(c: str) -> Column:
        return F.round(c, digits).alias(c) if c in names else F.col(c)

    return df.select(*[out(c) for c in df.columns])
