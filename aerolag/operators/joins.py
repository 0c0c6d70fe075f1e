"""Joins of a fact table with a lookup table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a lookup may hold to be sent to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _row_bytes(df: DataFrame) -> Column:
    """Rough size of a row in memory: texts by their bytes, arrays and maps by their elements."""
    total = F.lit(16)
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, T.StringType | T.BinaryType):
            size = F.octet_length(F.col(field.name))
        elif isinstance(kind, T.ArrayType | T.MapType):
            size = F.size(field.name) * 64
        else:
            size = F.lit(64 if isinstance(kind, T.StructType) else 8)
        total = total + F.greatest(F.coalesce(size, F.lit(0)), F.lit(8))
    return total


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring that it is small.

    Rows and bytes come from one aggregate that stops at the bound on rows.
    Larger tables are left to a shuffled join, where adaptive execution splits
    partitions swollen by one hot key.
    """
    found = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(_row_bytes(df).cast("long")).alias("bytes")).first()
    return F.broadcast(df) if found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes else df


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Refuse a lookup in which a key repeats: joining it would multiply rows."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if repeated:
        raise ValueError(f"lookup has more than one row per {keys}")
    return df


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join that adds lookup columns and keeps every fact row once.

    ``on`` maps fact column to lookup key; ``take`` maps lookup column to the
    name it gets. The lookup must hold one row per key.
    """
    keys = {key: f"__key_{i}" for i, key in enumerate(on.values())}
    side = lookup.select(
        *[F.col(key).alias(name) for key, name in keys.items()],
        *[F.col(c).alias(name) for c, name in take.items()],
    )
    sized = broadcast_if_small(side, max_rows)
    if sized is side:
        # A shuffle would send all rows without a key to one task, and they meet nothing.
        keyless = reduce(or_, [F.col(left).isNull() for left in on])
        alone = fact.filter(keyless).select("*", *[F.lit(None).cast(side.schema[name].dataType).alias(name) for name in take.values()])
        fact = fact.filter(~keyless)
    condition = [fact[left] == sized[keys[right]] for left, right in on.items()]
    joined = fact.join(sized, condition, "left").drop(*keys.values())
    return joined if sized is not side else joined.unionByName(alone)
