"""Class balance, copies, time holdout and the reading of folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.operators.joins import lookup_join
from aerolag.operators.weather import binarise
from aerolag.schema import IDENTITY_COLUMNS, LABEL
from aerolag.sources.stage import stage_table


def class_counts(df: DataFrame, label: str = LABEL) -> tuple[int, int]:
    """Rows labelled 0 and rows labelled 1, from one aggregate."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return row["n0"], row["n1"]


def undersample(
    df: DataFrame, label: str = LABEL, id_col: str = "FLIGHT_ID", method: str = "hash", seed: int = 42
) -> DataFrame:
    """Thin the larger class to about the size of the smaller one.

    "hash" keeps a row of the larger class when the md5 of its id falls below
    the wanted share: the same rows on any cluster and any file layout, in one
    map-only pass. "bernoulli" draws at random with a seed, and unites the two
    classes; what it draws depends on the layout. Unlabelled rows are dropped.
    """
    n0, n1 = class_counts(df, label)
    if not n0 or not n1:
        return df.filter(F.col(label).isNotNull())
    larger, share = (1.0, n0 / n1) if n1 > n0 else (0.0, n1 / n0)
    if method == "bernoulli":
        thinned = df.filter(F.col(label) == larger).sample(False, share, seed)
        return df.filter(F.col(label) == 1.0 - larger).unionByName(thinned)
    if method != "hash":
        raise ValueError(f"unknown sampling method {method!r}")
    if share >= 1.0:
        return df.filter(F.col(label).isNotNull())
    below = f"{int(share * 2**32):08x}"
    chosen = F.substring(F.md5(F.col(id_col).cast("string")), 1, 8) < below
    return df.filter(F.col(label).isNotNull() & ((F.col(label) != larger) | chosen))


def drop_copies(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per key, or per full row where no key is given.

    Without a key, rows that differ only in columns dropped earlier merge.
    """
    return df.dropDuplicates(list(keys)) if keys else df.dropDuplicates()


def drop_rare_copies(df: DataFrame, keys: Sequence[str], row_id: str, ids: DataFrame) -> DataFrame:
    """:func:`drop_copies` by ``keys``, one of them ``row_id``, where few ids of ``ids`` repeat.

    ``ids`` holds the id of each row before rows were taken several times, at least once for each copy.
    The ids that repeat there are found first, from that one column. Only their rows, and
    those without an id, are shuffled to drop copies; all others stay where they lie.
    """
    repeated = stage_table(
        ids.groupBy(row_id).count().filter("count > 1").select(row_id, F.lit(True).alias("repeated")), "repeated-ids")
    if repeated.isEmpty():
        return df
    marked = lookup_join(df, repeated.filter(F.col(row_id).isNotNull()), {row_id: row_id}, {"repeated": "__repeated"})
    copied = F.col(row_id).isNull() | F.col("__repeated").isNotNull()
    alone, copies = marked.filter(~copied).drop("__repeated"), marked.filter(copied).drop("__repeated")
    return alone.unionByName(drop_copies(copies, keys))


def time_holdout(df: DataFrame, test_year: int) -> tuple[DataFrame, DataFrame]:
    """Rows of other years, and rows of the test year."""
    return df.filter(F.col("YEAR") != test_year), df.filter(F.col("YEAR") == test_year)


def fold(df: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows of one fold."""
    mine = F.col("foldCol") == i
    return df.filter(mine & (F.col("split") == "train")), df.filter(mine & (F.col("split") == "val"))


def fold_counts(df: DataFrame) -> DataFrame:
    """Rows per fold and split, in order, with a combined name."""
    return (
        df.groupBy("foldCol", "split").agg(F.count("*").alias("n"))
        .withColumn("fold_split", F.concat_ws("_", "foldCol", "split"))
        .orderBy("foldCol", "split")
    )


def fold_numbers(df: DataFrame) -> list[int]:
    """The folds present; they must run from 0 without a gap."""
    found = df.agg(
        F.count_distinct("foldCol").alias("n"), F.min("foldCol").alias("first"), F.max("foldCol").alias("last")
    ).first()
    if found["n"] and (found["first"], found["last"]) != (0, found["n"] - 1):
        raise ValueError(
            f"folds must be numbered 0..n-1, found {found['n']} of them from {found['first']} to {found['last']}")
    return list(range(found["n"]))


def prepare_test(df: DataFrame, label: str = LABEL, drop: Sequence[str] = IDENTITY_COLUMNS) -> DataFrame:
    """Held-out rows as the models expect them: labelled, binary special
    weather, no identity columns; neither balanced nor trimmed."""
    return binarise(df.filter(F.col(label).isNotNull())).drop(*drop)
