"""Column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.functions.scalar import percent
from aerolag.operators.ranking import exact_quantiles


def _per_column(df: DataFrame, cols: Sequence[str], measures) -> DataFrame:
    """One aggregate over the table, turned into one row per column.

    ``measures(name)`` gives the named aggregates of a column.
    """
    wide = df.agg(*[F.struct(*measures(c)).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("m")) for c in cols])
    return wide.select(F.explode(rows).alias("r")).select("r.column", "r.m.*")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and row count of every column in one scan."""
    return _per_column(df, cols or df.columns, lambda c: [
        F.count_if(F.col(c).isNull()).alias("nulls"), F.count(F.lit(1)).alias("total_rows"),
    ])


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, min, max, mean and sample standard deviation, as numbers."""
    return _per_column(df, cols, lambda c: [
        F.count(c).alias("n"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
    ])


def quartiles(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Quartiles per column: exact by default, by sketch with an ``accuracy``."""
    probs = [0.25, 0.5, 0.75]
    if accuracy:
        return _per_column(df, cols, lambda c: [
            F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias("q")
        ]).select("column", *[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])
    exact = exact_quantiles(df, cols, probs)
    return df.sparkSession.createDataFrame(
        [(c, *([float(v) for v in values] or [None] * 3)) for c, values in exact.items()],
        "column string, q1 double, q2 double, q3 double",
    )


def exact_quartiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles per column as texts, with all digits of whole numbers and decimals."""
    found = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, *([format(v, "f") if isinstance(v, Decimal) else str(v) for v in q] or [None] * 3)) for c, q in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, q1 string, q2 string, q3 string")


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str], k: int = 800) -> DataFrame:
    """One quantile sketch per group and column, to be kept as columns of a table.

    A larger ``k`` gives larger sketches and a smaller error of ranks: about
    1.3 % of the rows at 200, 0.4 % at 800, however many rows there are.
    """
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in cols])


def merged_quantiles(sketches: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, n, q1, q2, ...) of the groups in a table of sketches, without their rows.

    Filter the table first for a range of groups. A column without values has null quantiles.
    """
    one = _per_column(sketches, cols, lambda c: [F.kll_merge_agg_double(c).alias("s")])
    n = F.kll_sketch_get_n_double("s")
    return one.select("column", n.alias("n"), *[
        F.when(n > 0, F.kll_sketch_get_quantile_double("s", F.lit(p))).alias(f"q{i}") for i, p in enumerate(probs, 1)])


def rank_errors(
    df: DataFrame, found: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """(column, n, e1, e2, ...): by what share of the rows each quantile found misses its rank, from the rows.

    0 where the wanted rank lies among the rows equal to the value.
    """
    values = {r["column"]: [r[f"q{i}"] for i in range(1, len(probs) + 1)] for r in found.collect()}  # one row a column

    def error(c: str, value: float | None, p: float) -> Column:
        if value is None:
            return F.lit(None).cast("double")
        n, v = F.count(c), F.col(c).cast("double")
        below, upto = F.count_if(v < value) / n, F.count_if(v <= value) / n
        return F.greatest(below - p, p - upto, F.lit(0.0))

    return _per_column(df, cols, lambda c: [
        F.count(c).alias("n"), *[error(c, v, p).alias(f"e{i}") for i, (v, p) in enumerate(zip(values[c], probs), 1)]])


def sigma_bounds(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> dict[str, tuple[float, float]]:
    """Mean plus and minus ``k`` standard deviations, for columns that vary."""
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in cols]).first()
    return {
        c: (row[c]["m"] - k * row[c]["s"], row[c]["m"] + k * row[c]["s"])
        for c in cols if row[c]["s"] is not None
    }


def _outside(c: str, bounds: Mapping[str, tuple[float, float]]) -> Column:
    if c not in bounds:
        return F.lit(False)
    low, high = bounds[c]
    return (F.col(c) < low) | (F.col(c) > high)


def outlier_share(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Percent of all rows, null ones included, beyond ``k`` deviations."""
    bounds = sigma_bounds(df, cols, k)
    return _per_column(df, cols, lambda c: [
        F.count_if(_outside(c, bounds)).alias("outliers"),
        percent(F.count_if(_outside(c, bounds)), F.count(F.lit(1))).alias("outlier_pct"),
    ])


def sigma_keep(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Rows whose value lies within ``k`` deviations; null values are dropped."""
    bounds = sigma_bounds(df, [col], k)
    if col not in bounds:
        return df.filter(F.col(col).isNotNull())
    return df.filter(F.col(col).between(*bounds[col]))


def histogram(df: DataFrame, col: str, bins: int = 30, k: float = 3.0) -> DataFrame:
    """Equal-width counts of the non-outlying values; the last bin is closed."""
    kept = sigma_keep(df.select(F.col(col).cast("double").alias("v")), "v", k)
    span = kept.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if span["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    width = (span["hi"] - span["lo"]) / bins
    place = F.least(F.floor((F.col("v") - F.lit(span["lo"])) / F.lit(width)), F.lit(bins - 1)) if width else F.lit(0)
    counts = kept.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = lambda step: F.lit(span["lo"]) + (F.col("bin") + step) * F.lit(width)
    return every.join(counts, "bin", "left").select(
        "bin", edge(0).alias("lower"), edge(1).alias("upper"), F.coalesce("n", F.lit(0)).alias("n")
    )


def column_profile(df: DataFrame, cols: Sequence[str], k: float = 3.0) -> DataFrame:
    """Mean, standard deviation, percent null and percent outlying per column."""
    bounds = sigma_bounds(df, cols, k)
    return _per_column(df, cols, lambda c: [
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        percent(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias("null_pct"),
        percent(F.count_if(_outside(c, bounds)), F.count(F.lit(1))).alias("outlier_pct"),
    ])


def compare_datasets(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, distinct rows, whether copies exist, and columns, per table.

    Copies are combined before the shuffle, so a row repeated many times
    travels once per task.
    """
    def one(name: str, df: DataFrame) -> DataFrame:
        distinct = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
        rows, kinds = F.coalesce(F.sum("__copies"), F.lit(0)), F.count("*")
        return distinct.agg(
            F.lit(name).alias("dataset"), rows.alias("total_rows"), kinds.alias("distinct_rows"),
            (rows > kinds).alias("has_duplicates"), F.lit(len(df.columns)).alias("column_count"),
        )

    parts = [one(name, df) for name, df in frames.items()]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def missing_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which any of the columns is null."""
    return df.filter(" or ".join(f"`{c}` is null" for c in cols))
