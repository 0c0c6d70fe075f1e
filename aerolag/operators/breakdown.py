"""How often the label is set, by dimension and by flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.functions.scalar import bin_label, code_label, floor_bin, percent
from aerolag.schema import LABEL


def label_breakdown(df: DataFrame, dim: str, label: str = LABEL, top: int | None = None) -> DataFrame:
    """Delayed, other and all labelled rows per value of ``dim``, with shares.

    One conditional aggregate over one scan; rows without a label do not count.
    ``top`` keeps the values with most rows, ties by value.
    """
    delayed, other = F.col("delayed_flights"), F.col("non_delayed_flights")
    total = delayed + other
    table = (
        df.filter(F.col(label).isin(0, 1))
        .groupBy(dim)
        .agg(
            F.count_if(F.col(label) == 1).alias("delayed_flights"),
            F.count_if(F.col(label) == 0).alias("non_delayed_flights"),
        )
        .withColumns({
            "total_flights": total,
            "delayed_pct": percent(delayed, total),
            "non_delayed_pct": percent(other, total),
        })
    )
    return table.orderBy(F.desc("total_flights"), dim).limit(top) if top else table


def label_breakdown_joined(df: DataFrame, dim: str, label: str = LABEL) -> DataFrame:
    """The two class counts computed apart and brought together by a full join.

    Agrees with :func:`label_breakdown` on non-null values of ``dim``; null is
    equal to nothing in a join, so it keeps one row per class. Only the counts
    are filled with 0, never the dimension.
    """
    def class_count(value: int, name: str) -> DataFrame:
        return df.filter(F.col(label) == value).groupBy(dim).agg(F.count("*").alias(name))

    counts = ("delayed_flights", "non_delayed_flights")
    return class_count(1, counts[0]).join(class_count(0, counts[1]), dim, "outer").fillna(0, list(counts))


def binned_breakdown(
    df: DataFrame, col: str, width: int = 10, cap: int | None = None, beyond: str = "last", label: str = LABEL
) -> DataFrame:
    """Breakdown by fixed-width bins, all of them unless ``cap`` names the last.

    Values past the last bin go into one more bin that follows it, so that the
    totals agree; ``beyond="drop"`` leaves them out, as the published charts do.
    """
    if beyond not in ("last", "drop"):
        raise ValueError(f"unknown treatment {beyond!r}")
    name = f"{col}_bin"
    binned = df.withColumn(name, floor_bin(F.col(col), width))
    if cap is not None and beyond == "drop":
        binned = binned.filter(F.col(name) <= cap)
    elif cap is not None:
        more = F.lit(cap + width).cast(binned.schema[name].dataType)
        binned = binned.withColumn(name, F.when(F.col(name) > cap, more).otherwise(F.col(name)))
    text = bin_label(F.col(name), width)
    if cap is not None:
        text = F.when(F.col(name) > cap, F.concat(F.lit(str(cap + width)), F.lit(" and more"))).otherwise(text)
    return label_breakdown(binned, name, label).withColumn("bin_label", text)


def named(df: DataFrame, code: str, names: dict[int, str], out: str) -> DataFrame:
    """Add the name of a code column."""
    return df.withColumn(out, code_label(F.col(code), names))


def status_crosscount(df: DataFrame, label: str = LABEL, status: str = "CANCELLED") -> DataFrame:
    """Delayed against cancelled, in one row and one scan."""
    y, s = F.col(label), F.col(status)
    return df.agg(
        F.count_if((y == 1) & (s == 1)).alias("delayed_canceled"),
        F.count_if((y == 0) & (s == 1)).alias("canceled_not_delayed"),
        F.count_if((y == 1) & s.isNull()).alias("delayed_canceled_is_null"),
        F.count_if((y == 1) & (s == 0)).alias("delayed_not_canceled"),
    )


def association_share(df: DataFrame, flags: Sequence[str], label: str = LABEL) -> DataFrame:
    """Percent of delayed rows on which each 0/1 flag is set."""
    y = F.col(label) == 1
    wide = df.agg(F.count_if(y).alias("delayed"), *[F.count_if(y & (F.col(f) == 1)).alias(f) for f in flags])
    rows = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("delayed_with_flag")) for f in flags])
    return wide.select("delayed", F.explode(rows).alias("r")).select(
        "r.flag", "r.delayed_with_flag", "delayed",
        percent(F.col("r.delayed_with_flag"), F.col("delayed")).alias("share_pct"),
    )
