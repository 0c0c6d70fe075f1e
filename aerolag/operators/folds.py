"""Time-ordered, overlapping folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolag.operators.joins import broadcast_if_small
from aerolag.operators.ranking import global_position
from aerolag.sources.stage import stage_table


def fold_ranges(rows: int, k: int = 8, overlap: float = 0.1, train_frac: float = 0.8) -> list[tuple[int, int, int]]:
    """First row, first validation row and end of each fold, counted from 0.

    Folds have equal length and each starts so that it shares ``overlap`` of
    it with the one before; the last one ends with the data.
    """
    length = int(rows // (k - (k - 1) * overlap))
    step = length * (1 - overlap)
    ranges = []
    for i in range(k):
        start = int(i * step + 1e-9)
        end = rows if i == k - 1 else start + length
        ranges.append((start, start + int((end - start) * train_frac + 1e-9), end))
    return ranges


def assign_folds(
    df: DataFrame,
    order: str = "DEP_TS",
    tie: str = "FLIGHT_ID",
    k: int = 8,
    overlap: float = 0.1,
    train_frac: float = 0.8,
) -> DataFrame:
    """Add ``foldCol`` and ``split``; rows shared by two folds appear in both.

    Only the keys at the fold edges are needed, not the position of each row.
    Rows are counted per hour, which tells the hours that hold an edge; rows of
    those hours alone are sorted to find the exact keys. The table itself is
    then labelled where it lies, without a shuffle. Rows without a time come
    first, as in a sort.
    """
    hour = F.struct(F.col(order).cast("date").alias("d"), F.hour(order).alias("h"))
    hourly = stage_table(df.groupBy(hour.alias("hour")).agg(F.count("*").alias("n")), "hours")
    rows = hourly.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if rows < k:
        raise ValueError(f"{rows} rows cannot make {k} folds")
    ranges = fold_ranges(rows, k, overlap, train_frac)
    edges = sorted({p for r in ranges for p in r if 0 < p < rows})

    # One row per hour of the calendar: small enough for one task.
    upto = Window.orderBy(F.asc_nulls_first("hour")).rowsBetween(Window.unboundedPreceding, 0)
    placed = hourly.withColumn("end", F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))
    holds_edge = F.exists(F.array(*[F.lit(p) for p in edges]), lambda p: (p >= F.col("start")) & (p < F.col("end")))
    edge_hours = placed.filter(holds_edge).select(F.col("hour").alias("edge_hour"), "start", F.sum("n").over(
        Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ).alias("kept_before"))
    edge_hours = stage_table(edge_hours, "edge-hours")
    near = df.select(order, tie, hour.alias("hour")).join(
        broadcast_if_small(edge_hours), F.col("hour").eqNullSafe(F.col("edge_hour"))
    ).select(order, tie, "start", F.coalesce("kept_before", F.lit(0)).alias("kept_before"))
    ranked = global_position(near, [F.asc_nulls_first(order), tie])
    position = F.col("start") + F.col("position") - 1 - F.col("kept_before")
    # One row per edge. Times travel as text, which no zone setting can move.
    found = ranked.withColumn("at", position).filter(F.col("at").isin(edges)).select(
        "at", F.col(order).cast("string").alias("when"), F.col(tie).alias("ident")
    )
    keys = {r["at"]: (r["when"], r["ident"]) for r in found.collect()}

    def from_edge(p: int) -> Column:
        """True on rows at or after the row in position ``p``."""
        if p == 0:
            return F.lit(True)
        if p >= rows:
            return F.lit(False)
        when, ident = keys[p]
        same_or_later_id = F.col(tie) >= ident
        if when is None:
            return F.col(order).isNotNull() | same_or_later_id
        at = F.lit(when).cast(df.schema[order].dataType)
        return F.coalesce((F.col(order) > at) | ((F.col(order) == at) & same_or_later_id), F.lit(False))

    places = F.array_compact(F.array(*[
        F.when(
            from_edge(start) & ~from_edge(end),
            F.struct(F.lit(i).alias("fold"), F.when(from_edge(val), "val").otherwise("train").alias("split")),
        )
        for i, (start, val, end) in enumerate(ranges)
    ]))
    # Rows between two neighbouring edges lie in the same folds, so a row with a time is
    # led to its place by halving the edges. Edges without an id do not halve the rows.
    if all(keys[p][1] is not None for p in edges):
        constant = [
            F.array(*[F.struct(F.lit(i).alias("fold"), F.lit("val" if at >= val else "train").alias("split"))
                      for i, (start, val, end) in enumerate(ranges) if start <= at < end])
            for at in (0, *edges)
        ]

        def between(low: int, high: int) -> Column:
            """The folds of a row known to lie in one of these stretches."""
            if low == high:
                return constant[low]
            middle = (low + high + 1) // 2
            return F.when(from_edge(edges[middle - 1]), between(middle, high)).otherwise(between(low, middle - 1))

        places = F.when(F.col(order).isNotNull(), between(0, len(edges))).otherwise(places)
    return df.withColumn("__place", F.explode(places)).select(
        *df.columns, F.col("__place.fold").alias("foldCol"), F.col("__place.split").alias("split")
    )


def validation_starts(folded: DataFrame, order: str = "DEP_TS") -> DataFrame:
    """(foldCol, start): the first time that each fold validates on."""
    return folded.filter(F.col("split") == "val").groupBy("foldCol").agg(F.min(order).alias("start"))
