"""Airport volume, holidays and lagged-season centrality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.functions.scalar import next_season
from aerolag.operators.joins import lookup_join, require_unique
from aerolag.sources.stage import stage_table


def airport_volume(df: DataFrame, test_year: int | None = None) -> DataFrame:
    """Mean departures per airport and year, leaving out the test year.

    The fact table is read once, down to one row per airport and year; that
    small table is staged and both figures come from it.
    """
    seen = df if test_year is None else df.filter(F.col("YEAR") != test_year)
    yearly = stage_table(seen.groupBy("ORIGIN", "YEAR").agg(F.count("*").alias("flights")), "volume")
    years = yearly.agg(F.count_distinct("YEAR").alias("n")).first()["n"]
    return yearly.groupBy(F.col("ORIGIN").alias("airport")).agg(
        (F.sum("flights") / F.lit(float(years))).alias("avg_yr_flights")
    )


def join_volume(df: DataFrame, volume: DataFrame) -> DataFrame:
    """Volume of the origin and of the destination. Both are counts of
    departures; an airport unseen before the test year gets null."""
    for role, out in (("ORIGIN", "origin_yr_flights"), ("DEST", "dest_yr_flights")):
        df = lookup_join(df, volume, {role: "airport"}, {"avg_yr_flights": out})
    return df


def fold_volume(df: DataFrame, starts: DataFrame, order: str = "DEP_TS") -> DataFrame:
    """(foldCol, airport, avg_yr_flights): mean departures per year as known when a fold begins to validate.

    ``starts`` has one row per fold: foldCol and start. Only rows before a
    fold's start count for it, and the years are those seen before it; rows
    without a time count for none. An airport not seen before has no row.

    The fact table is read once, down to counts per airport, year and period
    between two starts. What is known at a start is the sum over the periods
    before it.
    """
    # One row per fold. Times travel as text, which no zone setting can move.
    found = starts.select("foldCol", F.col("start").cast("string").alias("start")).filter("start is not null").collect()
    if not found:
        return df.select(F.lit(0).alias("foldCol"), F.col("ORIGIN").alias("airport"), F.lit(0.0).alias("avg_yr_flights")).limit(0)
    times = sorted({r["start"] for r in found})
    kind = df.schema[order].dataType
    # In period p a row is known from the start with number p on.
    edges = F.array(*[F.lit(t).cast(kind) for t in times])
    period = F.size(F.filter(edges, lambda t: t <= F.col(order)))
    counts = df.filter(F.col(order).isNotNull()).groupBy("ORIGIN", "YEAR", period.alias("period")).agg(F.count("*").alias("flights"))
    counts = stage_table(counts, "fold-volume").filter(F.col("period") < len(times))
    known = counts.withColumn("at", F.explode(F.sequence(F.col("period"), F.lit(len(times) - 1))))
    years = known.groupBy("at").agg(F.count_distinct("YEAR").cast("double").alias("years"))
    volume = known.groupBy("at", F.col("ORIGIN").alias("airport")).agg(F.sum("flights").alias("flights"))
    folds = F.explode(F.array(*[
        F.struct(F.lit(times.index(r["start"])).alias("at"), F.lit(r["foldCol"]).alias("foldCol")) for r in found
    ])).alias("f")
    by_fold = df.sparkSession.range(1).select(folds).select("f.*")  # one row per fold
    return volume.join(F.broadcast(years), "at").join(F.broadcast(by_fold), "at").select(
        "foldCol", "airport", (F.col("flights") / F.col("years")).alias("avg_yr_flights")
    )


def join_fold_volume(folded: DataFrame, volume: DataFrame) -> DataFrame:
    """Volume of the origin and of the destination as known at each row's fold."""
    for role, out in (("ORIGIN", "origin_yr_flights"), ("DEST", "dest_yr_flights")):
        folded = lookup_join(folded, volume, {"foldCol": "foldCol", role: "airport"}, {"avg_yr_flights": out})
    return folded


def paid_holidays(holidays: DataFrame, country: str, first: dt.date, last: dt.date) -> DataFrame:
    """Dates of a country's paid holidays in a closed range.

    Rows that do not say whether the day is paid are left out.
    """
    day = F.col("date").cast("date")
    return holidays.filter(
        (F.col("countryOrRegion") == country) & day.between(first, last) & F.col("isPaidTimeOff")
    ).select(day.alias("date"))


def flag_near_dates(
    df: DataFrame, dates: DataFrame, day_col: str = "FL_DATE", days: int = 3, out: str = "isHoliday"
) -> DataFrame:
    """1 on rows dated within ``days`` of any of the dates, else 0.

    The dates are widened to the days around them; that lookup has at most one
    row per calendar day. It is staged, so measuring and joining it do not find
    the dates twice.
    """
    near = stage_table(dates.select(
        F.explode(F.sequence(F.date_sub("date", days), F.date_add("date", days))).alias("day")
    ).distinct().withColumn("near", F.lit(1)), "near-dates")
    dated = df.withColumn("__day", F.col(day_col).try_cast("date"))
    flagged = lookup_join(dated, near, {"__day": "day"}, {"near": "__near"})
    return flagged.withColumn(out, F.coalesce("__near", F.lit(0))).drop("__day", "__near")


def shift_season(df: DataFrame, season: str = "QUARTER", period: int = 4) -> DataFrame:
    """Relabel figures of one season as known in the next one."""
    year, following = next_season(F.col("YEAR"), F.col(season), period)
    return df.withColumns({"YEAR_NEW": year, f"{season}_NEW": following}).drop("YEAR", season)


def join_centrality(df: DataFrame, shifted: DataFrame, season: str = "QUARTER") -> DataFrame:
    """Centrality of the origin airport in the season before; null in the first."""
    keys = ["YEAR_NEW", f"{season}_NEW", "id"]
    return lookup_join(
        df, require_unique(shifted, keys),
        {"YEAR": "YEAR_NEW", season: f"{season}_NEW", "ORIGIN": "id"}, {"pagerank": "pagerank"},
    )
