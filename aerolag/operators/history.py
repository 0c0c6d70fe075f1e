"""Clock times in UTC and the history of each aircraft."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolag.functions.clock import add_hours, add_minutes, local_timestamp, whole_minutes, zone_to_utc
from aerolag.operators.joins import lookup_join
from aerolag.schema import AIRCRAFT
from aerolag.sources.stage import Stages, stage_table

# Spark refuses tables of more buckets.
MAX_BUCKETS = 100_000
# Columns that lags and the choice among them read, as they are called by default.
READ_BY_LAGS = {
    AIRCRAFT, "FLIGHT_ID", "CRS_DEP_DATETIME_UTC", "ARR_DATETIME_UTC", "ARR_DELAY", "DEP_DATETIME_UTC", "DEP_DELAY",
}


def add_utc_times(df: DataFrame, offsets: DataFrame, arrival_rule: str = "actual") -> DataFrame:
    """Scheduled departure, departure and arrival in UTC, without a zone.

    ``offsets`` holds, per ORIGIN_AIRPORT_ID, the hours to add to local time.
    Arrival is departure plus the actual elapsed time; the rule "reference"
    adds the arrival delay on top, as the published features did.
    """
    placed = lookup_join(
        df, offsets, {"ORIGIN_AIRPORT_ID": "ORIGIN_AIRPORT_ID"}, {"UTC_offset_hours": "UTC_offset"}
    )
    scheduled = add_hours(local_timestamp(F.col("FL_DATE"), F.col("CRS_DEP_TIME")), F.col("UTC_offset"))
    return _from_schedule(placed, scheduled, arrival_rule)


def add_utc_times_by_zone(
    df: DataFrame, zones: DataFrame, arrival_rule: str = "actual", overlap: str = "first"
) -> DataFrame:
    """The same from zone names, so that clock changes are followed.

    ``zones`` holds a zone name per ORIGIN_AIRPORT_ID, in UTC_zone. ``overlap``
    says which of two times is meant when the clock shows one twice; skipped
    times are read with the offset before the change. ``clock_state`` of
    ``functions.clock`` tells such rows.
    """
    placed = lookup_join(df, zones, {"ORIGIN_AIRPORT_ID": "ORIGIN_AIRPORT_ID"}, {"UTC_zone": "UTC_zone"})
    scheduled = zone_to_utc(local_timestamp(F.col("FL_DATE"), F.col("CRS_DEP_TIME")), F.col("UTC_zone"), overlap)
    return _from_schedule(placed, scheduled, arrival_rule)


def _from_schedule(placed: DataFrame, scheduled: Column, arrival_rule: str) -> DataFrame:
    """Departure and arrival from the scheduled departure in UTC."""
    if arrival_rule not in ("actual", "reference"):
        raise ValueError(f"unknown arrival rule {arrival_rule!r}")
    in_air = F.col("DEP_DELAY") + F.col("ACTUAL_ELAPSED_TIME")
    if arrival_rule == "reference":
        in_air = in_air + F.col("ARR_DELAY")
    return placed.withColumn("CRS_DEP_DATETIME_UTC", scheduled).withColumns({
        "ARR_DATETIME_UTC": add_minutes(F.col("CRS_DEP_DATETIME_UTC"), in_air),
        "DEP_DATETIME_UTC": add_minutes(F.col("CRS_DEP_DATETIME_UTC"), F.col("DEP_DELAY")),
    })


def _partition_ends(placed: DataFrame, key: str, order: str, tie: str, cols: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of the key that goes on after each partition, and what each partition is to see of them.

    (__part, key, __halo): the rows of a partition's first key that lie in the
    partitions before it, latest first, at most ``n``. Only a partition's last
    key can go on, so there are at most ``n`` rows per partition.
    """
    edges = stage_table(
        placed.groupBy("__part").agg(F.min(key).alias("__first"), F.max(key).alias("__last")), "partition-keys")
    newest = Window.partitionBy("__part").orderBy(F.desc(order), F.desc(tie))
    # One row per partition.
    going_on = F.broadcast(edges.select("__part", F.col("__last").alias(key)))
    ends = (
        placed.select("__part", key, order, tie, F.struct(*cols).alias("__seen")).join(going_on, ["__part", key])
        .withColumn("__back", F.row_number().over(newest)).filter(F.col("__back") <= n)
        .select("__part", key, "__back", "__seen")
    )
    ends = stage_table(ends, "partition-ends")
    in_order = Window.partitionBy(key).orderBy("__part", F.desc("__back"))
    numbered = ends.withColumn("__place", F.row_number().over(in_order))
    # How many of the rows above come before a partition's first key.
    events = ends.select(key, "__part", F.lit(1).alias("__end")).unionByName(
        edges.select(F.col("__first").alias(key), "__part", F.lit(0).alias("__end")))
    so_far = Window.partitionBy(key).orderBy("__part", "__end").rowsBetween(Window.unboundedPreceding, 0)
    starts = events.withColumn("__before", F.sum("__end").over(so_far)).filter("__end = 0 and __before > 0")
    wanted = starts.select(
        key, F.col("__part").alias("__to"),
        F.explode(F.sequence(F.greatest(F.col("__before") - (n - 1), F.lit(1)), F.col("__before"))).alias("__place"))
    seen = F.sort_array(F.collect_list(F.struct("__place", "__seen")), asc=False)
    halo = numbered.join(wanted, [key, "__place"]).groupBy(F.col("__to").alias("__part"), key).agg(seen.alias("__halo"))
    return stage_table(halo.withColumn("__halo", F.col("__halo.__seen")), "halo")


def lag_features(
    df: DataFrame,
    key: str = AIRCRAFT,
    order: str = "CRS_DEP_DATETIME_UTC",
    cols: Sequence[str] = ("ARR_DATETIME_UTC", "ARR_DELAY", "DEP_DATETIME_UTC", "DEP_DELAY"),
    n: int = 3,
    tie: str = "FLIGHT_ID",
    exclude: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Values of the last ``n`` rows of the same key, as ``PREV_<column>_<i>``.

    All lags share one window, ordered by ``order`` (no time first) and then
    ``tie``. Rows that meet ``exclude`` (for instance cancelled ones) neither
    see nor are history. Rows without a key have no history and skip the window.

    Rows are range-partitioned once by key, time and id, so a key of any size,
    and one instant of any size, is spread over as many partitions as it fills.
    The partitions are written in buckets, in which the window runs without
    another shuffle. What the first key of a partition has to see from the
    partitions before it comes from a small table of partition ends, looked up
    by partition: the cost of a row does not depend on how keys are cut.
    ``parts``: number of partitions, by default the session's.
    """
    names = [(c, i, f"PREV_{c}_{i}") for c in cols for i in range(1, n + 1)]
    usable = F.col(key).isNotNull()
    if exclude is not None:
        usable = usable & ~F.coalesce(exclude, F.lit(False))
    # Rows outside any history go around the window.
    outside = df.filter(~usable).select("*", *[F.lit(None).cast(df.schema[c].dataType).alias(out) for c, _, out in names])

    spark = df.sparkSession
    parts = min(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    placed = df.filter(usable).repartitionByRange(parts, key, order, tie).withColumn("__part", F.spark_partition_id())
    placed = Stages(spark).put_bucketed(placed, "__part", parts, "history")
    halo = F.broadcast(_partition_ends(placed, key, order, tie, cols, n))  # at most n rows per partition
    window = Window.partitionBy("__part", key).orderBy(order, tie)
    lagged = placed.select(
        "*", F.row_number().over(window).alias("__at"), *[F.lag(c, i).over(window).alias(out) for c, i, out in names])
    joined = lagged.join(halo, ["__part", key], "left")
    inside = [
        F.when(F.col("__at") > i, F.col(out)).otherwise(F.get("__halo", F.lit(i) - F.col("__at"))[c]).alias(out)
        for c, i, out in names
    ]
    return joined.select(*df.columns, *inside).unionByName(outside)


def history_gaps(df: DataFrame, now: str = "CRS_DEP_DATETIME_UTC", n: int = 3) -> DataFrame:
    """Whole minutes from each past arrival and departure to the scheduled one,
    as ``PREV_ARR_TIME_DIFF_<i>`` and ``PREV_DEP_TIME_DIFF_<i>``."""
    return df.withColumns({
        f"PREV_{side}_TIME_DIFF_{i}": whole_minutes(F.col(now), F.col(f"PREV_{side}_DATETIME_UTC_{i}"))
        for side in ("ARR", "DEP") for i in range(1, n + 1)
    })


def pick_history(
    df: DataFrame,
    now: str = "CRS_DEP_DATETIME_UTC",
    guard_min: int = 120,
    n: int = 3,
    guard: str = "strict",
    keep_lags: bool = False,
) -> DataFrame:
    """The latest past delay that was known ``guard_min`` minutes ahead.

    Adds HIST_ARR_DELAY and HIST_DEP_DELAY with the number of the lag each came
    from. "strict" gives null when no lag is old enough. "reference" takes the
    last lag unchecked in that case, and also when a nearer gap is unknown.
    """
    if guard not in ("strict", "reference"):
        raise ValueError(f"unknown guard {guard!r}")
    out = {}
    # A gap of at least the guard is a time at or before this one.
    deadline = F.col(now) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(guard_min))
    for side in ("ARR", "DEP"):
        known = {i: F.col(f"PREV_{side}_DATETIME_UTC_{i}") <= deadline for i in range(1, n + 1)}
        if guard == "strict":
            tests = known
        else:
            tests, nearer_recent = {}, F.lit(True)
            for i in range(1, n):
                tests[i] = known[i] & nearer_recent
                nearer_recent = nearer_recent & ~known[i]
        first, *others = tests
        delay = F.when(tests[first], F.col(f"PREV_{side}_DELAY_{first}"))
        number = F.when(tests[first], first)
        for i in others:
            delay = delay.when(tests[i], F.col(f"PREV_{side}_DELAY_{i}"))
            number = number.when(tests[i], i)
        if guard == "reference":
            delay, number = delay.otherwise(F.col(f"PREV_{side}_DELAY_{n}")), number.otherwise(n)
        out[f"HIST_{side}_DELAY"], out[f"HIST_{side}_FLT_NUM"] = delay, number
    picked = df.withColumns(out)
    return picked if keep_lags else picked.drop(*[c for c in picked.columns if c.startswith("PREV_")])
