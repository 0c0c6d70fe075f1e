"""Airport centrality per season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.functions.scalar import ratio
from aerolag.sources.stage import Stages

SEASON = ("YEAR", "QUARTER")


def season_edges(df: DataFrame, by: Sequence[str] = SEASON) -> DataFrame:
    """Directed edges per season with the number of flights as weight.

    Flights are counted before the shuffle, so what travels is bounded by the
    pairs of airports, whatever the number of flights.
    """
    return df.groupBy(*by, F.col("ORIGIN").alias("src"), F.col("DEST").alias("dst")).agg(
        F.count("*").alias("flights")
    )


def season_vertices(edges: DataFrame, by: Sequence[str] = SEASON) -> DataFrame:
    """Airports that appear at either end of an edge, per season."""
    return edges.select(*by, F.explode(F.array("src", "dst")).alias("id")).distinct()


def pagerank(
    edges: DataFrame,
    by: Sequence[str] = SEASON,
    reset: float = 0.15,
    tol: float | None = 0.01,
    max_iter: int = 1000,
    steps_per_stage: int = 2,
) -> DataFrame:
    """PageRank of every season at once.

    Each flight is an edge of its own, so a step from an airport follows its
    flights in proportion to their number. Ranks start at 1 and are scaled in
    the end to sum to the number of airports of the season. Stops when no rank
    would move by more than ``tol`` in a step; ranks that still move after
    ``max_iter`` steps are an error. ``tol=None`` takes exactly ``max_iter``
    steps of all airports. ``steps`` tells how many a season took.

    With a ``tol``, a step concerns only airports that would move by more: each
    adds what it would move by to its rank and passes its share of it on. What
    an airport got but has not passed on stays with it. So fewer flights are
    joined as ranks settle, and a season without such airports takes no part.

    Every step is one join and one map-side combined sum. Ranks are written to
    the stage folder every ``steps_per_stage`` steps, so that neither the plan
    nor the lineage grows, and ``tol`` is looked at then. Only the last ranks
    stay in the folder.
    """
    by = list(by)
    with Stages(edges.sparkSession) as stages:
        links, vertices = _links(stages, edges, by)
        if tol is None:
            ranks = _iterate(stages, links, vertices, by, reset, max_iter, steps_per_stage)
        else:
            ranks = _settle(stages, links, vertices, by, reset, tol, max_iter, steps_per_stage)
        ranks = stages.keep(ranks)
    totals = ranks.groupBy(*by).agg(
        (F.count("*") / F.sum("rank")).alias("scale"), F.max("last").cast("int").alias("steps"))
    return ranks.join(totals, by).select(*by, "id", (F.col("rank") * F.col("scale")).alias("pagerank"), "steps")


def _links(stages: Stages, edges: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Staged links with the share of a source's flights that each has, and the vertices."""
    edges = stages.put(edges, "edges")
    out = edges.groupBy(*by, "src").agg(F.sum("flights").alias("total"))
    vertices = season_vertices(edges, by)
    # An edge of weight 0 to itself keeps airports without arrivals in the sum.
    links = edges.join(out, [*by, "src"]).select(*by, "src", "dst", (F.col("flights") / F.col("total")).alias("p"))
    links = stages.put(
        links.unionByName(
            vertices.select(*by, F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("p"))
        ),
        "links",
    )
    return links, vertices


def _iterate(
    stages: Stages, links: DataFrame, vertices: DataFrame, by: list[str], reset: float, max_iter: int, steps_per_stage: int,
) -> DataFrame:
    """The stage table of ranks after ``max_iter`` steps of all vertices."""
    ranks = stages.put(vertices.withColumn("rank", F.lit(1.0)), "ranks")
    steps = 0
    while steps < max_iter:
        earlier = ranks
        for _ in range(min(steps_per_stage, max_iter - steps)):
            old = ranks.select(*by, F.col("id").alias("src"), "rank")
            ranks = links.join(old, [*by, "src"]).groupBy(*by, F.col("dst").alias("id")).agg(
                (F.lit(reset) + F.lit(1 - reset) * F.sum(F.col("rank") * F.col("p"))).alias("rank"))
            steps += 1
        ranks = stages.put(ranks, "ranks")
        stages.drop(earlier)
    last = stages.put(ranks.withColumn("last", F.lit(steps)), "ranks")
    stages.drop(ranks)
    return last


def _settle(
    stages: Stages, links: DataFrame, vertices: DataFrame, by: list[str], reset: float, tol: float, max_iter: int,
    steps_per_stage: int,
) -> DataFrame:
    """The stage table of ranks once no vertex has more than ``tol`` to pass on.

    ``rest`` is what a vertex would move by in a step of all; ``sent`` counts the
    steps it took part in, and ``last`` is the last of them.
    """
    moving = F.abs("rest") > tol
    # From rank 1 everywhere: what the first step of all would change.
    first = links.groupBy(*by, F.col("dst").alias("id")).agg(
        (F.lit(reset) + F.lit(1 - reset) * F.sum("p") - 1.0).alias("rest"))
    state = vertices.join(first, [*by, "id"]).withColumns({
        "rank": F.lit(1.0), "sent": F.lit(0).cast("long"), "last": F.lit(0).cast("long")})
    state = stages.put(state, "ranks")
    steps = 0
    while state.filter(moving).limit(1).count():
        if steps >= max_iter:
            most = state.agg(F.max(F.abs("rest")).alias("d")).first()["d"]
            raise RuntimeError(f"a rank still moves by {most} after {steps} steps, more than {tol}")
        earlier = state
        for _ in range(min(steps_per_stage, max_iter - steps)):
            steps += 1
            active = state.filter(moving).select(*by, F.col("id").alias("src"), F.col("rest").alias("push"))
            got = links.filter("p > 0").join(active, [*by, "src"]).groupBy(*by, F.col("dst").alias("id")).agg(
                (F.lit(1 - reset) * F.sum(F.col("push") * F.col("p"))).alias("got"))
            state = state.join(got, [*by, "id"], "left").select(
                *by, "id",
                (F.when(moving, F.lit(0.0)).otherwise(F.col("rest")) + F.coalesce("got", F.lit(0.0))).alias("rest"),
                F.when(moving, F.col("rank") + F.col("rest")).otherwise(F.col("rank")).alias("rank"),
                (F.col("sent") + moving.cast("long")).alias("sent"),
                F.when(moving, F.lit(steps).cast("long")).otherwise(F.col("last")).alias("last"),
            )
        state = stages.put(state, "ranks")
        stages.drop(earlier)
    return state


def centrality_spread(ranks: DataFrame) -> DataFrame:
    """Mean of an airport's seasonal centrality and how much it varies.

    ``cv`` is deviation over mean; ``mean_over_sd`` is its inverse, the figure
    sometimes printed under the same name.
    """
    mean, sd = F.avg("pagerank"), F.stddev_samp("pagerank")
    return ranks.groupBy("id").agg(mean.alias("mean"), sd.alias("stddev"), F.count("*").alias("seasons")).withColumns({
        "cv": ratio(F.col("stddev"), F.col("mean")),
        "mean_over_sd": ratio(F.col("mean"), F.col("stddev")),
    })
