"""Nearest station and the weather known some hours ahead."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolag.functions.geo import EARTH_RADIUS_KM, central_angle, haversine_km
from aerolag.functions.scalar import hour_block, public_block
from aerolag.operators.joins import BROADCAST_ROWS, broadcast_if_small, lookup_join
from aerolag.sources.stage import stage_table

# Levels of the grid; a cell of the last one is less than a metre wide.
_DEPTH = 25
# Places that a cell may hold without being split.
LEAF_PLACES = 32
# Kept cells may be this much (radians, under 0.1 m) farther than the bound, so
# that rounding never loses the nearest station or a tie.
_SLACK = 1e-8


def _finest(value: Column, low: float, width: float) -> Column:
    """Which of the last level's rows or columns a coordinate lies in."""
    at = F.floor((value - low) / F.lit(width / (1 << _DEPTH))).cast("long")
    return F.least(F.greatest(at, F.lit(0)), F.lit((1 << _DEPTH) - 1))


def _cell_id(level: Column, row: Column, col: Column) -> Column:
    """A number for each cell of each level: levels begin at powers of four."""
    return F.lit(1).cast("long") * F.pow(F.lit(4.0), level).cast("long") + row * F.pow(F.lit(2.0), level).cast("long") + col


def _sides(cell: Column) -> tuple[Column, Column, Column, Column]:
    """South and west edge of a cell, its height and its breadth, in degrees."""
    cells = F.pow(F.lit(2.0), cell["level"])
    height, breadth = F.lit(180.0) / cells, F.lit(360.0) / cells
    return cell["row"] * height - 90, cell["col"] * breadth - 180, height, breadth


def _flattest(south: Column, height: Column) -> Column:
    """The latitude of a cell that is nearest to the equator."""
    return F.when((south <= 0) & (south + height >= 0), F.lit(0.0)).otherwise(F.least(F.abs(south), F.abs(south + height)))


def _least_angle(south: Column, west: Column, height: Column, breadth: Column, cell: Column) -> Column:
    """No place of a box is nearer than this to any place of a cell.

    Boxes that are apart in latitude are at least as far apart on the sphere,
    and to get past a gap in longitude the nearer of its meridians must be reached,
    which is nearest to the box's latitude farthest from the equator.
    """
    cell_south, cell_west, cell_height, cell_breadth = _sides(cell)
    apart = F.greatest(cell_south - (south + height), south - (cell_south + cell_height), F.lit(0.0))
    east = F.pmod(cell_west - west, F.lit(360.0)) - breadth  # gaps on either side, below 0 where they overlap
    back = F.pmod(west - cell_west, F.lit(360.0)) - cell_breadth
    gap = F.least(F.greatest(F.least(east, back), F.lit(0.0)), F.lit(90.0))
    steepest = F.least(F.greatest(F.abs(south), F.abs(south + height)), F.lit(90.0))
    return F.greatest(F.radians(apart), F.asin(F.cos(F.radians(steepest)) * F.sin(F.radians(gap))))


def _reach(south: Column, height: Column, breadth: Column) -> Column:
    """No place of a cell is farther than this from its centre."""
    flat = F.cos(F.radians(_flattest(south, height))) * F.sin(F.radians(breadth / 4))
    up = F.sin(F.radians(height / 4))
    return 2 * F.asin(F.least(F.sqrt(up * up + flat * flat), F.lit(1.0)))


def _block_bounds(block: Column, cell: Column) -> tuple[Column, Column]:
    """Least and greatest angle from anything in one cell to anything in another."""
    south, west, height, breadth = _sides(block)
    cell_south, cell_west, cell_height, cell_breadth = _sides(cell)
    middle = central_angle(south + height / 2, west + breadth / 2, cell_south + cell_height / 2, cell_west + cell_breadth / 2)
    greatest = middle + _reach(south, height, breadth) + _reach(cell_south, cell_height, cell_breadth)
    return _least_angle(south, west, height, breadth, cell), greatest


def _station_grid(stations: DataFrame, station: str, leaf_places: int) -> tuple[DataFrame, DataFrame]:
    """The occupied cells of an adaptive grid, and the places in its leaves.

    Cells are quartered as long as they hold more than ``leaf_places`` places;
    those with a single occupied quarter are passed over. (id, parent, depth,
    level, row, col, leaf) per cell; (id, places) per leaf. Only places at less
    than a metre of each other can share a larger leaf.
    """
    places = stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy("lat", "lon").agg(
        F.min(station).alias("station"))
    places = places.withColumns({"r": _finest(F.col("lat"), -90.0, 180.0), "c": _finest(F.col("lon"), -180.0, 360.0)})
    places = stage_table(places, "places")
    at_levels = places.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(_DEPTH)))).withColumns({
        "row": F.expr(f"shiftright(r, {_DEPTH} - level)"), "col": F.expr(f"shiftright(c, {_DEPTH} - level)")})
    counts = at_levels.groupBy("level", "row", "col").agg(F.count("*").alias("n")).withColumns({
        "id": _cell_id(F.col("level"), F.col("row"), F.col("col")),
        "parent": F.when(F.col("level") > 0, _cell_id(F.col("level") - 1, F.shiftright("row", 1), F.shiftright("col", 1))),
        "leaf": (F.col("n") <= leaf_places) | (F.col("level") == _DEPTH),
    })
    counts = stage_table(counts, "cell-counts")
    split = counts.filter(~F.col("leaf")).select(F.col("id").alias("parent"))
    occupied = counts.filter("level = 0").unionByName(counts.join(split, "parent").select(counts.columns)).drop("n")
    occupied = stage_table(occupied, "occupied")
    branching = occupied.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("quarters")).filter("quarters > 1")
    kept = occupied.filter("leaf or level = 0").unionByName(
        occupied.filter("not leaf and level > 0").join(branching.select("id"), "id", "left_semi")).drop("parent")
    kept = stage_table(kept, "kept-cells")
    # The cells on the way to a place are each other's ancestors.
    inside = at_levels.withColumn("id", _cell_id(F.col("level"), F.col("row"), F.col("col")))
    down = Window.partitionBy("r", "c", "station").orderBy("level")
    tree = inside.join(kept.select("id"), "id").select(
        "id", F.lag("id").over(down).alias("parent"), (F.row_number().over(down) - 1).alias("depth")).distinct()
    cells = stage_table(kept.join(tree, "id"), "cells")
    leaves = inside.join(cells.filter("leaf").select("id"), "id").groupBy("id").agg(
        F.collect_list(F.struct("lat", "lon", "station")).alias("places"))
    return cells, stage_table(leaves, "leaves")


def _at_level(level: Column | int) -> tuple[Column, Column]:
    """Row and column of the cell of a level that a site lies in."""
    level = F.lit(level) if isinstance(level, int) else level
    below = F.lit(_DEPTH) - level
    return F.call_function("shiftright", F.col("__r"), below), F.call_function("shiftright", F.col("__c"), below)


def _block_id(level: Column | int) -> Column:
    return _cell_id(F.lit(level) if isinstance(level, int) else level, *_at_level(level))


def _walk(cells: DataFrame, sites: DataFrame, levels: Sequence[int]) -> DataFrame:
    """(id, level, home, cells): blocks of sites, the leaves that can hold the nearest station of any of them,
    and the one whose places are surely near.

    A block is the sites in a cell of the grid; every site ends in one. All blocks are
    on one level, on which those whose cells are all leaves stay and the
    others are quartered, with the cells of that level among those they kept.
    """
    if not levels:
        return cells.select("id", "level", F.col("id").alias("home"), F.array(F.struct("id", "level", "row", "col")).alias("cells"))
    # Few bytes make much work here, so partitions are as many as the session has, whatever their size.
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row, col = _at_level(levels[-1])
    spread = 1 << (_DEPTH - levels[-1])
    spots = stage_table(sites.select((row * spread).alias("__r"), (col * spread).alias("__c")).distinct(), "spots")
    cell = F.struct("id", "level", "row", "col", "leaf")
    walk = cells.filter("level = 0").select(F.col("id").alias("__b"), F.col("id").alias("home"), F.array(cell).alias("cells"))
    ended = []
    for level, below in zip(levels, [*levels[1:], None]):
        goes_on = F.exists("cells", lambda x: ~x["leaf"])
        ended.append(walk.filter(~goes_on).select(
            F.col("__b").alias("id"), F.lit(level).alias("level"), "home",
            F.transform("cells", lambda x: F.struct(x["id"], x["level"], x["row"], x["col"])).alias("cells")))
        if below is None:
            break
        opened = F.col("parent").between(4**level, 4 ** (level + 1) - 1)
        children = cells.filter(opened).select(F.col("parent").alias("__p"), cell.alias("__child"))
        walk = walk.filter(goes_on).repartition(tasks, "__b").select("__b", F.explode("cells").alias("__cell"))
        # Leaves have no children, and deeper cells are not opened yet; they stay as they are.
        walk = walk.join(broadcast_if_small(children), F.col("__cell.id") == F.col("__p"), "left")
        walk = walk.select("__b", F.coalesce("__child", "__cell").alias("__cell"))
        row, col = _at_level(below)
        quarters = spots.select(
            _block_id(level).alias("__b"), _block_id(below).alias("__id"),
            F.struct(F.lit(below).alias("level"), row.alias("row"), col.alias("col")).alias("__block")).distinct()
        least, greatest = _block_bounds(F.col("__block"), F.col("__cell"))
        walk = walk.join(quarters, "__b").groupBy("__id").agg(
            F.min(F.struct(greatest.alias("bound"), F.col("__cell.id").alias("id"))).alias("__home"),
            F.collect_list(F.struct(least.alias("least"), F.col("__cell").alias("cell"))).alias("__all"))
        kept = F.filter("__all", lambda x: x["least"] <= F.col("__home.bound") + _SLACK)
        walk = stage_table(walk.select(
            F.col("__id").alias("__b"), F.col("__home.id").alias("home"), F.transform(kept, lambda x: x["cell"]).alias("cells")), "walk")
    return reduce(DataFrame.unionByName, ended)


def nearest_station(
    airports: DataFrame,
    stations: DataFrame,
    airport: str = "airport",
    station: str = "station",
    leaf_places: int = LEAF_PLACES,
) -> DataFrame:
    """The station closest to each airport, ties by station id.

    Exact, without comparing every airport with every station. Airports that
    share a cell of the grid walk down together, as one block: at each level of
    the stations' adaptive grid a block keeps the occupied cells that could still
    hold the nearest station of any of its airports, and is quartered while
    some of them are. So the walk costs by block and not by airport. In the
    end each airport meets the places of the leaf nearest to it, and of the other leaves that
    lie no farther than what it found. Stations at the same place are one until the end.
    """
    cells, leaves = _station_grid(stations, station, leaf_places)
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # one row a level
    # One place per airport, however often the airport is listed.
    sites = airports.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy(F.col(airport).alias("__a")).agg(
        F.min(F.struct("lat", "lon")).alias("at")).select("__a", F.col("at.lat").alias("__lat"), F.col("at.lon").alias("__lon"))
    sites = sites.withColumns({"__r": _finest(F.col("__lat"), -90.0, 180.0), "__c": _finest(F.col("__lon"), -180.0, 360.0)})
    sites = stage_table(sites, "sites")
    blocks = stage_table(_walk(cells, sites, levels), "blocks")
    ends = [r["level"] for r in blocks.select("level").distinct().collect()]  # levels at which blocks ended
    sites = sites.withColumn("__level", F.explode(F.array(*[F.lit(x) for x in ends]).cast("array<int>")))
    sites = sites.withColumn("__b", _block_id(F.col("__level"))).select("__a", "__lat", "__lon", "__b")
    blocks = broadcast_if_small(blocks.select(F.col("id").alias("__b"), "home", "cells"))
    leaves = broadcast_if_small(leaves)
    # Rounded to a millimetre, so that equal distances tie in any order of arithmetic. Places are rows and not
    # elements here, for Spark interprets functions over elements.
    km = F.round(haversine_km(F.col("__lat"), F.col("__lon"), F.col("place.lat"), F.col("place.lon")), 6)
    met = sites.join(blocks, "__b").join(leaves, F.col("home") == F.col("id")).select(*sites.columns, F.explode("places").alias("place"))
    met = stage_table(met.groupBy(*sites.columns).agg(F.min(km).alias("__km")), "met")
    least = _least_angle(F.col("__lat"), F.col("__lon"), F.lit(0.0), F.lit(0.0), F.col("cell"))
    near = met.join(blocks, "__b").select("__a", "__lat", "__lon", "__km", F.explode("cells").alias("cell")).filter(
        least <= F.col("__km") / EARTH_RADIUS_KM + _SLACK).select("__a", "__lat", "__lon", "__km", F.col("cell.id").alias("id"))
    near = near.join(leaves, "id").select("__a", "__lat", "__lon", "__km", F.explode("places").alias("place"))
    near = near.select("__a", F.col("__km").alias("__bound"), km.alias("km"), F.col("place.station").alias("station"))
    return (
        near.filter(F.col("km") <= F.col("__bound") + 1e-6)
        .groupBy(F.col("__a").alias(airport)).agg(F.min(F.struct("km", "station")).alias("b"))
        .select(airport, F.col("b.station").alias("closest_station"), F.col("b.km").alias("distance_km"))
    )


def add_coordinates(df: DataFrame, airports: DataFrame, role: str = "ORIGIN", airport: str = "airport") -> DataFrame:
    """Latitude and longitude of an airport role."""
    return lookup_join(df, airports, {role: airport}, {"lat": f"{role}_lat", "lon": f"{role}_lon"})


def add_closest_station(df: DataFrame, nearest: DataFrame, role: str = "ORIGIN", airport: str = "airport") -> DataFrame:
    """The closest station of the airport each row departs from."""
    return lookup_join(df, nearest, {role: airport}, {"closest_station": "closest_station"})


def shift_block(
    df: DataFrame, ts: str, hours: int = 2, date_out: str = "block_date", block_out: str = "block", night: bool = False
) -> DataFrame:
    """Date and block of a time moved back; midnight rolls the date.

    Blocks are hours; with ``night`` the hours before six are one block, as in
    public schedules. The time is moved and not the block, so a time that leaves
    the night block backwards gets the evening's block of the day before.
    """
    moved = F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(hours))
    block = public_block(F.hour(moved)) if night else hour_block(F.hour(moved))
    return df.withColumns({date_out: moved.cast("date"), block_out: block})


def latest_observation(
    obs: DataFrame, cols: Sequence[str], station: str = "station", ts: str = "obs_ts", tie: str | None = None
) -> DataFrame:
    """One observation per station, date and block: the latest, ties by ``tie``.

    A maximum by key, so copies are combined before the shuffle.
    """
    order = F.struct(ts, tie) if tie else F.col(ts)
    placed = shift_block(obs, ts, 0)
    newest = F.max_by(F.struct(ts, *cols), order)
    return placed.groupBy(station, "block_date", "block").agg(newest.alias("o")).select(
        station, "block_date", "block", "o.*"
    )


def join_weather(
    df: DataFrame,
    obs: DataFrame,
    cols: Sequence[str],
    ts: str = "DEP_TS",
    fact_station: str = "closest_station",
    hours: int = 2,
    obs_ts: str = "obs_ts",
    tie: str | None = None,
) -> DataFrame:
    """Weather at the closest station in the block ``hours`` before departure.

    Every row is kept. Observations are far too many to broadcast in general;
    beyond the bound this is a shuffled join on station, date and block, whose
    right side holds one row per key.
    """
    latest = stage_table(latest_observation(obs, cols, ts=obs_ts, tie=tie), "observations")
    keyed = shift_block(df, ts, hours, "__date", "__block")
    joined = lookup_join(
        keyed, latest,
        {fact_station: "station", "__date": "block_date", "__block": "block"},
        {obs_ts: "weather_ts", **{c: c for c in cols}},
    )
    return joined.drop("__date", "__block")
