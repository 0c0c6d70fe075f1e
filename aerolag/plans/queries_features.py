"""Queries: weather, enrichment, history, space and graph."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.functions.clock import clock_state, local_timestamp
from aerolag.operators import enrich, graph, history, spatial, weather
from aerolag.plans import inputs
from aerolag.plans.oracle import sql
from aerolag.plans.queries_profile import PARSED, parsed, ranks
from aerolag.plans.registry import query, rounded
from aerolag.sources.stage import stage_table


def _rounded_list(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@query("parse_weather", sql(f"SELECT FLIGHT_ID, {_rounded_list(PARSED)} FROM parsed", "parsed"))
def _(spark, d):
    return rounded(parsed(spark, d).select("FLIGHT_ID", *PARSED))


_LOOSE = tuple("gust_speed" if c == "wind_speed_quality" else c for c in PARSED)


@query("parse_weather_reference", sql(f"SELECT FLIGHT_ID, {_rounded_list(_LOOSE)} FROM parsed_reference", "parsed_reference"))
def _(spark, d):
    loose = weather.parse_packed(inputs.weather_flights(spark, d), sentinels="reference")
    return rounded(loose.select("FLIGHT_ID", *_LOOSE))


@query("ceiling_flags", sql("""
    SELECT FLIGHT_ID, CASE WHEN ceiling_height < 10000 THEN 1 ELSE 0 END AS ceiling_height_is_below_10000,
      CASE WHEN ceiling_height >= 10000 AND ceiling_height < 20000 THEN 1 ELSE 0 END AS ceiling_height_is_between_10000_20000,
      CASE WHEN ceiling_height >= 20000 THEN 1 ELSE 0 END AS ceiling_height_is_above_20000
    FROM parsed""", "parsed"))
def _(spark, d):
    flagged = weather.band_flags(parsed(spark, d))
    return flagged.select("FLIGHT_ID", *[c for c in flagged.columns if c.startswith("ceiling_height_is")])


_CODES = "(CASE WHEN AW1 <> '' THEN 1 ELSE 0 END + CASE WHEN AW2 <> '' THEN 1 ELSE 0 END + CASE WHEN MW1 <> '' THEN 1 ELSE 0 END)"


@query("special_weather", sql(f"""
    SELECT FLIGHT_ID, {_CODES} AS code_count, CASE WHEN {_CODES} > 0 THEN 1 ELSE 0 END AS specWeather
    FROM weather""", "weather"))
def _(spark, d):
    counted = weather.present_count(inputs.weather_flights(spark, d)).withColumn("code_count", F.col("specWeather"))
    return weather.binarise(counted).select("FLIGHT_ID", "code_count", "specWeather")


@query("airport_volume", sql("SELECT airport, round(avg_yr_flights, 6) AS avg_yr_flights FROM volume", "volume"))
def _(spark, d):
    return rounded(enrich.airport_volume(inputs.routes(spark, d), test_year=2001))


@query("volume_join", sql("""
    SELECT FL_DATE, ORIGIN, DEST, r.DISTANCE, round(o.avg_yr_flights, 6) AS origin_yr_flights,
      round(t.avg_yr_flights, 6) AS dest_yr_flights
    FROM routes r LEFT JOIN volume o ON r.ORIGIN = o.airport LEFT JOIN volume t ON r.DEST = t.airport""", "routes", "volume"))
def _(spark, d):
    routes = inputs.routes(spark, d)
    joined = enrich.join_volume(routes, enrich.airport_volume(routes, test_year=2001))
    return rounded(joined, only=["origin_yr_flights", "dest_yr_flights"]).select(
        "FL_DATE", "ORIGIN", "DEST", "DISTANCE", "origin_yr_flights", "dest_yr_flights")


@query("holiday_dates", sql("SELECT d AS date FROM holiday_dates", "holiday_dates"))
def holiday_dates(spark: SparkSession, d: str) -> DataFrame:
    return enrich.paid_holidays(
        inputs.holidays(spark, d), "United States", dt.date(1996, 1, 1), dt.date(2000, 12, 31)
    ).distinct()


def holiday_flagged(spark: SparkSession, d: str) -> DataFrame:
    return enrich.flag_near_dates(inputs.order_flights(spark, d), holiday_dates(spark, d))


@query("holiday_flag", sql("SELECT FLIGHT_ID, FL_DATE, isHoliday FROM holiday_flagged", "holiday_flagged"))
def _(spark, d):
    return holiday_flagged(spark, d).select("FLIGHT_ID", "FL_DATE", "isHoliday")


def with_utc(spark: SparkSession, d: str, rule: str = "actual") -> DataFrame:
    return history.add_utc_times(inputs.flights(spark, d), inputs.utc_lookup(spark, d), rule)


_UTC = ("CRS_DEP_DATETIME_UTC", "ARR_DATETIME_UTC", "DEP_DATETIME_UTC")


@query("utc_times", sql(f"SELECT FLIGHT_ID, {', '.join(_UTC)} FROM utc", "utc"))
def _(spark, d):
    return with_utc(spark, d).select("FLIGHT_ID", *_UTC)


@query("utc_times_reference", sql("""
    SELECT FLIGHT_ID, CRS_DEP_DATETIME_UTC,
      CRS_DEP_DATETIME_UTC + to_minutes(cast(DEP_DELAY + ARR_DELAY + ACTUAL_ELAPSED_TIME AS bigint)) AS ARR_DATETIME_UTC,
      DEP_DATETIME_UTC FROM utc""", "utc"))
def _(spark, d):
    return with_utc(spark, d, "reference").select("FLIGHT_ID", *_UTC)


def _zoned_sql(overlap: str) -> str:
    summer = "summer" if overlap == "first" else "summer AND NOT repeated"
    return sql(f"""
        SELECT FLIGHT_ID, state, CRS_DEP_DATETIME_UTC,
          CRS_DEP_DATETIME_UTC + to_minutes(cast(DEP_DELAY + 60 AS bigint)) AS ARR_DATETIME_UTC,
          CRS_DEP_DATETIME_UTC + to_minutes(cast(DEP_DELAY AS bigint)) AS DEP_DATETIME_UTC
        FROM (SELECT FLIGHT_ID, DEP_DELAY,
          CASE WHEN hours IS NOT NULL THEN CASE WHEN changes AND skipped THEN 'never' WHEN changes AND repeated THEN 'twice'
            ELSE 'once' END END AS state,
          clock + to_minutes(cast(60 * (hours - CASE WHEN changes AND {summer} THEN 1 ELSE 0 END) AS bigint)) AS CRS_DEP_DATETIME_UTC
        FROM zoned)""", "zoned")


def by_zone(spark: SparkSession, d: str, overlap: str) -> DataFrame:
    placed = history.add_utc_times_by_zone(inputs.dated_flights(spark, d), inputs.zone_lookup(spark, d), overlap=overlap)
    clock = local_timestamp(F.col("FL_DATE"), F.col("CRS_DEP_TIME"))
    return placed.withColumn("state", clock_state(clock, F.col("UTC_zone"))).select("FLIGHT_ID", "state", *_UTC)


@query("utc_times_zones", _zoned_sql("first"))
def _(spark, d):
    """Zone names in place of fixed offsets; skipped and repeated times are told apart."""
    return by_zone(spark, d, "first")


@query("utc_times_zones_second", _zoned_sql("second"))
def _(spark, d):
    return by_zone(spark, d, "second")


_LAGS = tuple(
    f"PREV_{c}_{i}" for c in ("ARR_DATETIME_UTC", "ARR_DELAY", "DEP_DATETIME_UTC", "DEP_DELAY") for i in (1, 2, 3)
)
_LAG_SQL = sql(f"SELECT FLIGHT_ID, {', '.join(_LAGS)} FROM lagged", "lagged")


@query("history_lag", _LAG_SQL)
def _(spark, d):
    return history.lag_features(with_utc(spark, d)).select("FLIGHT_ID", *_LAGS)


@query("history_lag_cut_keys", _LAG_SQL)
def _(spark, d):
    """The same lags over so many partitions that most aircraft are cut."""
    return history.lag_features(with_utc(spark, d), parts=97).select("FLIGHT_ID", *_LAGS)


_NOT_CANCELLED = sql("""
    SELECT FLIGHT_ID, lag(DEP_DELAY, 1) OVER w AS PREV_DEP_DELAY_1 FROM utc WHERE CANCELLED = 0
    WINDOW w AS (PARTITION BY TAIL_NUM ORDER BY CRS_DEP_DATETIME_UTC, FLIGHT_ID)
    UNION ALL SELECT FLIGHT_ID, NULL FROM utc WHERE CANCELLED = 1""", "utc")


@query("history_lag_flown_only", _NOT_CANCELLED)
def _(spark, d):
    lagged = history.lag_features(with_utc(spark, d), cols=["DEP_DELAY"], n=1, exclude=F.col("CANCELLED") == 1)
    return lagged.select("FLIGHT_ID", "PREV_DEP_DELAY_1")


_GAPS = tuple(f"PREV_{s}_TIME_DIFF_{i}" for s in ("ARR", "DEP") for i in (1, 2, 3))


@query("history_gaps", sql("SELECT FLIGHT_ID, " + ", ".join(
    f"cast(gap_{s}_{i} AS integer) AS PREV_{s}_TIME_DIFF_{i}" for s in ("ARR", "DEP") for i in (1, 2, 3)) + " FROM gaps", "gaps"))
def _(spark, d):
    return history.history_gaps(history.lag_features(with_utc(spark, d))).select("FLIGHT_ID", *_GAPS)


_HIST = ("HIST_ARR_DELAY", "HIST_ARR_FLT_NUM", "HIST_DEP_DELAY", "HIST_DEP_FLT_NUM")


@query("history_pick_strict", sql(f"SELECT FLIGHT_ID, {', '.join(_HIST)} FROM history_strict", "history_strict"))
def _(spark, d):
    return history.pick_history(history.lag_features(with_utc(spark, d))).select("FLIGHT_ID", *_HIST)


@query("history_pick_reference", sql(f"SELECT FLIGHT_ID, {', '.join(_HIST)} FROM history_reference", "history_reference"))
def _(spark, d):
    return history.pick_history(history.lag_features(with_utc(spark, d)), guard="reference").select("FLIGHT_ID", *_HIST)


@query("time_block_shift", sql("""
    SELECT FLIGHT_ID, cast(DEP_TS - INTERVAL 2 HOUR AS date) AS block_date,
      strftime(DEP_TS - INTERVAL 2 HOUR, '%H') || '00-' || strftime(DEP_TS - INTERVAL 2 HOUR, '%H') || '59' AS block
    FROM flights""", "flights"))
def _(spark, d):
    return spatial.shift_block(inputs.flights(spark, d), "DEP_TS").select("FLIGHT_ID", "block_date", "block")


@query("time_block_night", sql("""
    SELECT FLIGHT_ID, cast(DEP_TS - INTERVAL 2 HOUR AS date) AS block_date,
      CASE WHEN extract(hour FROM DEP_TS - INTERVAL 2 HOUR) < 6 THEN '0001-0559'
        ELSE strftime(DEP_TS - INTERVAL 2 HOUR, '%H') || '00-' || strftime(DEP_TS - INTERVAL 2 HOUR, '%H') || '59' END AS block
    FROM flights""", "flights"))
def _(spark, d):
    """Blocks of public schedules, with one for the night."""
    return spatial.shift_block(inputs.flights(spark, d), "DEP_TS", night=True).select("FLIGHT_ID", "block_date", "block")


def _nearest_sql(view: str, stations: str = "stations") -> str:
    return sql(f"""
        SELECT airport, b.station AS closest_station, b.km AS distance_km FROM (
          SELECT airport, min(struct_pack(km := km, station := station)) AS b FROM (
          SELECT airport, station, round(asin(sqrt(least(1e0,
            sin(radians(s.lat - a.lat) / 2) * sin(radians(s.lat - a.lat) / 2)
            + cos(radians(a.lat)) * cos(radians(s.lat))
              * sin(radians(s.lon - a.lon) / 2) * sin(radians(s.lon - a.lon) / 2)))) * 2 * 6371e0, 6) AS km
          FROM {view} a CROSS JOIN {stations} s)
        GROUP BY airport)""", view, stations)


@query("nearest_station", _nearest_sql("airports"))
def _(spark, d):
    return spatial.nearest_station(inputs.airports(spark, d), inputs.stations(spark, d))


@query("nearest_station_sites", _nearest_sql("sites"))
def _(spark, d):
    return spatial.nearest_station(inputs.customer_sites(spark, d), inputs.stations(spark, d))


@query("nearest_station_dense", _nearest_sql("crowded_sites", "crowded_stations"))
def _(spark, d):
    """All sites and stations within a few kilometres."""
    return spatial.nearest_station(inputs.crowded_sites(spark, d), inputs.crowded_stations(spark, d))


_PACKED = ("WND", "CIG", "VIS", "TMP", "DEW", "SLP")


@query("report_types", sql("""
    SELECT REPORT_TYPE, count(*) AS n FROM observations WHERE REPORT_TYPE IN ('FM-15', 'SOA') GROUP BY 1""", "observations"))
def _(spark, d):
    kept = weather.keep_report_types(inputs.observations(spark, d))
    return kept.groupBy("REPORT_TYPE").agg(F.count("*").alias("n"))


@query("weather_join", sql(f"""
    SELECT FLIGHT_ID, o.obs_ts AS weather_ts, {', '.join('o.' + c for c in _PACKED)}
    FROM flights f LEFT JOIN kept_observations o
      ON o.station = (f.FLIGHT_ID * 7 + 3) % 5 AND o.obs_hour = date_trunc('hour', f.DEP_TS - INTERVAL 2 HOUR)""",
    "flights", "kept_observations"))
def _(spark, d):
    placed = inputs.flights(spark, d).withColumn("closest_station", (F.col("FLIGHT_ID") * 7 + 3) % 5)
    obs = weather.keep_report_types(inputs.observations(spark, d))
    return spatial.join_weather(placed, obs, _PACKED, tie="obs_id").select("FLIGHT_ID", "weather_ts", *_PACKED)


_STATION_OF_AIRPORT = """
    SELECT airport, station AS closest_station FROM (
      SELECT airport, station, round(asin(sqrt(least(1e0,
        sin(radians(s.lat - a.lat) / 2) * sin(radians(s.lat - a.lat) / 2)
        + cos(radians(a.lat)) * cos(radians(s.lat))
          * sin(radians(s.lon - a.lon) / 2) * sin(radians(s.lon - a.lon) / 2)))) * 2 * 6371e0, 6) AS km
      FROM airports a CROSS JOIN stations s)
    QUALIFY row_number() OVER (PARTITION BY airport ORDER BY km, station) = 1"""


@query("flight_weather", sql(f"""
    SELECT f.FLIGHT_ID, round(a.lat, 6) AS ORIGIN_lat, round(a.lon, 6) AS ORIGIN_lon, n.closest_station,
      o.obs_ts AS weather_ts, o.TMP
    FROM flights f LEFT JOIN airports a ON f.ORIGIN = a.airport
      LEFT JOIN ({_STATION_OF_AIRPORT}) n ON f.ORIGIN = n.airport
      LEFT JOIN kept_observations o
        ON o.station = n.closest_station % 5 AND o.obs_hour = date_trunc('hour', f.DEP_TS - INTERVAL 2 HOUR)""",
    "flights", "airports", "stations", "kept_observations"))
def _(spark, d):
    """Coordinates, nearest station and the weather there two hours ahead."""
    airports = inputs.airports(spark, d)
    nearest = stage_table(spatial.nearest_station(airports, inputs.stations(spark, d)), "nearest")
    located = spatial.add_coordinates(inputs.flights(spark, d), airports)
    placed = spatial.add_closest_station(located, nearest).withColumn("feed", F.col("closest_station") % 5)
    obs = weather.keep_report_types(inputs.observations(spark, d))
    joined = spatial.join_weather(placed, obs, ["TMP"], fact_station="feed", tie="obs_id")
    return rounded(joined.select("FLIGHT_ID", "ORIGIN_lat", "ORIGIN_lon", "closest_station", "weather_ts", "TMP"))


@query("season_edges", sql("SELECT * FROM edges", "edges"))
def _(spark, d):
    return graph.season_edges(inputs.routes(spark, d))


@query("pagerank_fixed", sql("""
    SELECT "YEAR", "QUARTER", id, round(pagerank, 6) AS pagerank FROM ranks_fixed""", "ranks_fixed"))
def _(spark, d):
    """Five steps, whether settled or not."""
    return rounded(graph.pagerank(graph.season_edges(inputs.routes(spark, d)), tol=None, max_iter=5).drop("steps"))


@query("pagerank_converged", sql("""
    SELECT "YEAR", "QUARTER", id, round(pagerank, 6) AS pagerank FROM ranks""", "ranks"))
def _(spark, d):
    return rounded(ranks(spark, d).drop("steps"))


@query("pagerank_season_join", sql("""
    SELECT FL_DATE, ORIGIN, DEST, DISTANCE, round(pagerank, 6) AS pagerank
    FROM routes r LEFT JOIN shifted_ranks s ON r."YEAR" = s.YEAR_NEW AND r."QUARTER" = s.QUARTER_NEW AND r.ORIGIN = s.id""",
    "routes", "shifted_ranks"))
def _(spark, d):
    joined = enrich.join_centrality(inputs.routes(spark, d), enrich.shift_season(ranks(spark, d)))
    return rounded(joined, only=["pagerank"]).select("FL_DATE", "ORIGIN", "DEST", "DISTANCE", "pagerank")


@query("centrality_cv", sql("""
    SELECT id, round(avg(pagerank), 6) AS mean, round(stddev_samp(pagerank), 6) AS stddev, count(*) AS seasons,
      round(stddev_samp(pagerank) / avg(pagerank), 6) AS cv, round(avg(pagerank) / stddev_samp(pagerank), 6) AS mean_over_sd
    FROM ranks GROUP BY id""", "ranks"))
def _(spark, d):
    return rounded(graph.centrality_spread(ranks(spark, d)))
