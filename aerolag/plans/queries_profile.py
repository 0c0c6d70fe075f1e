"""Queries: column forms, breakdowns and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.functions.scalar import MONTHS, WEEKDAYS, next_season
from aerolag.operators import breakdown, enrich, graph, history, profile, weather
from aerolag.plans import inputs
from aerolag.plans.oracle import sql
from aerolag.plans.registry import query, rounded
from aerolag.sources.stage import stage_table

PARSED = (
    "wind_direction", "wind_speed", "wind_speed_quality", "ceiling_height", "visibility", "temperature",
    "sea_level_pressure", "dew_point",
)
NUMBERS = ("wind_speed", "temperature", "sea_level_pressure", "DEP_DELAY", "DISTANCE")


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.parse_packed(inputs.weather_flights(spark, sf_dir))


def _breakdown_sql(view: str, dim: str, extra: str = "", where: str = "", tail: str = "") -> str:
    return sql(f"""
        SELECT *, round(100e0 * delayed_flights / total_flights, 6) AS delayed_pct,
          round(100e0 * non_delayed_flights / total_flights, 6) AS non_delayed_pct{extra}
        FROM (SELECT {dim}, count(*) FILTER (DEP_DEL15 = 1) AS delayed_flights,
            count(*) FILTER (DEP_DEL15 = 0) AS non_delayed_flights,
            count(*) FILTER (DEP_DEL15 IN (0, 1)) AS total_flights
          FROM {view} {where} GROUP BY 1 HAVING count(*) FILTER (DEP_DEL15 IN (0, 1)) > 0) {tail}""", view)


def _case(col: str, names: dict[int, str]) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items()) + " END"


@query("label_breakdown_origin", _breakdown_sql("routes", "ORIGIN"))
def _(spark, d):
    return rounded(breakdown.label_breakdown(inputs.routes(spark, d), "ORIGIN"))


@query("label_breakdown_weekday", _breakdown_sql("flights", "DAY_OF_WEEK", ", " + _case("DAY_OF_WEEK", WEEKDAYS) + " AS day_name"))
def _(spark, d):
    table = breakdown.label_breakdown(inputs.flights(spark, d), "DAY_OF_WEEK")
    return rounded(breakdown.named(table, "DAY_OF_WEEK", WEEKDAYS, "day_name")).orderBy("DAY_OF_WEEK")


@query("label_breakdown_month", _breakdown_sql("routes", '"MONTH"', ", " + _case('"MONTH"', MONTHS) + " AS month_name"))
def _(spark, d):
    table = breakdown.label_breakdown(inputs.routes(spark, d), "MONTH")
    return rounded(breakdown.named(table, "MONTH", MONTHS, "month_name")).orderBy("MONTH")


@query("label_breakdown_carrier", _breakdown_sql("flights", "OP_UNIQUE_CARRIER"))
def _(spark, d):
    return rounded(breakdown.label_breakdown(inputs.flights(spark, d), "OP_UNIQUE_CARRIER"))


@query("label_breakdown_block", _breakdown_sql("flights", "DEP_TIME_BLK"))
def _(spark, d):
    return rounded(breakdown.label_breakdown(inputs.flights(spark, d), "DEP_TIME_BLK")).orderBy("DEP_TIME_BLK")


@query("label_breakdown_bin", _breakdown_sql(
    "parsed", "cast(floor(wind_speed / 10) * 10 AS integer) AS wind_speed_bin",
    ", wind_speed_bin || '-' || (wind_speed_bin + 10) AS bin_label",
    "WHERE floor(wind_speed / 10) * 10 <= 50"))
def _(spark, d):
    return rounded(breakdown.binned_breakdown(parsed(spark, d), "wind_speed", cap=50, beyond="drop")).orderBy("wind_speed_bin")


@query("top10_airports", _breakdown_sql("routes", "ORIGIN", tail="ORDER BY total_flights DESC, ORIGIN LIMIT 10"))
def _(spark, d):
    return rounded(breakdown.label_breakdown(inputs.routes(spark, d), "ORIGIN", top=10))


@query("label_outer_join", sql("""
    SELECT coalesce(a.k, b.k) AS DEP_TIME_BLK, coalesce(delayed_flights, 0) AS delayed_flights,
      coalesce(non_delayed_flights, 0) AS non_delayed_flights
    FROM (SELECT DEP_TIME_BLK AS k, count(*) AS delayed_flights FROM flights WHERE DEP_DEL15 = 1 GROUP BY 1) a
      FULL JOIN (SELECT DEP_TIME_BLK AS k, count(*) AS non_delayed_flights FROM flights WHERE DEP_DEL15 = 0 GROUP BY 1) b
      ON a.k = b.k""", "flights"))
def _(spark, d):
    return breakdown.label_breakdown_joined(inputs.flights(spark, d), "DEP_TIME_BLK")


@query("status_crosscount", sql("""
    SELECT count(*) FILTER (DEP_DEL15 = 1 AND CANCELLED = 1) AS delayed_canceled,
      count(*) FILTER (DEP_DEL15 = 0 AND CANCELLED = 1) AS canceled_not_delayed,
      count(*) FILTER (DEP_DEL15 = 1 AND CANCELLED IS NULL) AS delayed_canceled_is_null,
      count(*) FILTER (DEP_DEL15 = 1 AND CANCELLED = 0) AS delayed_not_canceled
    FROM flights""", "flights"))
def _(spark, d):
    return breakdown.status_crosscount(inputs.flights(spark, d))


_NULL_COLUMNS = (*PARSED, "AW1", "AW2", "MW1", "DEP_DEL15", "DEP_DELAY", "CRS_ELAPSED_TIME", "DISTANCE")


@query("null_profile", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, count(*) AS total_rows FROM parsed""" for c in _NULL_COLUMNS
), "parsed"))
def _(spark, d):
    return profile.null_profile(parsed(spark, d), _NULL_COLUMNS)


@query("summary_stats", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(min({c}), 6) AS "min", round(max({c}), 6) AS "max",
        round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev FROM parsed""" for c in NUMBERS
), "parsed"))
def _(spark, d):
    return rounded(profile.summary_stats(parsed(spark, d), NUMBERS))


@query("quartiles", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.5) AS q2,
        quantile_disc({c}, 0.75) AS q3 FROM parsed""" for c in NUMBERS
), "parsed"))
def _(spark, d):
    return profile.quartiles(parsed(spark, d), NUMBERS)


_WIDE = ("big", "precise")


@query("quartiles_wide", sql("WITH wide AS (SELECT big, cast(big AS decimal(25,0)) * cast(1.0000000001 AS decimal(11,10)) AS precise "
    "FROM (SELECT 9007199254740993 + l_orderkey * 1000003 + l_linenumber AS big FROM lineitem)) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", " + ", ".join(f"cast(quantile_disc({c}, {q}) AS varchar) AS q{i}" for i, q in enumerate((0.25, 0.5, 0.75), 1))
    + " FROM wide" for c in _WIDE)))
def _(spark, d):
    """Quartiles of whole numbers that doubles cannot hold, and of decimals of 36 digits."""
    return profile.exact_quartiles(inputs.wide_numbers(spark, d), _WIDE)


@query("quartiles_sketch")
def _(spark, d):
    return profile.quartiles(parsed(spark, d), NUMBERS, accuracy=10_000)


_SKETCHED = ("DEP_DELAY", "DISTANCE", "CRS_ELAPSED_TIME")


@query("quartiles_daily_sketches", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, true AS within1, true AS within2, true AS within3
        FROM flights WHERE FL_DATE BETWEEN '2024-01-05' AND '2024-01-20'""" for c in _SKETCHED
), "flights"))
def _(spark, d):
    """Quartiles of a range of days from one stored sketch a day; all ranks must be within one percent."""
    flights = inputs.flights(spark, d)
    days = F.col("FL_DATE").between("2024-01-05", "2024-01-20")
    stored = stage_table(profile.quantile_sketches(flights, _SKETCHED, ["FL_DATE"]), "sketches")
    errors = profile.rank_errors(flights.filter(days), profile.merged_quantiles(stored.filter(days), _SKETCHED), _SKETCHED)
    return errors.select("column", "n", *[(F.col(f"e{i}") <= 0.01).alias(f"within{i}") for i in (1, 2, 3)])


@query("outlier_pct_3sigma", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < m - 3 * s OR {c} > m + 3 * s) AS outliers,
        round(100e0 * count(*) FILTER ({c} < m - 3 * s OR {c} > m + 3 * s) / count(*), 6) AS outlier_pct
        FROM parsed, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM parsed)""" for c in NUMBERS
), "parsed"))
def _(spark, d):
    return rounded(profile.outlier_share(parsed(spark, d), NUMBERS))


@query("histogram_30", sql("""
    SELECT cast(b AS integer) AS bin, round(lo + b * w, 6) AS lower, round(lo + (b + 1) * w, 6) AS upper,
      count(v) AS n
    FROM (SELECT unnest(range(0, 30)) AS b)
      CROSS JOIN (SELECT min(v) AS lo, (max(v) - min(v)) / 30 AS w FROM kept)
      LEFT JOIN kept ON least(floor((v - lo) / w), 29) = b
    GROUP BY ALL""".replace("kept", """(SELECT DEP_DELAY AS v FROM flights,
        (SELECT avg(DEP_DELAY) AS m, stddev_samp(DEP_DELAY) AS s FROM flights)
        WHERE DEP_DELAY BETWEEN m - 3 * s AND m + 3 * s)"""), "flights"))
def _(spark, d):
    return rounded(profile.histogram(inputs.flights(spark, d), "DEP_DELAY"))


@query("column_profile", sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
        round(100e0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_pct,
        round(100e0 * count(*) FILTER ({c} < m - 3 * s OR {c} > m + 3 * s) / count(*), 6) AS outlier_pct
        FROM parsed, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM parsed)""" for c in (*PARSED, "DISTANCE")
), "parsed"))
def _(spark, d):
    return rounded(profile.column_profile(parsed(spark, d), (*PARSED, "DISTANCE")))


@query("dataset_compare", sql("""
    SELECT 'flights' AS dataset, a AS total_rows, b AS distinct_rows, a > b AS has_duplicates, 4 AS column_count
    FROM (SELECT count(*) AS a FROM flights),
      (SELECT count(*) AS b FROM (SELECT DISTINCT TAIL_NUM, ORIGIN, DEST, FL_DATE FROM flights))
    UNION ALL
    SELECT 'routes', a, b, a > b, 5 FROM (SELECT count(*) AS a FROM routes),
      (SELECT count(*) AS b FROM (SELECT DISTINCT "YEAR", "QUARTER", ORIGIN, DEST, DEP_DEL15 FROM routes))
    UNION ALL
    SELECT 'orders', a, b, a > b, 3 FROM (SELECT count(*) AS a FROM order_flights),
      (SELECT count(*) AS b FROM (SELECT DISTINCT * FROM order_flights))""", "flights", "routes", "order_flights"))
def _(spark, d):
    return profile.compare_datasets({
        "flights": inputs.flights(spark, d).select("TAIL_NUM", "ORIGIN", "DEST", "FL_DATE"),
        "routes": inputs.routes(spark, d).select("YEAR", "QUARTER", "ORIGIN", "DEST", "DEP_DEL15"),
        "orders": inputs.order_flights(spark, d),
    })


@query("association_share", sql("""
    SELECT flag, delayed_with_flag, delayed, round(100e0 * delayed_with_flag / delayed, 6) AS share_pct
    FROM (SELECT 'historic_delay' AS flag, count(*) FILTER (HIST_DEP_DELAY >= 15) AS delayed_with_flag,
        count(*) AS delayed FROM history_strict WHERE DEP_DEL15 = 1
      UNION ALL SELECT 'specWeather', count(*) FILTER (AW1 <> '' OR AW2 <> '' OR MW1 <> ''), count(*)
      FROM weather WHERE DEP_DEL15 = 1)""", "history_strict", "weather"))
def _(spark, d):
    spec = weather.binarise(weather.present_count(inputs.weather_flights(spark, d)))
    past = history.pick_history(history.lag_features(history.add_utc_times(spec, inputs.utc_lookup(spark, d))))
    flagged = past.withColumn("historic_delay", F.when(F.col("HIST_DEP_DELAY") >= 15, 1).otherwise(0))
    return rounded(breakdown.association_share(flagged, ["historic_delay", "specWeather"]))


@query("holiday_association", sql("""
    SELECT 'isHoliday' AS flag, sum(isHoliday)::bigint AS delayed_with_flag, count(*) AS delayed,
      round(100e0 * sum(isHoliday) / count(*), 6) AS share_pct
    FROM holiday_flagged WHERE DEP_DEL15 = 1""", "holiday_flagged"))
def _(spark, d):
    from aerolag.plans.queries_features import holiday_flagged

    return rounded(breakdown.association_share(holiday_flagged(spark, d), ["isHoliday"]))


@query("filter_forms", sql("""
    SELECT count(*) FILTER (DEP_DEL15 = 1 AND CANCELLED = 0) AS both_equal,
      count(*) FILTER (DEP_DELAY IS NULL) AS missing, count(*) FILTER (DEP_DELAY IS NOT NULL) AS present,
      count(*) FILTER (NOT starts_with(FL_DATE, '2024-01-1')) AS other_prefix,
      count(*) FILTER (DEP_TS BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20') AS between_times,
      count(*) FILTER (ORIGIN IN ('A01', 'A02', 'A03')) AS listed,
      count(*) FILTER (DEP_DEL15 <> 1) AS not_equal, count(*) FILTER (OP_UNIQUE_CARRIER = 'C1') AS equal_literal,
      count(*) FILTER (DISTANCE >= 500 AND DISTANCE <= 900) AS in_range,
      count(*) FILTER (wind_direction IS NOT NULL AND wind_speed IS NOT NULL) AS complete,
      count(*) FILTER (AW1 IS NULL OR AW1 = '') AS absent
    FROM parsed""", "parsed"))
def _(spark, d):
    c = F.col
    forms = {
        "both_equal": (c("DEP_DEL15") == 1) & (c("CANCELLED") == 0),
        "missing": c("DEP_DELAY").isNull(),
        "present": F.expr("DEP_DELAY is not null"),
        "other_prefix": ~c("FL_DATE").startswith("2024-01-1"),
        "between_times": c("DEP_TS").between(
            F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")),
        "listed": c("ORIGIN").isin("A01", "A02", "A03"),
        "not_equal": c("DEP_DEL15") != 1,
        "equal_literal": c("OP_UNIQUE_CARRIER") == "C1",
        "in_range": (c("DISTANCE") >= 500) & (c("DISTANCE") <= 900),
        "complete": c("wind_direction").isNotNull() & c("wind_speed").isNotNull(),
        "absent": c("AW1").isNull() | (c("AW1") == ""),
    }
    return parsed(spark, d).agg(*[F.count_if(f).alias(name) for name, f in forms.items()])


@query("label_map", sql(f"""
    SELECT DAY_OF_WEEK, {_case("DAY_OF_WEEK", WEEKDAYS)} AS day_name, DEP_TIME_BLK,
      cast(substr(DEP_TIME_BLK, 1, 2) AS integer) AS block_hour, count(*) AS n
    FROM flights GROUP BY ALL""", "flights"))
def _(spark, d):
    named = breakdown.named(inputs.flights(spark, d), "DAY_OF_WEEK", WEEKDAYS, "day_name")
    hour = F.substring("DEP_TIME_BLK", 1, 2).cast("int").alias("block_hour")
    return named.groupBy("DAY_OF_WEEK", "day_name", "DEP_TIME_BLK", hour).agg(F.count("*").alias("n"))


def ranks(spark: SparkSession, d: str) -> DataFrame:
    """Centrality per season of the route table, settled."""
    return graph.pagerank(graph.season_edges(inputs.routes(spark, d)), tol=1e-9)


@query("mixed_sort", sql("""
    SELECT YEAR_NEW, QUARTER_NEW, id, round(pagerank, 6) AS pagerank FROM shifted_ranks
    ORDER BY YEAR_NEW, QUARTER_NEW, pagerank DESC, id""", "shifted_ranks"))
def _(spark, d):
    shifted = rounded(enrich.shift_season(ranks(spark, d)).drop("steps"))
    return shifted.orderBy("YEAR_NEW", "QUARTER_NEW", F.desc("pagerank"), "id").select(
        "YEAR_NEW", "QUARTER_NEW", "id", "pagerank")


@query("missing_audit", sql("""
    SELECT wind_direction IS NULL AS no_direction, wind_speed IS NULL AS no_speed,
      temperature IS NULL AS no_temperature, count(*) AS n
    FROM parsed WHERE wind_direction IS NULL OR wind_speed IS NULL OR temperature IS NULL GROUP BY ALL""", "parsed"))
def _(spark, d):
    missing = profile.missing_rows(parsed(spark, d), ["wind_direction", "wind_speed", "temperature"])
    return missing.groupBy(
        F.col("wind_direction").isNull().alias("no_direction"), F.col("wind_speed").isNull().alias("no_speed"),
        F.col("temperature").isNull().alias("no_temperature"),
    ).agg(F.count("*").alias("n"))


@query("season_shift", sql("""
    SELECT "YEAR", "QUARTER", "MONTH", cast(CASE WHEN "QUARTER" < 4 THEN "YEAR" ELSE "YEAR" + 1 END AS integer) AS YEAR_NEW,
      cast(CASE WHEN "QUARTER" < 4 THEN "QUARTER" + 1 ELSE "QUARTER" - 3 END AS integer) AS QUARTER_NEW,
      cast(CASE WHEN "MONTH" < 12 THEN "YEAR" ELSE "YEAR" + 1 END AS integer) AS MONTH_YEAR_NEW,
      cast(CASE WHEN "MONTH" < 12 THEN "MONTH" + 1 ELSE "MONTH" - 11 END AS integer) AS MONTH_NEW, count(*) AS n
    FROM routes GROUP BY ALL""", "routes"))
def _(spark, d):
    seasons = inputs.routes(spark, d).groupBy("YEAR", "QUARTER", "MONTH").agg(F.count("*").alias("n"))
    by_quarter = next_season(F.col("YEAR"), F.col("QUARTER"), 4)
    by_month = next_season(F.col("YEAR"), F.col("MONTH"), 12)
    return seasons.withColumns({
        "YEAR_NEW": by_quarter[0], "QUARTER_NEW": by_quarter[1],
        "MONTH_YEAR_NEW": by_month[0], "MONTH_NEW": by_month[1],
    })


@query("vertex_union", sql('SELECT "YEAR", "QUARTER", id FROM vertices', "vertices"))
def _(spark, d):
    return graph.season_vertices(graph.season_edges(inputs.routes(spark, d)))
