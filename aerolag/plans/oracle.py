"""The same results in plain SQL, written apart from the Spark code."""

from __future__ import annotations

# Steps after which ranks are settled far below what the comparison sees.
_SETTLED = 48
# From here on flights are held out.
HELD_OUT_FROM = "2024-01-24"
# Named subqueries; each entry lists what it builds on.
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "flights": ((), """
        SELECT event_id AS FLIGHT_ID, 'N' || user_id AS TAIL_NUM, ts AS DEP_TS,
          cast(cast(ts AS date) AS varchar) AS FL_DATE,
          cast(extract(hour FROM ts) * 100 + extract(minute FROM ts) AS integer) AS CRS_DEP_TIME,
          cast(extract(year FROM ts) AS integer) AS "YEAR", cast(extract(quarter FROM ts) AS integer) AS "QUARTER",
          cast(extract(month FROM ts) AS integer) AS "MONTH", cast(extract(day FROM ts) AS integer) AS DAY_OF_MONTH,
          cast(extract(isodow FROM ts) AS integer) AS DAY_OF_WEEK,
          strftime(ts, '%H') || '00-' || strftime(ts, '%H') || '59' AS DEP_TIME_BLK,
          strftime(ts + INTERVAL 2 HOUR, '%H') || '00-' || strftime(ts + INTERVAL 2 HOUR, '%H') || '59' AS ARR_TIME_BLK,
          'C' || (event_id % 12) AS OP_UNIQUE_CARRIER,
          'A' || lpad(cast(user_id % 25 AS varchar), 2, '0') AS ORIGIN,
          'A' || lpad(cast((event_id * 7 + 3) % 25 AS varchar), 2, '0') AS DEST,
          cast(user_id % 25 AS integer) AS ORIGIN_AIRPORT_ID,
          CASE WHEN event_id % 53 <> 0 THEN cast(floor("value") AS double) - 5 END AS DEP_DELAY,
          CASE WHEN event_id % 53 <> 0 THEN cast(floor("value") AS double) - 8 END AS ARR_DELAY,
          cast(30 + event_id % 300 AS double) AS ACTUAL_ELAPSED_TIME,
          cast(25 + event_id % 310 AS double) AS CRS_ELAPSED_TIME,
          cast(100 + (event_id * 31) % 2500 AS double) AS DISTANCE,
          CASE WHEN event_id % 53 <> 0 THEN CASE WHEN floor("value") - 5 >= 15 THEN 1e0 ELSE 0e0 END END AS DEP_DEL15,
          CASE WHEN event_id % 53 = 0 THEN 1e0 ELSE 0e0 END AS CANCELLED,
          "value"
        FROM events"""),
    "weather": (("flights",), """
        SELECT *,
          CASE WHEN FLIGHT_ID % 17 = 0 THEN '999,9,V,9999,9' WHEN FLIGHT_ID % 41 = 0 THEN ''
            WHEN FLIGHT_ID % 43 = 0 THEN NULL WHEN FLIGHT_ID % 47 = 0 THEN '120,1'
            ELSE lpad(cast(FLIGHT_ID * 10 % 360 AS varchar), 3, '0') || ',1,N,'
              || lpad(cast(FLIGHT_ID % 200 AS varchar), 4, '0') || ',1' END AS WND,
          CASE WHEN FLIGHT_ID % 19 = 0 THEN '99999,9,9,N'
            ELSE lpad(cast(FLIGHT_ID * 37 % 25000 AS varchar), 5, '0') || ',5,M,N' END AS CIG,
          CASE WHEN FLIGHT_ID % 23 = 0 THEN '999999,9,N,9'
            ELSE lpad(cast(FLIGHT_ID * 13 % 16093 AS varchar), 6, '0') || ',5,N,1' END AS VIS,
          CASE WHEN FLIGHT_ID % 29 = 0 THEN '+9999,9' ELSE (CASE WHEN FLIGHT_ID % 5 = 0 THEN '-' ELSE '+' END)
            || lpad(cast(FLIGHT_ID % 400 AS varchar), 4, '0') || ',1' END AS TMP,
          CASE WHEN FLIGHT_ID % 31 = 0 THEN '+9999,9' ELSE (CASE WHEN FLIGHT_ID % 6 = 0 THEN '-' ELSE '+' END)
            || lpad(cast(FLIGHT_ID % 250 AS varchar), 4, '0') || ',1' END AS DEW,
          CASE WHEN FLIGHT_ID % 13 = 0 THEN '99999,9'
            ELSE lpad(cast(9800 + FLIGHT_ID % 600 AS varchar), 5, '0') || ',1' END AS SLP,
          CASE WHEN FLIGHT_ID % 7 = 0 THEN 'RA' WHEN FLIGHT_ID % 11 = 0 THEN '' END AS AW1,
          CASE WHEN FLIGHT_ID % 14 = 0 THEN 'TS' END AS AW2,
          CASE WHEN FLIGHT_ID % 9 = 0 THEN 'FG' END AS MW1
        FROM flights"""),
    "parsed": (("weather",), """
        SELECT *,
          CASE WHEN string_split(WND, ',')[1] <> '999' THEN try_cast(string_split(WND, ',')[1] AS double) END AS wind_direction,
          CASE WHEN string_split(WND, ',')[4] <> '9999' THEN try_cast(string_split(WND, ',')[4] AS double) / 10 END AS wind_speed,
          try_cast(string_split(WND, ',')[5] AS double) AS wind_speed_quality,
          CASE WHEN string_split(CIG, ',')[1] <> '99999' THEN try_cast(string_split(CIG, ',')[1] AS double) END AS ceiling_height,
          CASE WHEN string_split(VIS, ',')[1] <> '999999' THEN try_cast(string_split(VIS, ',')[1] AS double) / 1000 END AS visibility,
          CASE WHEN string_split(TMP, ',')[1] <> '+9999' THEN try_cast(string_split(TMP, ',')[1] AS double) / 10 END AS temperature,
          CASE WHEN string_split(SLP, ',')[1] <> '99999' THEN try_cast(string_split(SLP, ',')[1] AS double) / 10 END AS sea_level_pressure,
          CASE WHEN string_split(DEW, ',')[1] <> '+9999' THEN try_cast(string_split(DEW, ',')[1] AS double) / 10 END AS dew_point
        FROM weather"""),
    "parsed_reference": (("weather",), """
        SELECT *,
          CASE WHEN string_split(WND, ',')[1] <> '999' THEN try_cast(string_split(WND, ',')[1] AS double) END AS wind_direction,
          CASE WHEN string_split(WND, ',')[4] <> '999' THEN try_cast(string_split(WND, ',')[4] AS double) / 10 END AS wind_speed,
          CASE WHEN string_split(WND, ',')[5] <> '999' THEN try_cast(string_split(WND, ',')[5] AS double) END AS gust_speed,
          CASE WHEN string_split(CIG, ',')[1] <> '99999' THEN try_cast(string_split(CIG, ',')[1] AS double) END AS ceiling_height,
          CASE WHEN string_split(VIS, ',')[1] <> '99999' THEN try_cast(string_split(VIS, ',')[1] AS double) / 1000 END AS visibility,
          CASE WHEN string_split(TMP, ',')[1] <> '999' THEN try_cast(string_split(TMP, ',')[1] AS double) / 10 END AS temperature,
          CASE WHEN string_split(SLP, ',')[1] <> '99999' THEN try_cast(string_split(SLP, ',')[1] AS double) / 10 END AS sea_level_pressure,
          CASE WHEN string_split(DEW, ',')[1] <> '999' THEN try_cast(string_split(DEW, ',')[1] AS double) / 10 END AS dew_point
        FROM weather"""),
    "routes": ((), """
        SELECT cast(extract(year FROM l_shipdate) AS integer) AS "YEAR",
          cast(extract(quarter FROM l_shipdate) AS integer) AS "QUARTER",
          cast(extract(month FROM l_shipdate) AS integer) AS "MONTH",
          cast(cast(l_shipdate AS date) AS varchar) AS FL_DATE,
          'A' || lpad(cast(s_nationkey AS varchar), 2, '0') AS ORIGIN,
          'A' || lpad(cast(c_nationkey AS varchar), 2, '0') AS DEST,
          l_extendedprice AS DISTANCE, l_quantity AS CRS_ELAPSED_TIME,
          CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END AS DEP_DEL15
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
          JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""),
    "holidays": ((), """
        SELECT DISTINCT o_orderdate AS "date",
          CASE WHEN r_name = 'AMERICA' THEN 'United States' ELSE r_name END AS countryOrRegion,
          CASE WHEN strftime(o_orderdate, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25') THEN true
            WHEN strftime(o_orderdate, '%m-%d') IN ('02-14', '10-31') THEN false END AS isPaidTimeOff
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey
        WHERE strftime(o_orderdate, '%m-%d') IN ('01-01', '02-14', '03-17', '07-04', '10-31', '11-11', '12-25')"""),
    "holiday_dates": (("holidays",), """
        SELECT DISTINCT cast("date" AS date) AS d FROM holidays
        WHERE countryOrRegion = 'United States' AND isPaidTimeOff
          AND cast("date" AS date) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""),
    "order_flights": ((), """
        SELECT o_orderkey AS FLIGHT_ID, cast(cast(o_orderdate AS date) AS varchar) AS FL_DATE,
          CASE o_orderstatus WHEN 'F' THEN 1e0 WHEN 'O' THEN 0e0 END AS DEP_DEL15
        FROM orders"""),
    "holiday_flagged": (("order_flights", "holiday_dates"), """
        SELECT *, CASE WHEN EXISTS (SELECT 1 FROM holiday_dates
            WHERE abs(datediff('day', d, cast(FL_DATE AS date))) <= 3) THEN 1 ELSE 0 END AS isHoliday
        FROM order_flights"""),
    "utc_lookup": ((), """
        SELECT n_nationkey AS ORIGIN_AIRPORT_ID,
          CASE WHEN n_nationkey % 8 = 0 THEN 5.5e0 ELSE cast(5 + n_nationkey % 4 AS double) END AS UTC_offset_hours
        FROM nation"""),
    "utc_base": (("flights", "utc_lookup"), """
        SELECT f.*, cast(FL_DATE AS timestamp) + to_minutes(cast(CRS_DEP_TIME // 100 * 60 + CRS_DEP_TIME % 100 AS bigint))
          + to_minutes(cast(UTC_offset_hours * 60 AS bigint)) AS CRS_DEP_DATETIME_UTC
        FROM flights f LEFT JOIN utc_lookup u USING (ORIGIN_AIRPORT_ID)"""),
    "utc": (("utc_base",), """
        SELECT *, CRS_DEP_DATETIME_UTC + to_minutes(cast(DEP_DELAY + ACTUAL_ELAPSED_TIME AS bigint)) AS ARR_DATETIME_UTC,
          CRS_DEP_DATETIME_UTC + to_minutes(cast(DEP_DELAY AS bigint)) AS DEP_DATETIME_UTC
        FROM utc_base"""),
    "lagged": (("utc",), "SELECT *, " + ", ".join(
        f"lag({c}, {i}) OVER w AS PREV_{c}_{i}"
        for c in ("ARR_DATETIME_UTC", "ARR_DELAY", "DEP_DATETIME_UTC", "DEP_DELAY") for i in (1, 2, 3)
    ) + " FROM utc WINDOW w AS (PARTITION BY TAIL_NUM ORDER BY CRS_DEP_DATETIME_UTC NULLS FIRST, FLIGHT_ID)"),
    "gaps": (("lagged",), "SELECT *, " + ", ".join(
        f"datesub('minute', PREV_{s}_DATETIME_UTC_{i}, CRS_DEP_DATETIME_UTC) AS gap_{s}_{i}"
        for s in ("ARR", "DEP") for i in (1, 2, 3)
    ) + " FROM lagged"),
    "history_strict": (("gaps",), "SELECT *, " + ", ".join(
        f"CASE WHEN gap_{s}_1 >= 120 THEN PREV_{s}_DELAY_1 WHEN gap_{s}_2 >= 120 THEN PREV_{s}_DELAY_2 "
        f"WHEN gap_{s}_3 >= 120 THEN PREV_{s}_DELAY_3 END AS HIST_{s}_DELAY, "
        f"CASE WHEN gap_{s}_1 >= 120 THEN 1 WHEN gap_{s}_2 >= 120 THEN 2 WHEN gap_{s}_3 >= 120 THEN 3 END AS HIST_{s}_FLT_NUM"
        for s in ("ARR", "DEP")
    ) + " FROM gaps"),
    "history_reference": (("gaps",), "SELECT *, " + ", ".join(
        f"CASE WHEN gap_{s}_1 >= 120 THEN PREV_{s}_DELAY_1 WHEN gap_{s}_1 < 120 AND gap_{s}_2 >= 120 "
        f"THEN PREV_{s}_DELAY_2 ELSE PREV_{s}_DELAY_3 END AS HIST_{s}_DELAY, "
        f"CASE WHEN gap_{s}_1 >= 120 THEN 1 WHEN gap_{s}_1 < 120 AND gap_{s}_2 >= 120 THEN 2 ELSE 3 END AS HIST_{s}_FLT_NUM"
        for s in ("ARR", "DEP")
    ) + " FROM gaps"),
    "airports": ((), """
        SELECT 'A' || lpad(cast(n_nationkey AS varchar), 2, '0') AS airport,
          cast((n_nationkey * 37) % 160 - 80 + 0.5e0 AS double) AS lat,
          cast((n_nationkey * 71) % 340 - 170 + 0.25e0 AS double) AS lon
        FROM nation"""),
    "sites": ((), """
        SELECT c_custkey AS airport, cast((c_custkey * 7919) % 16000 AS double) / 100 - 80 AS lat,
          cast((c_custkey * 10007) % 35900 AS double) / 100 - 179.5e0 AS lon
        FROM customer"""),
    "stations": ((), """
        SELECT s_suppkey AS station, cast((s_suppkey * 53) % 170 AS double) - 85 + 0.1e0 AS lat,
          cast((s_suppkey * 97) % 350 AS double) - 175 + 0.7e0 AS lon
        FROM supplier"""),
    **{name: ((), f"""
        SELECT {key} AS {out}, 10.005e0 + cast(({key} * 7919) % 10007 AS double) * 3e-6 AS lat,
          20.005e0 + cast(({key} * 104729) % 10009 AS double) * 3e-6 AS lon
        FROM {base}""") for name, key, out, base in (
            ("crowded_sites", "o_orderkey", "airport", "orders"), ("crowded_stations", "p_partkey", "station", "part"))},
    # Clock changes of the United States from 1987 to 2006: first Sunday of April and last of October, at two.
    "clock_changes": ((), """
        SELECT y, make_date(y, 4, 1) + cast((7 - dayofweek(make_date(y, 4, 1))) % 7 AS integer) AS spring,
          make_date(y, 10, 31) - cast(dayofweek(make_date(y, 10, 31)) AS integer) AS autumn
        FROM (SELECT unnest(range(1987, 2007)) AS y)"""),
    "dated_flights": ((), """
        SELECT l_orderkey * 10 + l_linenumber AS FLIGHT_ID, cast(l_suppkey % 25 AS integer) AS airport,
          l_quantity AS DEP_DELAY, cast(cast(l_shipdate AS date) AS timestamp)
            + to_minutes(cast((l_orderkey * 37 + l_linenumber * 11) % 1440 AS bigint)) AS clock
        FROM lineitem"""),
    "zoned": (("dated_flights", "clock_changes"), """
        SELECT *, CASE WHEN airport = 24 THEN NULL ELSE [5, 6, 7, -5.5, 8][airport % 5 + 1] END AS hours,
          airport % 5 NOT IN (2, 3) AND airport <> 24 AS changes,
          clock >= cast(spring AS timestamp) + INTERVAL 2 HOUR AND clock < cast(spring AS timestamp) + INTERVAL 3 HOUR AS skipped,
          clock >= cast(autumn AS timestamp) + INTERVAL 1 HOUR AND clock < cast(autumn AS timestamp) + INTERVAL 2 HOUR AS repeated,
          clock >= cast(spring AS timestamp) + INTERVAL 3 HOUR AND clock < cast(autumn AS timestamp) + INTERVAL 2 HOUR AS summer
        FROM dated_flights JOIN clock_changes ON y = extract(year FROM clock)"""),
    "observations": (("weather",), """
        SELECT FLIGHT_ID AS obs_id, FLIGHT_ID % 5 AS station, DEP_TS AS obs_ts,
          CASE WHEN FLIGHT_ID % 10 = 3 THEN 'FM-12' WHEN FLIGHT_ID % 2 = 0 THEN 'FM-15' ELSE 'SOA' END AS REPORT_TYPE,
          WND, CIG, VIS, TMP, DEW, SLP
        FROM weather"""),
    "kept_observations": (("observations",), """
        SELECT *, date_trunc('hour', obs_ts) AS obs_hour FROM observations WHERE REPORT_TYPE IN ('FM-15', 'SOA')
        QUALIFY row_number() OVER (PARTITION BY station, date_trunc('hour', obs_ts)
          ORDER BY obs_ts DESC, obs_id DESC) = 1"""),
    "edges": (("routes",), """
        SELECT "YEAR", "QUARTER", ORIGIN AS src, DEST AS dst, count(*) AS flights FROM routes GROUP BY ALL"""),
    "links": (("edges",), """
        SELECT "YEAR", "QUARTER", src, dst,
          flights / cast(sum(flights) OVER (PARTITION BY "YEAR", "QUARTER", src) AS double) AS p FROM edges"""),
    "vertices": (("edges",), """
        SELECT "YEAR", "QUARTER", src AS id FROM edges UNION SELECT "YEAR", "QUARTER", dst FROM edges"""),
    "r0": (("vertices",), """SELECT *, 1e0 AS rank FROM vertices"""),
    **{f"r{i}": ((f"r{i - 1}", "links"), f"""
        SELECT v."YEAR", v."QUARTER", v.id, 0.15e0 + 0.85e0 * coalesce(sum(r.rank * l.p), 0) AS rank
        FROM vertices v
          LEFT JOIN links l ON l."YEAR" = v."YEAR" AND l."QUARTER" = v."QUARTER" AND l.dst = v.id
          LEFT JOIN r{i - 1} r ON r."YEAR" = l."YEAR" AND r."QUARTER" = l."QUARTER" AND r.id = l.src
        GROUP BY ALL""") for i in range(1, _SETTLED + 1)},
    **{name: ((last,), f"""
        SELECT "YEAR", "QUARTER", id,
          rank * count(*) OVER (PARTITION BY "YEAR", "QUARTER") / sum(rank) OVER (PARTITION BY "YEAR", "QUARTER") AS pagerank
        FROM {last}""") for name, last in (("ranks", f"r{_SETTLED}"), ("ranks_fixed", "r5"))},
    "shifted_ranks": (("ranks",), """
        SELECT id, pagerank, cast(CASE WHEN "QUARTER" < 4 THEN "YEAR" ELSE "YEAR" + 1 END AS integer) AS YEAR_NEW,
          cast(CASE WHEN "QUARTER" < 4 THEN "QUARTER" + 1 ELSE 1 END AS integer) AS QUARTER_NEW
        FROM ranks"""),
    "day_edges": (("flights",), """
        SELECT "YEAR", DAY_OF_MONTH AS d, ORIGIN AS src, DEST AS dst, count(*) AS flights FROM flights GROUP BY ALL"""),
    "day_links": (("day_edges",), """
        SELECT "YEAR", d, src, dst, flights / cast(sum(flights) OVER (PARTITION BY "YEAR", d, src) AS double) AS p
        FROM day_edges"""),
    "day_vertices": (("day_edges",), """
        SELECT "YEAR", d, src AS id FROM day_edges UNION SELECT "YEAR", d, dst FROM day_edges"""),
    "d0": (("day_vertices",), """SELECT *, 1e0 AS rank FROM day_vertices"""),
    **{f"d{i}": ((f"d{i - 1}", "day_links"), f"""
        SELECT v."YEAR", v.d, v.id, 0.15e0 + 0.85e0 * coalesce(sum(r.rank * l.p), 0) AS rank
        FROM day_vertices v
          LEFT JOIN day_links l ON l."YEAR" = v."YEAR" AND l.d = v.d AND l.dst = v.id
          LEFT JOIN d{i - 1} r ON r."YEAR" = l."YEAR" AND r.d = l.d AND r.id = l.src
        GROUP BY ALL""") for i in range(1, _SETTLED + 1)},
    "day_ranks": ((f"d{_SETTLED}",), f"""
        SELECT CASE WHEN d < 31 THEN "YEAR" ELSE "YEAR" + 1 END AS year_new,
          CASE WHEN d < 31 THEN d + 1 ELSE d - 30 END AS d_new, id,
          rank * count(*) OVER (PARTITION BY "YEAR", d) / sum(rank) OVER (PARTITION BY "YEAR", d) AS pagerank
        FROM d{_SETTLED}"""),
    "features": (("parsed", "history_strict", "flight_volume", "day_ranks"), """
        SELECT p.*, h.HIST_ARR_DELAY, h.HIST_ARR_FLT_NUM, h.HIST_DEP_DELAY, h.HIST_DEP_FLT_NUM,
          o.avg_yr_flights AS origin_yr_flights, t.avg_yr_flights AS dest_yr_flights, k.pagerank,
          CASE WHEN ceiling_height < 10000 THEN 1 ELSE 0 END AS ceiling_height_is_below_10000,
          CASE WHEN ceiling_height >= 10000 AND ceiling_height < 20000 THEN 1 ELSE 0 END AS ceiling_height_is_between_10000_20000,
          CASE WHEN ceiling_height >= 20000 THEN 1 ELSE 0 END AS ceiling_height_is_above_20000,
          CASE WHEN AW1 <> '' THEN 1 ELSE 0 END + CASE WHEN AW2 <> '' THEN 1 ELSE 0 END
            + CASE WHEN MW1 <> '' THEN 1 ELSE 0 END AS specWeather,
          CASE WHEN EXISTS (SELECT 1 FROM (SELECT DISTINCT cast(ts AS date) AS d FROM events
              WHERE strftime(ts, '%m-%d') IN ('01-01', '01-15'))
            WHERE abs(datediff('day', d, cast(p.FL_DATE AS date))) <= 3) THEN 1 ELSE 0 END AS isHoliday
        FROM parsed p JOIN history_strict h USING (FLIGHT_ID)
          LEFT JOIN flight_volume o ON p.ORIGIN = o.airport LEFT JOIN flight_volume t ON p.DEST = t.airport
          LEFT JOIN day_ranks k ON p."YEAR" = k.year_new AND p.DAY_OF_MONTH = k.d_new AND p.ORIGIN = k.id"""),
    "volume": (("routes",), """
        SELECT ORIGIN AS airport,
          count(*) / (SELECT cast(count(DISTINCT "YEAR") AS double) FROM routes WHERE "YEAR" <> 2001) AS avg_yr_flights
        FROM routes WHERE "YEAR" <> 2001 GROUP BY ORIGIN"""),
    "flight_volume": (("flights",), f"""
        SELECT ORIGIN AS airport,
          count(*) / (SELECT cast(count(DISTINCT "YEAR") AS double) FROM flights
            WHERE DEP_TS < TIMESTAMP '{HELD_OUT_FROM}') AS avg_yr_flights
        FROM flights WHERE DEP_TS < TIMESTAMP '{HELD_OUT_FROM}' GROUP BY ORIGIN"""),
    "ordered": (("flights",), """
        SELECT *, row_number() OVER (ORDER BY DEP_TS, FLIGHT_ID) - 1 AS pos, count(*) OVER () AS n FROM flights"""),
    "fold_ranges": (("ordered",), """
        SELECT i, n, floor(i * len * 0.9e0 + 1e-9) AS lo,
          CASE WHEN i = 7 THEN n ELSE floor(i * len * 0.9e0 + 1e-9) + len END AS hi
        FROM (SELECT i, n, floor(n / (8 - 7 * 0.1e0)) AS len
              FROM (SELECT DISTINCT n FROM ordered), (SELECT unnest(range(0, 8)) AS i))"""),
    "folds": (("fold_ranges",), """
        SELECT o.* EXCLUDE (pos, n), cast(i AS integer) AS foldCol,
          CASE WHEN pos < lo + floor((hi - lo) * 0.8e0 + 1e-9) THEN 'train' ELSE 'val' END AS split
        FROM ordered o JOIN fold_ranges f ON o.pos >= f.lo AND o.pos < f.hi"""),
    "predictions": (("flights",), """
        SELECT FLIGHT_ID, DEP_TS, DEP_DEL15,
          CASE WHEN substr(md5(cast(FLIGHT_ID AS varchar)), 1, 1) < '8' THEN 1e0 ELSE 0e0 END AS prediction,
          least("value" / 100, 1e0) AS p1
        FROM flights"""),
    "fold_predictions": (("folds", "predictions"), """
        SELECT p.*, f.foldCol, f.split FROM folds f JOIN predictions p USING (FLIGHT_ID)"""),
    "fold_confusion": (("fold_predictions",), """
        SELECT foldCol, split, count(*) FILTER (DEP_DEL15 = 1 AND prediction = 1) AS tp,
          count(*) FILTER (DEP_DEL15 = 0 AND prediction = 1) AS fp,
          count(*) FILTER (DEP_DEL15 = 1 AND prediction = 0) AS fn,
          count(*) FILTER (DEP_DEL15 = 0 AND prediction = 0) AS tn
        FROM fold_predictions GROUP BY ALL"""),
    "confusion": (("predictions",), """
        SELECT count(*) FILTER (DEP_DEL15 = 1 AND prediction = 1) AS tp,
          count(*) FILTER (DEP_DEL15 = 0 AND prediction = 1) AS fp,
          count(*) FILTER (DEP_DEL15 = 1 AND prediction = 0) AS fn,
          count(*) FILTER (DEP_DEL15 = 0 AND prediction = 0) AS tn
        FROM predictions"""),
}


def _needed(name: str, seen: list[str]) -> None:
    for base in _VIEWS[name][0]:
        _needed(base, seen)
    if name not in seen:
        seen.append(name)


def sql(body: str, *views: str) -> str:
    """A statement over the named subqueries and all they build on."""
    seen: list[str] = []
    for view in views:
        _needed(view, seen)
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name][1]})" for name in seen)
    return f"WITH {ctes}\n{body}" if ctes else body


def metrics_sql(prefix: str = "") -> str:
    """Metric columns over tp, fp, fn, tn; ``prefix`` goes before each."""
    p = "CASE WHEN tp + fp > 0 THEN tp / cast(tp + fp AS double) ELSE 0e0 END"
    r = "CASE WHEN tp + fn > 0 THEN tp / cast(tp + fn AS double) ELSE 0e0 END"
    return f"""
        round({p}, 6) AS {prefix}precision, round({r}, 6) AS {prefix}recall,
        round(CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / cast(tp + fp + fn + tn AS double) ELSE 0e0 END, 6) AS {prefix}accuracy,
        round(({p} + {r}) / 2, 6) AS {prefix}mean_pr,
        round(CASE WHEN tp > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0e0 END, 6) AS {prefix}f1,
        round(CASE WHEN tp > 0 THEN 1.25e0 * tp / (1.25e0 * tp + fp + 0.25e0 * fn) ELSE 0e0 END, 6) AS {prefix}fbeta"""
