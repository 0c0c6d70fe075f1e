"""Queries: balance, trimming, folds, encoding and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.operators import enrich, folds, metrics, outliers, sampling, weather
from aerolag.plans import inputs
from aerolag.plans.oracle import metrics_sql, sql
from aerolag.plans.registry import query, rounded
from aerolag.sources.stage import stage_table

TRIMMED = ("DEP_DELAY", "DISTANCE", "ACTUAL_ELAPSED_TIME")


@query("hash_undersample", sql("""
    SELECT FLIGHT_ID, DEP_DEL15 FROM flights,
      (SELECT count(*) FILTER (DEP_DEL15 = 0) AS n0, count(*) FILTER (DEP_DEL15 = 1) AS n1 FROM flights)
    WHERE DEP_DEL15 IS NOT NULL AND (DEP_DEL15 <> CASE WHEN n1 > n0 THEN 1 ELSE 0 END
      OR substr(md5(cast(FLIGHT_ID AS varchar)), 1, 8)
        < format('{:08x}', cast(floor(least(n0, n1) / cast(greatest(n0, n1) AS double) * 4294967296) AS bigint)))""", "flights"))
def _(spark, d):
    return sampling.undersample(inputs.flights(spark, d)).select("FLIGHT_ID", "DEP_DEL15")


@query("random_undersample")
def _(spark, d):
    return sampling.undersample(inputs.flights(spark, d), method="bernoulli").groupBy("DEP_DEL15").agg(F.count("*").alias("n"))


def _trim_sql(sequential: bool) -> str:
    steps, source = [], "flights"
    for i, c in enumerate(TRIMMED):
        bounds = source if sequential else "flights"
        steps.append(f"""t{i} AS (SELECT s.* FROM {source} s,
          (SELECT quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3 FROM {bounds})
          WHERE {c} >= q1 - 1.5e0 * (q3 - q1) AND {c} <= q3 + 1.5e0 * (q3 - q1))""")
        source = f"t{i}"
    head = sql("", "flights")
    return f"{head}, {', '.join(steps)} SELECT FLIGHT_ID, {', '.join(TRIMMED)} FROM {source}"


@query("iqr_trim_sequential", _trim_sql(True))
def _(spark, d):
    return outliers.iqr_trim(inputs.flights(spark, d), TRIMMED).select("FLIGHT_ID", *TRIMMED)


@query("iqr_trim_onepass", _trim_sql(False))
def _(spark, d):
    return outliers.iqr_trim(inputs.flights(spark, d), TRIMMED, mode="onepass").select("FLIGHT_ID", *TRIMMED)


@query("dedup", sql("SELECT DISTINCT ORIGIN, DEST, FL_DATE, DEP_DEL15 FROM flights", "flights"))
def _(spark, d):
    return sampling.drop_copies(inputs.flights(spark, d).select("ORIGIN", "DEST", "FL_DATE", "DEP_DEL15"))


def folded(spark: SparkSession, d: str) -> DataFrame:
    return folds.assign_folds(inputs.flights(spark, d))


@query("assign_folds", sql("SELECT FLIGHT_ID, foldCol, split FROM folds", "folds"))
def _(spark, d):
    return folded(spark, d).select("FLIGHT_ID", "foldCol", "split")


@query("fold_counts", sql("""
    SELECT foldCol, split, count(*) AS n, foldCol || '_' || split AS fold_split FROM folds GROUP BY ALL""", "folds"))
def _(spark, d):
    return sampling.fold_counts(folded(spark, d))


@query("fold_read", sql("""
    SELECT FLIGHT_ID, split FROM folds WHERE foldCol = 3""", "folds"))
def _(spark, d):
    train, val = sampling.fold(folded(spark, d), 3)
    return train.unionByName(val).select("FLIGHT_ID", "split")


_KNOWN = """
    known AS (SELECT foldCol, ORIGIN AS airport, count(*) / cast(any_value(years) AS double) AS volume
      FROM flights JOIN (SELECT foldCol, s, (SELECT count(DISTINCT "YEAR") FROM flights WHERE DEP_TS < s) AS years
        FROM (SELECT foldCol, min(DEP_TS) AS s FROM folds WHERE split = 'val' GROUP BY foldCol)) ON DEP_TS < s
      GROUP BY ALL)"""


def known_volume(spark: SparkSession, d: str, placed: DataFrame) -> DataFrame:
    return stage_table(enrich.fold_volume(inputs.flights(spark, d), folds.validation_starts(placed)), "fold-volume")


@query("fold_volume", f"{sql('', 'folds')}, {_KNOWN} SELECT foldCol, airport, round(volume, 6) AS avg_yr_flights FROM known")
def _(spark, d):
    """Flights per airport and year that had departed when each fold's validation begins."""
    return rounded(known_volume(spark, d, folded(spark, d)))


@query("fold_volume_join", f"""{sql('', 'folds')}, {_KNOWN}
    SELECT FLIGHT_ID, f.foldCol, split, round(o.volume, 6) AS origin_yr_flights, round(t.volume, 6) AS dest_yr_flights
    FROM folds f LEFT JOIN known o ON o.foldCol = f.foldCol AND o.airport = f.ORIGIN
      LEFT JOIN known t ON t.foldCol = f.foldCol AND t.airport = f.DEST""")
def _(spark, d):
    placed = folded(spark, d)
    joined = enrich.join_fold_volume(placed, known_volume(spark, d, placed))
    return rounded(joined, only=["origin_yr_flights", "dest_yr_flights"]).select(
        "FLIGHT_ID", "foldCol", "split", "origin_yr_flights", "dest_yr_flights")


@query("test_prep", sql("""
    SELECT FLIGHT_ID, DEP_DEL15, OP_UNIQUE_CARRIER, DISTANCE,
      CASE WHEN AW1 <> '' OR AW2 <> '' OR MW1 <> '' THEN 1 ELSE 0 END AS specWeather
    FROM weather WHERE DEP_DEL15 IS NOT NULL""", "weather"))
def _(spark, d):
    counted = weather.present_count(inputs.weather_flights(spark, d))
    return sampling.prepare_test(counted).select("FLIGHT_ID", "DEP_DEL15", "OP_UNIQUE_CARRIER", "DISTANCE", "specWeather")


@query("time_holdout", sql("""
    SELECT CASE WHEN "YEAR" = 2001 THEN 'test' ELSE 'train' END AS part, count(*) AS n,
      round(avg(DISTANCE), 4) AS mean_distance
    FROM routes GROUP BY 1""", "routes"))
def _(spark, d):
    train, test = sampling.time_holdout(inputs.routes(spark, d), 2001)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.round(F.avg("DISTANCE"), 4).alias("mean_distance"))


@query("confusion", sql("SELECT * FROM confusion", "confusion"))
def _(spark, d):
    return metrics.confusion(inputs.predictions(spark, d))


@query("classification_metrics", sql(f"SELECT *, {metrics_sql()} FROM confusion", "confusion"))
def _(spark, d):
    return rounded(metrics.metrics(metrics.confusion(inputs.predictions(spark, d))))


def fold_metrics(spark: SparkSession, d: str) -> DataFrame:
    placed = folds.assign_folds(inputs.predictions(spark, d))
    return metrics.metrics(metrics.confusion(placed, by=["foldCol", "split"]))


_FOLD_METRICS = f"(SELECT foldCol, split, {metrics_sql()} FROM fold_confusion)"


@query("fold_metrics", sql(f"""
    SELECT foldCol, split, metric, value FROM {_FOLD_METRICS}
    UNPIVOT (value FOR metric IN (precision, recall, accuracy, mean_pr, f1, fbeta))""", "fold_confusion"))
def _(spark, d):
    return rounded(metrics.long_metrics(fold_metrics(spark, d), ["foldCol", "split"]))


def _fold_sql(form: str) -> str:
    exact = metrics_sql().replace("round(", "(").replace(", 6)", ")")
    cols = ", ".join(f"round({form.format(m)}, 6) AS {m}" for m in metrics.METRICS)
    return sql(f"SELECT split, {cols} FROM (SELECT foldCol, split, {exact} FROM fold_confusion) GROUP BY split", "fold_confusion")


@query("weighted_fold_mean", _fold_sql("sum({0} * (foldCol + 1)) / sum(foldCol + 1)"))
def _(spark, d):
    return rounded(metrics.weighted_fold_mean(fold_metrics(spark, d)))


@query("fold_stability", _fold_sql("stddev_samp({0})"))
def _(spark, d):
    return rounded(metrics.fold_stability(fold_metrics(spark, d)))


@query("ranking_scores_given", sql("""
    SELECT round(pairs / (p * cast(n AS double)), 6) AS auc_roc, round((f1 + f0) / 2, 6) AS f1_macro,
      round((f1 * p + f0 * n) / (p + n), 6) AS f1_weighted
    FROM (SELECT sum(pos * (coalesce(below, 0) + neg / 2e0)) AS pairs FROM (
        SELECT pos, neg, sum(neg) OVER (ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM (
          SELECT p1, count(*) FILTER (DEP_DEL15 = 1) AS pos, count(*) FILTER (DEP_DEL15 = 0) AS neg FROM predictions
          WHERE DEP_DEL15 IS NOT NULL AND p1 IS NOT NULL GROUP BY p1))),
      (SELECT tp + fn AS p, fp + tn AS n, 2e0 * tp / (2 * tp + fp + fn) AS f1, 2e0 * tn / (2 * tn + fn + fp) AS f0 FROM confusion)""",
    "predictions", "confusion"))
def _(spark, d):
    """Exact area and F1 figures of made-up probabilities, many of them tied."""
    return rounded(metrics.ranking_table(inputs.predictions(spark, d), "p1"))


@query("threshold_sweep", sql(f"SELECT *, {metrics_sql()} FROM (" + " UNION ALL ".join(f"""
    SELECT cast({t} AS double) AS threshold, count(*) FILTER (DEP_DEL15 = 1 AND p1 > {t}) AS tp,
      count(*) FILTER (DEP_DEL15 = 0 AND p1 > {t}) AS fp, count(*) FILTER (DEP_DEL15 = 1 AND NOT p1 > {t}) AS fn,
      count(*) FILTER (DEP_DEL15 = 0 AND NOT p1 > {t}) AS tn FROM predictions""" for t in (0.5, 0.6, 0.7)) + ")", "predictions"))
def _(spark, d):
    return rounded(metrics.threshold_sweep(inputs.predictions(spark, d), [0.5, 0.6, 0.7]))
