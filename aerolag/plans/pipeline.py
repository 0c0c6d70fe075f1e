"""From raw flights to features, folds and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.functions.clock import local_timestamp
from aerolag.operators import enrich, folds, graph, history, outliers, sampling, weather
from aerolag.operators.evaluate import blind_test, cross_validate
from aerolag.schema import FLIGHTS_SCHEMA, IDENTITY_COLUMNS, SPECIAL_WEATHER, FeatureSpec
from aerolag.sources.stage import stage_table

def prepare_flights(flights: DataFrame) -> DataFrame:
    """Raw flights as every step expects them.

    Columns of the input schema are required, except special weather, and cast to
    its types; others stay. A missing row id is a hash of all input columns, so
    copies of a flight share it; a missing DEP_TS is the scheduled local time.
    """
    declared = [f for f in FLIGHTS_SCHEMA.fields if f.name in flights.columns]
    missing = [f.name for f in FLIGHTS_SCHEMA.fields if f.name not in flights.columns]
    required = [c for c in missing if c not in SPECIAL_WEATHER]
    if required:
        raise ValueError(f"flights lack the columns {required}")
    table = flights.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in declared})
    table = table.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else table
    if "FLIGHT_ID" not in table.columns:
        table = table.withColumn("FLIGHT_ID", F.xxhash64(*FLIGHTS_SCHEMA.fieldNames()))
    if "DEP_TS" not in table.columns:
        table = table.withColumn("DEP_TS", local_timestamp(F.col("FL_DATE"), F.col("CRS_DEP_TIME")))
    return table


def build_features(
    flights: DataFrame,
    holidays: DataFrame,
    offsets: DataFrame,
    known: Column | None = None,
    season: str = "QUARTER",
    period: int = 4,
    rank_steps: int | None = None,
    rank_tol: float = 0.01,
    sentinels: str = "isd",
    guard: str = "strict",
    arrival_rule: str = "actual",
    keep_helpers: bool = False,
    spec: FeatureSpec = FeatureSpec(),
) -> DataFrame:
    """Raw flights with packed weather to the feature table.

    ``known`` marks the rows that volume may be counted on; leave the held-out
    period out of it. Kept are features, label, identity, row id, departure
    and the season, unless ``keep_helpers``.

    All joins are with checked lookups and all derivations are column
    expressions, so the flights are shuffled once, by aircraft for the lags.
    Volume and centrality read two columns of the flights each.
    """
    volume = enrich.airport_volume(flights if known is None else flights.filter(known))
    ranks = graph.pagerank(
        graph.season_edges(flights, ("YEAR", season)), ("YEAR", season),
        tol=None if rank_steps else rank_tol, max_iter=rank_steps or 1000,
    )
    centrality = stage_table(enrich.shift_season(ranks, season, period).drop("steps"), "centrality")

    # History comes before the lookups, so that rows are narrow when shuffled.
    table = weather.parse_packed(flights, sentinels)
    table = weather.present_count(weather.band_flags(table))
    table = history.add_utc_times(table, offsets, arrival_rule)
    wanted = {*spec.features, spec.label, spec.row_id, *IDENTITY_COLUMNS, "DEP_TS", season}
    if not keep_helpers:  # what nothing reads any more is not shuffled and written for the lags
        table = table.select(*[c for c in table.columns if c in wanted | history.READ_BY_LAGS])
    table = history.pick_history(history.lag_features(table), guard=guard)
    table = enrich.join_volume(table, volume)
    table = enrich.flag_near_dates(table, holidays)
    table = enrich.join_centrality(table, centrality, season)
    return table if keep_helpers else table.select(*[c for c in table.columns if c in wanted])


def build_training(
    features: DataFrame, spec: FeatureSpec, order: str = "DEP_TS", k: int = 8, trim: Sequence[str] = (),
    need_centrality: bool = True, trim_mode: str = "sequential", copies: str = "row_id",
) -> DataFrame:
    """Feature rows to balanced, deduplicated, optionally trimmed folds.

    Rows without a label, and those of the first season, which have no centrality,
    go before the folds are cut, so every fold has rows. The classes are balanced
    after. ``copies``: rows are copies when they share the row id, or ("full_row")
    when they agree in all but identity columns, row id and departure.
    """
    if copies not in ("row_id", "full_row"):
        raise ValueError(f"unknown copies {copies!r}")
    usable = features.filter(F.col(spec.label).isNotNull())
    if need_centrality:
        usable = usable.filter("pagerank is not null")
    placed = folds.assign_folds(usable, order, spec.row_id, k)
    balanced = weather.binarise(sampling.undersample(placed, spec.label, spec.row_id))
    if copies == "full_row":
        keys = [c for c in balanced.columns if c not in (*IDENTITY_COLUMNS, spec.row_id, order)]
        cleaned = sampling.drop_copies(balanced, keys)
    else:
        cleaned = sampling.drop_rare_copies(balanced, [spec.row_id, "foldCol"], spec.row_id, usable)
    if not trim:
        return cleaned
    if trim_mode == "sequential":  # each column's quartiles read the rows anew
        cleaned = stage_table(cleaned, "cleaned")
    return outliers.iqr_trim(cleaned, trim, mode=trim_mode)


def run(
    flights: DataFrame, holidays: DataFrame, offsets: DataFrame, test_year: int, spec: FeatureSpec,
    kind: str = "lr", k: int = 8, **options,
) -> dict[str, DataFrame]:
    """The whole job, from flights as ``FLIGHTS_SCHEMA`` declares them to folds,
    fold metrics and a blind test on the test year. ``holidays`` holds the dates themselves (see
    ``enrich.paid_holidays``). Flights of the training years only are counted
    for volume."""
    flights = prepare_flights(flights)
    features = stage_table(
        build_features(flights, holidays, offsets, F.col("YEAR") != test_year, spec=spec, **options), "features")
    train_rows, test_rows = sampling.time_holdout(features, test_year)
    training = stage_table(build_training(train_rows, spec, k=k), "folds")
    test = sampling.prepare_test(test_rows, spec.label)
    final, _ = blind_test(training, test, kind, spec)
    return {
        "features": features, "folds": training,
        "fold_metrics": cross_validate(training, kind, spec), "blind_test": final,
    }
