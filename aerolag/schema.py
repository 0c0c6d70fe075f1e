"""Column roles and input schemas."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the input tables and the roles they play.
LABEL = "DEP_DEL15"
AIRCRAFT = "TAIL_NUM"
PACKED_WEATHER = ("WND", "CIG", "VIS", "TMP", "DEW", "SLP")
SPECIAL_WEATHER = (
    "AW1", "AW2", "AW3", "AW4", "AW5", "AW6", "AW7",
    "MW1", "MW2", "MW3", "MW4", "MW5", "MW6",
)
IDENTITY_COLUMNS = ("ORIGIN", "DEST", "FL_DATE", "CANCELLED", "YEAR")
ONE_HOT = ("OP_UNIQUE_CARRIER", "DEP_TIME_BLK", "ARR_TIME_BLK", "HIST_ARR_FLT_NUM", "HIST_DEP_FLT_NUM")
BINARY = (
    "ceiling_height_is_below_10000",
    "ceiling_height_is_between_10000_20000",
    "ceiling_height_is_above_20000",
    "isHoliday",
    "specWeather",
)
STANDARD_SCALED = ("wind_direction", "temperature", "sea_level_pressure")
MIN_MAX_SCALED = (
    "CRS_ELAPSED_TIME", "DISTANCE", "visibility", "dew_point", "wind_speed", "wind_speed_quality",
    "HIST_ARR_DELAY", "HIST_DEP_DELAY", "origin_yr_flights", "dest_yr_flights",
)
CENTRALITY = "pagerank"
# Groups of features in the order in which they are tried on top of each other.
FEATURE_GROUPS = {
    "baseline": ONE_HOT[:3] + BINARY[:3] + STANDARD_SCALED + MIN_MAX_SCALED[:6],
    "history_and_volume": ONE_HOT[3:] + MIN_MAX_SCALED[6:],
    "centrality": (CENTRALITY,),
    "holiday_and_weather": BINARY[3:],
}

FLIGHTS_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("QUARTER", "MONTH", "DAY_OF_WEEK", "DAY_OF_MONTH", "YEAR")]
    + [T.StructField(c, T.StringType()) for c in ("FL_DATE", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST")]
    + [T.StructField(c, T.IntegerType()) for c in ("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID")]
    + [T.StructField(c, T.StringType()) for c in (AIRCRAFT, "DEP_TIME_BLK", "ARR_TIME_BLK")]
    + [T.StructField(c, T.IntegerType()) for c in ("CRS_DEP_TIME", "CRS_ARR_TIME")]
    + [
        T.StructField(c, T.DoubleType())
        for c in (
            "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME", "DISTANCE", "DEP_DELAY", "ARR_DELAY", LABEL, "CANCELLED",
        )
    ]
    + [T.StructField(c, T.StringType()) for c in PACKED_WEATHER + SPECIAL_WEATHER]
)


@dataclass(frozen=True)
class FeatureSpec:
    """Which column is encoded how, and which one is the label."""

    one_hot: tuple[str, ...] = ONE_HOT
    binary: tuple[str, ...] = BINARY
    standard: tuple[str, ...] = STANDARD_SCALED
    min_max: tuple[str, ...] = MIN_MAX_SCALED + (CENTRALITY,)
    label: str = LABEL
    # How rows are told apart; used to drop copies and to sample repeatably.
    row_id: str = "FLIGHT_ID"

    @property
    def numeric(self) -> tuple[str, ...]:
        return self.min_max + self.standard

    @property
    def features(self) -> tuple[str, ...]:
        return self.one_hot + self.binary + self.numeric

    def without(self, *names: str) -> "FeatureSpec":
        """The same roles minus some columns."""
        gone = set(names)
        return replace(self, **{
            role: tuple(c for c in getattr(self, role) if c not in gone)
            for role in ("one_hot", "binary", "standard", "min_max")
        })

    def only(self, *names: str) -> "FeatureSpec":
        """The same roles restricted to some columns."""
        return self.without(*(set(self.features) - set(names)))

    def renamed(self, old: str, new: str) -> "FeatureSpec":
        """The same roles with one column under another name."""
        return replace(self, **{
            role: tuple(new if c == old else c for c in getattr(self, role))
            for role in ("one_hot", "binary", "standard", "min_max")
        })

    def check(self, df: DataFrame) -> DataFrame:
        """Fail early, with all missing names at once."""
        missing = [c for c in (*self.features, self.label) if c not in df.columns]
        if missing:
            raise ValueError(f"columns missing from the table: {missing}")
        return df
