"""Packed weather strings, ceiling bands and special weather codes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.functions.scalar import is_present
from aerolag.schema import SPECIAL_WEATHER


@dataclass(frozen=True)
class PackedField:
    """Where a number sits in a packed string and when it means "missing"."""

    name: str
    source: str
    index: int
    scale: int
    missing: str | None

    @property
    def raw(self) -> str:
        """Name that the subfield's text has while it is parsed."""
        return f"__raw_{self.name}"

    def text(self) -> Column:
        return F.split_part(F.col(self.source), F.lit(","), F.lit(self.index + 1))

    def column(self) -> Column:
        raw = F.col(self.raw)
        number = raw.try_cast("double")
        if self.scale != 1:
            number = number / self.scale
        return number if self.missing is None else F.when(raw != self.missing, number)


# Subfield positions, scales and missing-value codes. "isd" takes
# the codes of the public surface-data format, in which the fifth wind subfield
# is the quality code of the speed; "reference" takes the codes the published
# figures were made with, which let some missing readings through.
RULES: dict[str, tuple[PackedField, ...]] = {
    "isd": (
        PackedField("wind_direction", "WND", 0, 1, "999"),
        PackedField("wind_speed", "WND", 3, 10, "9999"),
        PackedField("wind_speed_quality", "WND", 4, 1, None),
        PackedField("ceiling_height", "CIG", 0, 1, "99999"),
        PackedField("visibility", "VIS", 0, 1000, "999999"),
        PackedField("temperature", "TMP", 0, 10, "+9999"),
        PackedField("sea_level_pressure", "SLP", 0, 10, "99999"),
        PackedField("dew_point", "DEW", 0, 10, "+9999"),
    ),
    "reference": (
        PackedField("wind_direction", "WND", 0, 1, "999"),
        PackedField("wind_speed", "WND", 3, 10, "999"),
        PackedField("gust_speed", "WND", 4, 1, "999"),
        PackedField("ceiling_height", "CIG", 0, 1, "99999"),
        PackedField("visibility", "VIS", 0, 1000, "99999"),
        PackedField("temperature", "TMP", 0, 10, "999"),
        PackedField("sea_level_pressure", "SLP", 0, 10, "99999"),
        PackedField("dew_point", "DEW", 0, 10, "999"),
    ),
}

# Report types kept (hourly airport reports and ground observations).
REPORT_TYPES = ("FM-15", "SOA")


def parse_packed(df: DataFrame, sentinels: str = "isd", rules: Sequence[PackedField] | None = None) -> DataFrame:
    """Replace the packed strings by one number column per subfield.

    Short strings and unreadable numbers give null. The texts of the subfields are
    columns of their own first: a text that is both compared and read is cut out once.
    """
    fields = rules or RULES[sentinels]
    cut = df.withColumns({f.raw: f.text() for f in fields})
    return cut.withColumns({f.name: f.column() for f in fields}).drop(
        *{f.source for f in fields}, *[f.raw for f in fields])


def band_flags(df: DataFrame, col: str = "ceiling_height", edges: tuple[int, int] = (10000, 20000)) -> DataFrame:
    """Three 0/1 columns: below, between and above two edges; null sets none."""
    low, high = edges
    value = F.col(col)

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    return df.withColumns({
        f"{col}_is_below_{low}": flag(value < low),
        f"{col}_is_between_{low}_{high}": flag((value >= low) & (value < high)),
        f"{col}_is_above_{high}": flag(value >= high),
    })


def present_count(df: DataFrame, cols: Sequence[str] = SPECIAL_WEATHER, out: str = "specWeather") -> DataFrame:
    """How many of the code columns hold a code; the code columns are dropped."""
    total = F.lit(0)
    for c in cols:
        total = total + is_present(F.col(c)).cast("int")
    return df.withColumn(out, total).drop(*cols)


def binarise(df: DataFrame, col: str = "specWeather") -> DataFrame:
    """1 where a count is positive, else 0."""
    return df.withColumn(col, F.when(F.col(col) > 0, 1).otherwise(0))


def keep_report_types(df: DataFrame, types: Sequence[str] = REPORT_TYPES, col: str = "REPORT_TYPE") -> DataFrame:
    """Observations of the wanted report types."""
    return df.filter(F.col(col).isin(*types))
