"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the codes used by the flight data.
WEEKDAYS = {
    1: "Monday", 2: "Tuesday", 3: "Wednesday", 4: "Thursday", 5: "Friday", 6: "Saturday", 7: "Sunday",
}
MONTHS = {
    1: "January", 2: "February", 3: "March", 4: "April", 5: "May", 6: "June",
    7: "July", 8: "August", 9: "September", 10: "October", 11: "November", 12: "December",
}


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, 0 where the whole is 0."""
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def code_label(code: Column, names: dict[int, str]) -> Column:
    """Name of a numeric code; null when the code has none."""
    entries = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), code)


def hour_block(hour: Column) -> Column:
    """Clock hour as the text block ``HH00-HH59``."""
    hh = F.lpad(hour.cast("string"), 2, "0")
    return F.concat(hh, F.lit("00-"), hh, F.lit("59"))


# Hours before which the public block codes have one block for the whole night, and that block (fixed values).
NIGHT_ENDS, NIGHT_BLOCK = 6, "0001-0559"


def public_block(hour: Column) -> Column:
    """Clock hour as the block that public schedules use: hour blocks from six on, one for the night before."""
    return F.when(hour < NIGHT_ENDS, F.lit(NIGHT_BLOCK)).otherwise(hour_block(hour))


def floor_bin(value: Column, width: int) -> Column:
    """Lower edge of the fixed-width bin of a value."""
    return (F.floor(value / F.lit(width)) * F.lit(width)).cast("int")


def bin_label(lower: Column, width: int) -> Column:
    """Text ``lower-upper`` of a fixed-width bin."""
    return F.concat(lower.cast("string"), F.lit("-"), (lower + F.lit(width)).cast("string"))


def is_present(text: Column) -> Column:
    """True unless the code is null or empty."""
    return F.coalesce(text != F.lit(""), F.lit(False))


def next_season(year: Column, season: Column, period: int) -> tuple[Column, Column]:
    """The season after a given one, rolling over to the next year."""
    position = season + F.lit(1)
    wraps = season >= F.lit(period)
    return (
        F.when(wraps, year + F.lit(1)).otherwise(year).cast("int"),
        F.when(wraps, position - F.lit(period)).otherwise(position).cast("int"),
    )
