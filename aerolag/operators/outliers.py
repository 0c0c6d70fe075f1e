"""Outlier trimming by quartiles."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_CEILING, ROUND_FLOOR, Context, Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.operators.ranking import exact_quantiles, keyed_quantiles, with_keys
from aerolag.sources.stage import Stages

# Digits enough for any whole number or decimal of a column, widened.
_EXACT = Context(prec=80)


def _widened(kind: T.DataType, q1, q3, reach: float) -> tuple:
    """Least and greatest value within ``reach`` quartile distances, in the column's type.

    Whole numbers and decimals are widened without rounding; the bounds are then
    the outermost values that the type can hold inside them.
    """
    if not isinstance(kind, T.IntegralType | T.DecimalType):
        return q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
    step = _EXACT.multiply(Decimal(repr(reach)), _EXACT.subtract(Decimal(q3), Decimal(q1)))
    low, high = _EXACT.subtract(Decimal(q1), step), _EXACT.add(Decimal(q3), step)
    if isinstance(kind, T.IntegralType):
        most = (1 << 63) - 1
        low, high = (int(x.to_integral_value(r)) for x, r in ((low, ROUND_CEILING), (high, ROUND_FLOOR)))
        return max(low, -most - 1), min(high, most)
    unit, most = Decimal(1).scaleb(-kind.scale), Decimal(10**kind.precision - 1).scaleb(-kind.scale, _EXACT)
    low, high = low.quantize(unit, ROUND_CEILING, _EXACT), high.quantize(unit, ROUND_FLOOR, _EXACT)
    return max(low, -most), min(high, most)


def _bounds(df: DataFrame, cols: Sequence[str], error: float, reach: float, exact) -> dict[str, tuple]:
    if error == 0.0:
        pairs = exact(df, cols, [0.25, 0.75])
        kinds = {c: df.schema[c].dataType for c in cols}
    else:
        pairs = dict(zip(cols, df.approxQuantile(list(cols), [0.25, 0.75], error)))
        kinds = {c: T.DoubleType() for c in cols}
    return {c: _widened(kinds[c], *q, reach) for c, q in pairs.items() if len(q) == 2}


def iqr_bounds(df: DataFrame, cols: Sequence[str], error: float = 0.0, reach: float = 1.5) -> dict[str, tuple]:
    """Quartiles widened by ``reach`` times their distance; columns without
    values are left out. ``error`` above 0 reads quartiles from sketches."""
    return _bounds(df, cols, error, reach, exact_quantiles)


def _inside(bounds: dict[str, tuple], df: DataFrame) -> Column:
    def limit(c: str, value) -> Column:
        kind = df.schema[c].dataType
        return F.lit(value).cast(kind) if isinstance(value, Decimal) else F.lit(value)

    return reduce(and_, [F.col(c).between(limit(c, lo), limit(c, hi)) for c, (lo, hi) in bounds.items()], F.lit(True))


def iqr_trim(
    df: DataFrame, cols: Sequence[str], mode: str = "sequential", error: float = 0.0, reach: float = 1.5
) -> DataFrame:
    """Drop rows outside the bounds of any column, and rows without a value.

    "sequential" takes each column's bounds from the rows that survived the
    columns before, so the order of ``cols`` matters; "onepass" takes all
    bounds from the input. Either way the input is read once to find the bounds,
    for any number of columns: the trimmed columns alone are staged, and
    survivors of the columns before are a filter on that table. The result is a
    filter on the input.
    """
    if mode not in ("sequential", "onepass"):
        raise ValueError(f"unknown trim mode {mode!r}")
    if not cols:
        return df
    bounds: dict[str, tuple] = {}
    with Stages(df.sparkSession) as stages:
        narrow = stages.put(with_keys(df, cols) if error == 0.0 else df.select(*dict.fromkeys(cols)), "trimmed")
        for batch in ([[c] for c in cols] if mode == "sequential" else [list(cols)]):
            left = narrow.filter(_inside(bounds, df))
            found = _bounds(left, batch, error, reach, keyed_quantiles)
            for c, (low, high) in found.items():
                # A column that is trimmed twice must pass both times.
                known = bounds.get(c, (low, high))
                bounds[c] = max(low, known[0]), min(high, known[1])
    return df.filter(_inside(bounds, df))
