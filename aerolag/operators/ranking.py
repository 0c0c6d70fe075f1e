"""Exact positions and quantiles without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Context, Decimal
from functools import reduce
from math import ceil
from operator import and_
from struct import pack, unpack

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.sources.stage import Stages, stage_table

# monotonically_increasing_id keeps the row number of a partition in 33 bits.
_ROW_BITS = 33


def global_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Number all rows from 1 in a total order.

    The rows are range-sorted across the cluster and written once; each row
    then gets the size of the partitions before its own plus its place within.
    The only ungrouped window runs over one row per partition. ``order`` should
    tell all rows apart, so that a popular value is spread over partitions.
    """
    placed = stage_table(df.orderBy(*order).withColumn("__row", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("__part", F.shiftright("__row", _ROW_BITS))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part").agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    inside = F.col("__row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition of the sort, so always small.
    return placed.join(F.broadcast(offsets), "__part").select(
        *df.columns, (F.col("__before") + inside + 1).alias(name)
    )


def _double_key(col: str) -> Column:
    """A whole number that orders doubles like their values, NaN last: their bits, mirrored below zero.

    The bits come from the exponent and the mantissa, since no cast gives them.
    Powers of two and divisions by them are exact; the logarithm is not and is
    corrected by one.
    """
    v = F.col(col).cast("double")
    size = F.abs(v)
    two = F.lit(2.0)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    part = size / F.pow(two, guess)
    exponent = F.when(part >= 2, guess + 1).when((part < 1) & (guess > -1022), guess - 1).otherwise(guess)
    mantissa = size / F.pow(two, exponent)  # below 1 for numbers too small for a full mantissa
    unit = 1 << 52
    bits = (exponent + 1022).cast("long") * F.lit(unit) + (mantissa * F.lit(float(unit))).cast("long")
    infinite = F.lit(2047 * unit)
    bits = F.when(F.isnan(v), infinite + 1).when(size == float("inf"), infinite).when(size == 0, F.lit(0)).otherwise(bits)
    return F.when(v < 0, -bits).otherwise(bits)


# Digits of the numbers that a decimal of more than _LONG digits is split into.
_CHUNK, _LONG = 9, 18
# Rows that may be ranked at once, when so few are left around a rank.
_FEW = 1 << 16


def _chunks(kind: T.DecimalType) -> list[tuple[int, int, int]]:
    """Runs of digits of a decimal written out with its sign: first character, length, power of ten of the last digit."""
    whole, out = kind.precision - kind.scale, []
    for start, end, shift in ((0, whole, 0), (whole, kind.precision, 1)):  # a point lies between the two
        for at in range(start, end, _CHUNK):
            size = min(_CHUNK, end - at)
            out.append((at + shift + 2, size, whole - at - size))
    return out


def _written_out(c: Column, kind: T.DecimalType) -> Column:
    """All digits of a decimal; arithmetic on decimals this long rounds in places."""
    whole = "0" * (kind.precision - kind.scale)
    return F.to_char(c, F.lit(f"S{whole}" + ("." + "0" * kind.scale if kind.scale else "")))


def _is_long_decimal(kind: T.DataType) -> bool:
    return isinstance(kind, T.DecimalType) and kind.precision > _LONG


def _decimal_numbers(c: Column, kind: T.DecimalType) -> list[Column]:
    """A decimal as whole numbers, most significant first, all with its sign; a long one comes written out."""
    if not _is_long_decimal(kind):
        unit = F.lit(Decimal(10**kind.scale))
        return [(c * unit).cast(f"decimal({kind.precision},0)").cast("long")]
    sign = F.when(F.substring(c, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    return [F.substring(c, at, size).cast("long") * sign for at, size, _ in _chunks(kind)]


def _ordered_numbers(kind: T.DataType, col: str) -> list[Column]:
    """Whole numbers, most significant first, that order like a column's values; equal only for equal values."""
    c = F.col(col)
    if isinstance(kind, T.DecimalType):
        return _decimal_numbers(F.col(f"__text_{col}") if _is_long_decimal(kind) else c, kind)
    if isinstance(kind, T.IntegralType):
        return [c.cast("long")]
    if isinstance(kind, T.BooleanType):
        return [c.cast("int").cast("long")]
    if isinstance(kind, T.DateType):
        return [F.unix_date(c).cast("long")]
    if isinstance(kind, T.FloatType | T.DoubleType):
        return [_double_key(col)]
    raise TypeError(f"{col}: no ranks of {kind.simpleString()}")


def _width(kind: T.DataType) -> int:
    """Bits that hold the numbers of a column's key."""
    short = isinstance(kind, T.DecimalType) and not _is_long_decimal(kind)
    return 64 if short or isinstance(kind, T.LongType | T.FloatType | T.DoubleType) else 32


def _value(kind: T.DataType, numbers: Sequence[int]):
    """The value that a key stands for."""
    n = numbers[0]
    if isinstance(kind, T.DecimalType):
        exact = Context(prec=kind.precision + 1)
        powers = [-kind.scale] if not _is_long_decimal(kind) else [e for _, _, e in _chunks(kind)]
        parts = [Decimal(n).scaleb(e, exact) for n, e in zip(numbers, powers)]
        return reduce(exact.add, parts).quantize(Decimal(1).scaleb(-kind.scale), context=exact)
    if isinstance(kind, T.BooleanType):
        return bool(n)
    if isinstance(kind, T.DateType):
        return date(1970, 1, 1) + timedelta(days=n)
    if isinstance(kind, T.FloatType | T.DoubleType):
        size = unpack("<d", pack("<q", abs(n)))[0]
        return -size if n < 0 else size
    return n


def with_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns, and for each of them ``__key_<column>``: its order as whole numbers, null for no value."""
    cols = list(dict.fromkeys(cols))
    kinds = {c: df.schema[c].dataType for c in cols}
    texts = {f"__text_{c}": _written_out(F.col(c), k) for c, k in kinds.items() if _is_long_decimal(k)}
    keys = [F.when(F.col(c).isNotNull(), F.array(*_ordered_numbers(kinds[c], c))).alias(f"__key_{c}") for c in cols]
    return df.select(*cols).withColumns(texts).select(*cols, *keys)


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], bits: int = 16, few: int = _FEW
) -> dict[str, list]:
    """The ``ceil(p * n)``-th smallest non-null value per column and probability, in the column's own type.

    For whole numbers, fractions (NaN last), decimals of any precision, truth
    values and dates. Columns without values give an empty list. The columns
    alone and their keys are staged once, so the source is read once. Ranks are
    found by radix selection: a pass counts, for all columns and ranks together,
    the next ``bits`` bits of the keys that still match, and narrows each rank
    to one digit; a 64-bit key has four. Where at most ``few`` rows are left they
    are ranked at once. Counts are combined before they shuffle, at most 2**bits
    or ``few`` per rank; nothing is estimated.
    """
    with Stages(df.sparkSession) as stages:
        return keyed_quantiles(stages.put(with_keys(df, cols), "columns"), cols, probs, bits, few)


def keyed_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], bits: int = 16, few: int = _FEW
) -> dict[str, list]:
    """``exact_quantiles`` of a table that has its keys and is cheap to read several times."""
    cols = list(dict.fromkeys(cols))
    kinds = {c: df.schema[c].dataType for c in cols}
    counts = df.agg(*[F.count(f"__key_{c}").alias(c) for c in cols]).first()
    found: dict[tuple, tuple] = {}  # by column and rank
    targets = [(c, max(1, ceil(round(p * counts[c], 9)))) for c in cols if counts[c] for p in probs]
    # What is known of a rank: numbers of the key, bounds of the next one, and the rank and rows inside them.
    todo = {t: _Place((), None, None, _width(kinds[t[0]]), t[1], counts[t[0]]) for t in dict.fromkeys(targets)}
    while todo:
        groups = list(dict.fromkeys((c, p.inside) for (c, _), p in todo.items()))
        small = [next(p.rows for (d, _), p in todo.items() if (d, p.inside) == (c, i)) <= few for c, i in groups]
        picked = _pick(df, groups, small, [
            sorted({p.rank for (d, _), p in todo.items() if (d, p.inside) == g}) for g in groups for d in [g[0]]
        ], kinds, bits)
        for t, p in list(todo.items()):
            g = groups.index((t[0], p.inside))
            hit = min((r for r in picked if r["group"] == g and r["upto"] >= p.rank), key=lambda r: r["upto"])
            if small[g]:
                found[t] = tuple(hit["key"])
                del todo[t]
                continue
            place = p.narrowed(hit["key"][0], hit["upto"] - hit["n"], hit["n"], bits, _width(kinds[t[0]]))
            if place.shift == 0 and len(place.numbers) == len(_ordered_numbers(kinds[t[0]], t[0])):
                found[t] = place.numbers
                del todo[t]
            else:
                todo[t] = place
    result: dict[str, list] = {c: [] for c in cols}
    for c, rank in targets:
        result[c].append(_value(kinds[c], found[c, rank]))
    return result


@dataclass(frozen=True)
class _Place:
    """Where a rank is known to be among the keys of its column."""

    numbers: tuple[int, ...]  # leading numbers of the key
    low: int | None  # bounds of the next number, if known
    high: int | None
    shift: int  # its bits that are open
    rank: int  # among the rows inside
    rows: int

    @property
    def inside(self) -> tuple:
        return self.numbers, self.low, self.high, self.shift

    def narrowed(self, digit: int, below: int, rows: int, bits: int, width: int) -> _Place:
        numbers, first, left = self.numbers, self.low, self.shift
        if left == 0:  # the number was found, so this digit begins the next one
            first, left = None, width
        shift = max(0, left - bits)
        low = (first or 0) + (digit << shift)
        if shift == 0:
            return _Place((*numbers, low), None, None, 0, self.rank - below, rows)
        return _Place(numbers, low, low + (1 << shift) - 1, shift, self.rank - below, rows)


def _pick(df: DataFrame, groups: list, small: list[bool], ranks: list[list[int]], kinds: dict, bits: int) -> list:
    """Per group of rows and wanted rank: its next digit, or where few rows are left its key, with counts up to it."""
    marks = []
    for i, (c, (numbers, low, high, shift)) in enumerate(groups):
        def number(at: int, key: str = f"`__key_{c}`") -> Column:
            return F.get(key, F.lit(at))

        inside = [F.col(f"__key_{c}").isNotNull(), *[number(j) == n for j, n in enumerate(numbers)]]
        at = len(numbers)
        if low is not None:
            inside.append(number(at).between(F.lit(low), F.lit(high)))
        if small[i]:
            key = F.col(f"__key_{c}")
        else:
            left = shift or _width(kinds[c])
            digit = F.shiftright(number(at), max(0, left - bits))
            # The first digit keeps the sign; the bits above any other are the same for all rows inside.
            if low is not None:
                digit = digit.bitwiseAND(F.lit((1 << min(bits, left)) - 1))
            key = F.array(digit)
        marks.append(F.when(reduce(and_, inside), F.struct(F.lit(i).alias("group"), key.alias("key"))))
    wanted = F.element_at(F.array(*[F.array(*[F.lit(r).cast("long") for r in w]) for w in ranks]), F.col("group") + 1)
    upto = Window.partitionBy("group").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.select(F.explode(F.array_compact(F.array(*marks))).alias("m")).select("m.*")
        .groupBy("group", "key").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .filter(F.exists(wanted, lambda r: (r <= F.col("upto")) & (r > F.col("upto") - F.col("n"))))
        .collect()  # at most one row per rank
    )
