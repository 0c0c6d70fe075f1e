"""URL filters: rules by host and path, and a Bloom filter cascade for a host list.

A cascade answers membership exactly for every key of a known universe. Level
1 encodes the listed keys; level 2 encodes the other keys that level 1 lets
pass by mistake; level 3 the listed keys that level 2 lets pass, and so on until
no key is left. A key's first level without it decides. The universe is all
keys of the corpus, so no join with the list is needed afterwards.

A cascade is broadcast, so its size is bounded: the keys are split by hash into
as many cascades as keep each below CASCADE_BYTES, and the rows are judged by
one cascade after the other, each row by its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from aerolag.sources.stage import Stages

CASCADE_BYTES = 8 << 20
DEEP_RATE = 0.5  # false positive rate of all levels but the first
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Level:
    bits: int
    hashes: int
    words: np.ndarray


@dataclass
class Cascade:
    """Levels of one share of the keys; level 1 encodes listed keys."""

    share: int
    levels: list[Level] = field(default_factory=list)

    def listed(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Exact membership of universe keys, given their two hashes."""
        answer = np.zeros(len(one), bool)
        undecided = np.arange(len(one))
        for depth, level in enumerate(self.levels, 1):
            passed = holds(level, depth, one[undecided], two[undecided])
            answer[undecided[~passed]] = depth % 2 == 0
            undecided = undecided[passed]
        answer[undecided] = len(self.levels) % 2 == 1
        return answer


def positions(level: Level, depth: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Bit positions (keys x hashes); each level mixes the key's two hashes anew."""
    with np.errstate(over="ignore"):
        a = one.astype(np.uint64) ^ np.uint64(depth * 0x9E3779B97F4A7C15 & (2**64 - 1))
        a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(29)
        step = two.astype(np.uint64) * np.uint64(2 * depth + 1) | np.uint64(1)
        mixed = a[:, None] + step[:, None] * np.arange(level.hashes, dtype=np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(8)) % np.uint64(level.bits)


def holds(level: Level, depth: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    at = positions(level, depth, one, two)
    return (level.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(axis=1)


def _shape(n: int, rate: float) -> tuple[int, int]:
    """(bits, hashes) of a Bloom filter for ``n`` keys."""
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    return bits, max(1, round(bits / n * math.log(2)))


def first_rate(listed: int, other: int) -> float:
    """Rate of level 1 that keeps the whole cascade small."""
    return min(DEEP_RATE, math.sqrt(0.5) * max(1, listed) / max(1, other))


def keyed(key: Column, shares: int) -> list[Column]:
    return [F.xxhash64(key).alias("one"), F.xxhash64(key, F.lit("second")).alias("two"),
            F.pmod(F.xxhash64(F.lit("share"), key), F.lit(shares)).cast("int").alias("share")]


def _encode(keys: DataFrame, n: int, rate: float, depth: int) -> Level:
    """Bits of a set, or-ed word by word on the executors; as many words come back as the filter has."""
    level = Level(*_shape(n, rate), np.empty(0, np.uint64))
    bare = Level(level.bits, level.hashes, level.words)

    @F.pandas_udf("array<long>")
    def bit_positions(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series(list(positions(bare, depth, one.to_numpy(), two.to_numpy()).astype(np.int64)))

    words = (
        keys.select(F.explode(bit_positions("one", "two")).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
        .toPandas()
    )
    level.words = np.zeros(-(-level.bits // 64), np.uint64)
    level.words[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return level


def build_cascades(universe: DataFrame, key: str, listed: Column, limit: int = CASCADE_BYTES) -> list[Cascade]:
    """Cascades for the keys of ``universe`` (repeats allowed) that satisfy ``listed``.

    Null keys are left out. Two keys with equal hashes of which one is listed
    cannot be told apart; that is an error.
    """
    stages = Stages(universe.sparkSession)
    with stages:
        names = universe.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(listed).alias("listed"))
        names = stages.put(names.withColumn("listed", F.coalesce("listed", F.lit(False))), "universe")
        sizes = names.agg(F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("other")).first()
        rate = first_rate(sizes.listed, sizes.other)
        bits = _shape(max(1, sizes.listed), rate)[0] + 4 * _shape(max(1, sizes.listed), DEEP_RATE)[0]
        shares = max(1, math.ceil(bits / 8 / limit))
        hashed = names.select(*keyed(F.col("key"), shares), "listed")
        return [_build(hashed.where(F.col("share") == s).select("one", "two", "listed"), s) for s in range(shares)]


def _build(hashed: DataFrame, share: int) -> Cascade:
    cascade = Cascade(share)
    while True:
        depth = len(cascade.levels) + 1
        levels = list(cascade.levels)

        @F.pandas_udf(BooleanType())
        def passes(one: pd.Series, two: pd.Series) -> pd.Series:
            kept = np.ones(len(one), bool)
            for d, level in enumerate(levels, 1):
                kept &= holds(level, d, one.to_numpy(), two.to_numpy())
            return pd.Series(kept)

        left = hashed.where(passes("one", "two")) if levels else hashed
        counts = left.agg(F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("other")).first()
        mine, others = (counts.listed, counts.other) if depth % 2 else (counts.other, counts.listed)
        if not mine:
            return cascade
        if depth > 64:
            raise ValueError("a listed key has the hashes of one that is not")
        rate = first_rate(mine, others) if depth == 1 else DEEP_RATE
        cascade.levels.append(_encode(left.where(F.col("listed") == bool(depth % 2)), mine, rate, depth))


def _member(shared):
    @F.pandas_udf(BooleanType())
    def member(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series(shared.value.listed(one.to_numpy(), two.to_numpy()))

    return member


def with_listed(df: DataFrame, key: str, cascades: list[Cascade], name: str) -> DataFrame:
    """Add whether the row's key is listed; a null key is not. Keys outside the universe may be wrong."""
    out = None
    for cascade in cascades:
        member = _member(df.sparkSession.sparkContext.broadcast(cascade))
        one, two, share = keyed(F.coalesce(F.col(key), F.lit("")), len(cascades))
        part = df.where(share == cascade.share) if len(cascades) > 1 else df
        part = part.withColumn(name, F.when(F.col(key).isNull(), F.lit(False)).otherwise(member(one, two)))
        out = part if out is None else out.unionByName(part)
    return out


def host(url: Column) -> Column:
    """What stands between the first :// and / ? # or the end, A-Z lowered; empty without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)
# A host is on the list when one of its labels is made of such words.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam", "track")
LISTED = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[UrlRule, ...] = RULES,
          listed: str = LISTED, limit: int = CASCADE_BYTES) -> DataFrame:
    """(id, host, path, rule, verdict) of every row.

    Of the rules that fit, the longest decides. Where none fits, hosts on the
    list are blocked and all others allowed. Null urls and urls without :// have
    empty host and path, fit no rule and are allowed. Repeated rows are kept.
    """
    rows = pages.select(F.col(id_col), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    cascades = build_cascades(rows, "host", F.col("host").rlike(listed), limit)
    rows = with_listed(rows, "host", cascades, "__listed")
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("__listed"), "block").otherwise("allow")
    for r in sorted(rules, key=lambda r: len(r.name)):  # later ones are longer and win
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rows.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict"))


ORACLE = rf"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules AS (SELECT * FROM (VALUES {', '.join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}) r(h, p, v)),
fitting AS (
  SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS n
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT parts.page_id, host, path, rule,
  coalesce(v, CASE WHEN regexp_matches(host, '{LISTED}') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fitting ON parts.page_id = fitting.page_id AND n = 1
"""
