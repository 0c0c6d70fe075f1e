"""Shared pieces: tables, gapless numbering, joins with hot keys, pattern spans, components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolag.sources.stage import Stages

# A key is hot when it holds at least this share of the rows, so no table has
# more than 1 / HOT_SHARE hot keys and a broadcast of them stays small.
HOT_SHARE = 1 / 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; AEROLAG_TOKENIZERS overrides the folder."""
    folder = os.environ.get("AEROLAG_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str, buckets: int) -> DataFrame:
    """Add ``name``: 0, 1, ... without gaps inside each group.

    Rows of a group are dealt into ``buckets`` by a hash of ``order``, numbered
    inside a bucket, and shifted by the sizes of the buckets before it, so even
    a group that holds most rows is spread. ``df`` is read twice: stage it.
    Rows alike in ``order`` get neighbouring numbers in any order.
    """
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*[f"__g{i}" for i in range(len(groups))]).orderBy("__b")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        dealt.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__bucket").alias("__b"))
        .agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    same = F.col("__bucket") == F.col("__b")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inside = Window.partitionBy(*groups, "__bucket").orderBy(*order)
    return (
        dealt.join(sizes, same)
        .withColumn(name, (F.col("__before") + F.row_number().over(inside) - 1).cast("long"))
        .drop("__bucket", "__b", "__before", *[f"__g{i}" for i in range(len(groups))])
    )


def skew_join(left: DataFrame, right: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Join many ``left`` rows to the one ``right`` row of their ``key``.

    ``right`` has in ``size`` how many left rows hold the key (dropped). Keys
    that hold 1/256 of the rows or more are at most 256 and are broadcast; the
    other rows are shuffled. A null key meets nothing. ``how``: inner or left.
    """
    total = right.agg(F.sum(size)).first()[0] or 0
    hot = right.where(F.col(size) >= max(2.0, total * HOT_SHARE)).drop(size)
    rest = right.where(F.col(size) < max(2.0, total * HOT_SHARE)).drop(size)
    keys = hot.select(key)
    return (
        left.join(F.broadcast(hot), key)
        .unionByName(left.join(F.broadcast(keys), key, "left_anti").join(rest, key, how))
    )


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(items: Column, zero: Column, step) -> Column:
    """The states of an ``aggregate`` after each item, in an array.

    Appending to one array copies it each time. So items are cut into about as
    many blocks as each has items, and only arrays of that length grow: a
    million items cost about as much as a thousand times a thousand.
    """
    def block_starts(blocks: Column) -> Column:
        start = F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out"))
        return F.aggregate(blocks, start, lambda s, b: F.struct(
            F.aggregate(b, s["at"], step).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def inside(block: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.slice(F.array(first), 1, 0).alias("out"))

        def grow(s: Column, x: Column) -> Column:
            return bound(step(s["at"], x), lambda v: F.struct(v.alias("at"), F.concat(s["out"], F.array(v)).alias("out")))

        return F.aggregate(block, start, grow, lambda s: s["out"])

    def cut(items: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(items).cast("double"))).cast("int"), F.lit(1))
        count = F.ceil(F.size(items) / size).cast("int")
        return bound(size, lambda n: F.transform(
            F.filter(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: i < count),
            lambda i: F.slice(items, i * n + 1, n)))

    whole = bound(items, lambda x: bound(cut(x), lambda blocks: F.flatten(F.zip_with(blocks, block_starts(blocks), inside))))
    # Most texts have a few matches, for which one block does.
    return bound(items, lambda x: F.when(F.size(x) <= 64, inside(x, zero)).otherwise(whole))


def match_spans(text: Column, pattern: str, kind: str, group: int = 0, window: int = 0) -> Column:
    """Leftmost non-overlapping matches of a pattern that is never empty.

    Array of (start, end, kind, hit, part): code points, end exclusive; ``hit``
    is the match and ``part`` one group of it. With a ``window`` there is also
    ``before``: as many characters before the match. The text between matches
    and the matches themselves alternate, so their lengths add up to the positions.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.split(text, pattern, -1)
    steps = F.arrays_zip(
        (gaps if window else F.transform(gaps, lambda g: F.length(g))).alias("gap"), hits.alias("hit"), parts.alias("part"))

    def length(x: Column) -> Column:
        gap = F.length(x["gap"]) if window else x["gap"]
        return gap + F.coalesce(F.length(x["hit"]), F.lit(0))

    def last(*texts: Column) -> Column:
        return F.right(F.concat(*[F.right(t, F.lit(window)) for t in texts]), F.lit(window))

    if window:
        zero = F.struct(F.lit(0).alias("end"), F.lit("").alias("before"), F.lit("").alias("tail"))

        def step(s: Column, x: Column) -> Column:
            before = last(s["tail"], x["gap"])
            return F.struct((s["end"] + length(x)).alias("end"), before.alias("before"),
                            last(before, F.coalesce(x["hit"], F.lit(""))).alias("tail"))
    else:
        zero = F.struct(F.lit(0).alias("end"))

        def step(s: Column, x: Column) -> Column:
            return F.struct((s["end"] + length(x)).alias("end"))

    def span(x: Column, s: Column) -> Column:
        fields = [(s["end"] - F.coalesce(F.length(x["hit"]), F.lit(0))).alias("start"), s["end"].alias("end"),
                  F.lit(kind).alias("kind"), x["hit"].alias("hit"), x["part"].alias("part")]
        return F.struct(*fields, *([s["before"].alias("before")] if window else []))

    walked = bound(steps, lambda x: F.zip_with(x, running(x, zero, step), span))
    return F.filter(walked, lambda s: s["hit"].isNotNull())


def spans_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then by place in ``kinds``, comma-joined."""
    rank = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) of every node in an edge table (a, b): root is the least node reached.

    Alternates two rounds in which nodes point their larger, then their smaller
    neighbours to the least one they know, until nothing changes. Each round
    is a stage table; only counts reach the driver.
    """
    now = stages.put(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        signs = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == tuple(signs):
            break
        state = tuple(signs)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stages.put(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        small = stages.put(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "small")
        stages.drop(now, large)
        now = small
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

