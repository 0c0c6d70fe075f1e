"""Sharding by jump consistent hashing, in column expressions.

A key's jumps are fixed by its own pseudo-random stream: the shard is the last
jump target below the shard count. No ring table is needed, and adding shards
moves a row only when its stream jumps into a new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import numbered, partitions
from aerolag.sources.stage import Stages

# Multiplier of the published 64-bit generator (fixed value).
MULTIPLIER = 2862933555777941757
LOW16, LOW32 = 0xFFFF, 0xFFFFFFFF
# Jumps written out as plain expressions; the few keys that jump more often
# take the rest in a loop. Keys jump about ln(shards) times.
UNROLLED = 16


def next_state(state: Column) -> Column:
    """state * MULTIPLIER + 1 in 64 bits. Parts are small, so no product overflows."""
    m0, m1 = MULTIPLIER & LOW16, (MULTIPLIER >> 16) & LOW16
    mh = MULTIPLIER >> 32
    low, high = state.bitwiseAND(F.lit(LOW32)), F.shiftrightunsigned(state, 32)
    mid = low * F.lit(m1)
    bottom = low * F.lit(m0) + F.shiftleft(mid.bitwiseAND(F.lit(LOW16)), 16) + F.lit(1).cast("long")
    top = (
        F.shiftrightunsigned(bottom, 32)
        + F.shiftrightunsigned(mid, 16)
        + (low * F.lit(mh)).bitwiseAND(F.lit(LOW32))
        + (high * F.lit(m0)).bitwiseAND(F.lit(LOW32))
        + F.shiftleft((high * F.lit(m1)).bitwiseAND(F.lit(LOW16)), 16)
    )
    return F.shiftleft(top.bitwiseAND(F.lit(LOW32)), 32).bitwiseOR(bottom.bitwiseAND(F.lit(LOW32)))


def _jump(shard: Column, state: Column) -> Column:
    """Where a key goes from ``shard``, given its stream's state after the step."""
    draw = (F.shiftrightunsigned(state, 33) + 1).cast("double")
    return F.floor((shard + 1).cast("double") * (F.lit(float(1 << 31)) / draw))


def with_shard(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Add the shard (0 .. shards - 1) of the long column ``key``; a null key counts as 0."""
    if shards < 1:
        raise ValueError("need at least one shard")
    state = F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long"))
    out = df.withColumns({"__state": next_state(state), "__at": F.lit(0).cast("long")})
    out = out.withColumn("__to", _jump(F.col("__at"), F.col("__state")))
    steps = min(shards, UNROLLED)
    for _ in range(steps):
        below = F.col("__to") < shards
        out = out.withColumns({"__at": F.when(below, F.col("__to")).otherwise(F.col("__at")),
                               "__state": F.when(below, next_state(F.col("__state"))).otherwise(F.col("__state"))})
        out = out.withColumn("__to", F.when(F.col("__to") < shards, _jump(F.col("__at"), F.col("__state")))
                             .otherwise(F.col("__to")))
    if steps < shards:
        def step(s: Column, _: Column) -> Column:
            on = s["to"] < shards
            state = F.when(on, next_state(s["state"])).otherwise(s["state"])
            at = F.when(on, s["to"]).otherwise(s["at"])
            return F.struct(at.alias("at"), state.alias("state"),
                            F.when(on, _jump(at, state)).otherwise(s["to"]).alias("to"))

        start = F.struct(F.col("__at").alias("at"), F.col("__state").alias("state"), F.col("__to").alias("to"))
        # Each jump goes at least one shard up.
        rest = F.aggregate(F.sequence(F.col("__to"), F.lit(shards).cast("long")), start, step, lambda s: s["at"])
        out = out.withColumn("__at", F.when(F.col("__to") < shards, rest).otherwise(F.col("__at")))
    return out.withColumn(name, F.col("__at").cast("int")).drop("__state", "__at", "__to")


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Law ``key``: id and shard count decide. ``size`` is the text's bytes plus 1,
    ``slot`` numbers the rows of a shard without gaps, ``grown_shard`` is the
    shard among one more. Null text: no bytes. Null id: key 0. Repeated rows
    get slots of their own. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = with_shard(with_shard(rows, "id", shards, "shard"), "id", shards + 1, "grown_shard")
    rows = Stages(docs.sparkSession).put(rows, "shards")
    buckets = partitions(docs.sparkSession)
    out = numbered(rows, ["shard"], ["id", "text_crc32", "size"], "slot", buckets)
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id") -> None:
    """Write whole rows into one folder per shard, each in several files."""
    with_shard(docs, id_col, shards, "__shard").write.partitionBy("__shard").mode("errorifexists").parquet(path)
