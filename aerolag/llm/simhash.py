"""Near-duplicates by SimHash, with tables of distances to pivots.

A fingerprint is 64 bits: a bit is set when more than half the hashes of the
text's word shingles have it. Two fingerprints link at a few differing bits;
documents are classed by the links' components.

Pivot table. Each distinct fingerprint has one row with its Hamming distances to
16 random reference fingerprints, staged once. If two fingerprints differ in at
most d bits, each of these coordinates differs by at most d. The table serves twice:

* Bringing together. A range join on the first two coordinates: a fingerprint is
  put into the cell of each coordinate, and the next cell too if it is within d
  of it, so any two whose coordinates are within d share a cell. The join's key
  also holds blocks of the fingerprint's own bits: with b blocks, d differing
  bits leave at least b - d alike, so some choice of b - d blocks agrees.
* Discarding. Of the pairs that share a key, those with any of the 16 coordinates more
  than d apart are dropped, and the survivors are verified bit by bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolag.llm.common import components, partitions, skew_join
from aerolag.sources.stage import Stages

WIDTH = 64
SEED = 42
PIVOTS = 16  # a multiple of 8, since 8 distances are kept in a long
NEAR = [f"near{i}" for i in range(PIVOTS // 8)]
# Rows of one key that a task compares with each other; larger keys are split.
RUN = 4096


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text; 0 for a text without words or a null one.

    >>> fingerprint("a b c") == xxhash.xxh64_intdigest(b"a b c", 42)
    True
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    counts = np.zeros(WIDTH, np.int64)
    for at in range(0, n, 65536):  # long texts by pieces
        pairs = zip(starts[at:min(n, at + 65536)].tolist(), last[at:at + 65536].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in pairs), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(sum(1 << i for i in np.flatnonzero(counts * 2 > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) of every row; ``fp`` holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def block_masks(n: int, distance: int) -> list[int]:
    """One mask per choice of blocks that must agree, for ``n`` fingerprints.

    More blocks make keys longer and keep the expected number of strangers that
    share a key below one; every choice of blocks is exact. The first step up
    comes at tens of millions of fingerprints.
    """
    if distance >= WIDTH:
        return [0]
    blocks = distance + 2
    while blocks < 2 * distance + 2 and n > 2 ** ((blocks - distance) * WIDTH // blocks):
        blocks += 1
    edges = [round(i * WIDTH / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << WIDTH) if mask >> (WIDTH - 1) else mask


def pivots() -> list[int]:
    """The reference fingerprints."""
    rng = np.random.default_rng(SEED)
    table = rng.integers(0, 1 << 63, PIVOTS, np.uint64) << np.uint64(1) | rng.integers(0, 2, PIVOTS, np.uint64)
    return table.tolist()


def with_distances(prints: DataFrame) -> DataFrame:
    """``prints`` with the distances of ``fp`` to the pivots, a byte each, eight to a column."""
    far = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("long") for p in pivots()]
    columns = {}
    for i, name in enumerate(NEAR):
        packed = far[8 * i]
        for j in range(1, 8):
            packed = packed.bitwiseOR(F.shiftleft(far[8 * i + j], 8 * j))
        columns[name] = packed
    return prints.withColumns(columns)


def _cells(coordinate: Column, distance: int) -> Column:
    """Cells of one coordinate, such that values at most ``distance`` apart share one."""
    width = 2 * (distance + 1)
    own = F.floor(coordinate / width).cast("int")
    return F.when(coordinate % width >= width - distance, F.array(own, own + 1)).otherwise(F.array(own))


def candidate_keys(table: DataFrame, n: int, distance: int) -> DataFrame:
    """``table`` once for each key: agreeing bits, and a cell of each of two pivots' distances."""
    masks = block_masks(n, distance)
    first = F.col(NEAR[0]).bitwiseAND(F.lit(255))
    second = F.shiftright(F.col(NEAR[0]), 8).bitwiseAND(F.lit(255))
    blocks = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("mask", "bits")
    keys = table.select("fp", *NEAR, blocks).withColumn("one", F.explode(_cells(first, distance)))
    keys = keys.withColumn("two", F.explode(_cells(second, distance)))
    return keys.select("fp", *NEAR, F.xxhash64("mask", "bits", "one", "two").alias("key"))


def _join_runs(distance: int):
    """Arrow function: rows sorted by run in; star edges of linked fingerprints out."""
    def links(run: np.ndarray, signed: np.ndarray, *packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fp = np.ascontiguousarray(signed).view(np.uint64)
        near = np.concatenate([np.ascontiguousarray(p).view(np.int8).reshape(-1, 8) for p in packed], axis=1)
        root = np.arange(len(fp))
        for shift in range(1, len(fp)):
            left = np.flatnonzero(run[shift:] == run[:-shift])
            if not len(left):
                break
            right = left + shift
            kept = np.abs(near[left] - near[right]).max(axis=1) <= distance
            left, right = left[kept], right[kept]
            kept = np.bitwise_count(fp[left] ^ fp[right]) <= distance
            left, right = left[kept], right[kept]
            while True:  # merge the classes that these pairs join
                a, b = root[left], root[right]
                apart = a != b
                if not apart.any():
                    break
                left, right, a, b = left[apart], right[apart], a[apart], b[apart]
                np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                while (root != root[root]).any():
                    root = root[root]
        other = np.flatnonzero(root != np.arange(len(fp)))
        return fp[other].view(np.int64), fp[root[other]].view(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rest = ["run", "fp", *NEAR], None
        for batch in batches:
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            rest = cols if rest is None else [np.concatenate(x) for x in zip(rest, cols)]
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0  # the last run may go on
            if cut:
                a, b = links(*[x[:cut] for x in rest])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                rest = [x[cut:] for x in rest]
        if rest is not None and len(rest[0]):
            a, b = links(*rest)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return work


def fingerprint_links(distinct: DataFrame, n: int, distance: int = 3, run: int = RUN) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``distance``.

    ``distinct``: a column fp without repeats, and its distances to the pivots,
    which are added where they are missing; staged. ``n``: its rows. Rows
    that share a key form a run. A key of more than ``run`` rows is cut into
    parts and every two parts (and each part alone) form a run, so a run never
    holds more than about two parts and no pair is lost. Each run gives
    the edges that join its classes, not all its pairs.
    """
    table = distinct if set(NEAR) <= set(distinct.columns) else with_distances(distinct)
    keys = candidate_keys(table, n, distance)
    large = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > run)
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(run)), F.lit(1)).cast("int")
    dealt = (
        keys.join(large, "key", "left")
        .select("fp", *NEAR, "key", parts.alias("parts"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("fp", *NEAR, F.when(F.col("parts") == 1, F.col("key")).otherwise(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("run"))
    )
    spread = dealt.repartition(partitions(distinct.sparkSession), "run").sortWithinPartitions("run")
    return spread.select("run", "fp", *NEAR).mapInArrow(_join_runs(distance), "a long, b long")


def _rooted(prints: DataFrame, stages: Stages, distance: int, run: int) -> tuple[DataFrame, DataFrame]:
    """(fp, least, n, root) of every distinct fingerprint, least id and rows included, and the links."""
    groups = prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    groups = stages.put(with_distances(groups), "groups")
    n = groups.count()
    links = stages.put(fingerprint_links(groups.select("fp", *NEAR), n, distance, run), "links")
    roots = components(links, stages)
    rooted = groups.drop(*NEAR).join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    return stages.put(rooted, "rooted"), links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3, run: int = RUN) -> DataFrame:
    """(id, fingerprint, component_id) of every row: hex digits, and the least id of its class.

    Null and empty texts have fingerprint 0, which links like any other. Rows
    that repeat are kept. A null id counts as no id; a class of null ids only
    has a null component. An empty table gives an empty result.
    """
    stages = Stages(docs.sparkSession)
    prints = stages.put(fingerprints(docs, id_col, text_col, shingle), "prints")
    rooted, links = _rooted(prints, stages, distance, run)
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
    named = skew_join(rooted, classes, "root", "size").select("fp", "component_id", "n")
    named = stages.put(named, "named")
    stages.drop(links)
    return skew_join(prints, named, "fp", "n").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                distance: int = 3, run: int = RUN) -> DataFrame:
    """Of each near-duplicate class one row, with all its columns.

    It is the row of least id, a null id after all others; of rows that share
    it, the one of least text hash. Rows are told apart by 128 bits of id and
    text, so rows alike in both are one row, and no other two are confused.
    ``docs`` is read twice: stage it.
    """
    stages = Stages(docs.sparkSession)
    whole = [F.col(id_col).isNull(), F.col(id_col), F.col(text_col)]
    first, second = F.xxhash64(*whole), F.xxhash64(F.lit(SEED), *whole)
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"),
                     first.alias("first"), second.alias("second"))
    prints = stages.put(fingerprints(docs.select(order.alias("row"), F.col(text_col).alias("text")), "row", "text", shingle),
                        "prints")
    rooted, links = _rooted(prints, stages, distance, run)
    kept = rooted.groupBy("root").agg(F.min("least").alias("least"))
    kept = stages.put(kept.select(F.col("least.first").alias("__first"), F.col("least.second").alias("__second")), "kept")
    stages.drop(links)
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    # One row per key is taken before the shuffle too, so copies of a row do not meet in one task.
    copies = Window.partitionBy("__first", "__second").orderBy(F.xxhash64("__first", *rest))
    rows = docs.withColumn("__first", first).withColumn("__second", second)
    rows = rows.withColumn("__copy", F.row_number().over(copies)).where("__copy = 1")
    return rows.join(kept, ["__first", "__second"], "left_semi").select(*docs.columns)


def expected_shared(n: int, masks: list[int]) -> float:
    """Strangers that a fingerprint meets per key, for random bits."""
    return n * math.pow(2.0, -min(m.bit_count() for m in masks))
