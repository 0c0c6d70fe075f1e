"""Packing documents into sequences: cutting stock by column generation.

A document's token ids and one closing id are cut into full pieces, one
sequence each, and a rest. The rests are the stock problem: how many sequences
of which pattern (so many rests of each length class) hold them all. A linear
program over patterns says how often each is used; patterns enter it one by one,
priced by a knapsack over the program's dual values. Its solution is rounded
down, the few rests that remain are packed first-fit by falling length, and the
ranked rests of each class are dealt to the patterns' places.

The program sees only a histogram of classes, whose size does not depend on
the corpus. Ranks and offsets are computed where the rows are.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolag.llm.common import numbered, partitions, tokenizer_path
from aerolag.sources.stage import Stages

CAPACITY = 1024
# Lengths above FINE are rounded up to classes of so many tokens; the rounding is the padding that a full pattern may
# keep. Shorter ones, on which it would weigh most, are classes of their own.
GRAIN = 4
FINE = 64
CLOSING = 0
# The program may stop this close to its lower bound, or after so many patterns.
GAP = 5e-4
TURNS = 2000
# The vocabulary's published split pattern (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokenizer:
    """Ids of the public byte-level vocabulary, as ``tokenizers`` gives them without added special tokens.

    The same vocabulary is published for two libraries. The rank file's library
    is about four times faster and gives the same ids, but for strings that the
    vocabulary names as tokens of their own (``marks``). Texts that hold one, and
    texts that it cannot take, go to the other.
    """

    def __init__(self, json_path: str, ranks_path: str, marks: list[str]):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.slow, self.marks = json_path, None, marks

    def ids(self, text: str) -> np.ndarray:
        if any(m in text for m in self.marks):
            return self.plain(text)
        try:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
        except ValueError:  # its matcher gives up on some very long runs
            return self.plain(text)

    def plain(self, text: str) -> np.ndarray:
        if self.slow is None:
            from tokenizers import Tokenizer as Plain

            self.slow = Plain.from_file(self.json_path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def marks(json_path: str) -> list[str]:
    """Strings that a vocabulary names as tokens of their own."""
    with open(json_path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def _cut(json_path: str, ranks_path: str, capacity: int, with_ids: bool):
    special = marks(json_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(json_path, ranks_path, special)
        for batch in batches:
            owner, starts, lengths, sums, totals, pieces = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.append(tokenizer.ids(text.as_py() or ""), np.uint32(CLOSING)).astype("<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at:at + capacity]
                    owner.append(row)
                    starts.append(at)
                    lengths.append(len(piece))
                    sums.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(ids))
                    if with_ids:
                        pieces.append(piece.astype(np.int32))
            cols = [batch.column(0).take(pa.array(owner, pa.int64())),
                    *[pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(pieces, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
               json_path: str | None = None, ranks_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]) per piece of every document."""
    json_path = json_path or tokenizer_path("byte_bpe_50k.json")
    ranks_path = ranks_path or tokenizer_path("byte_bpe_50k.tiktoken")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut(json_path, ranks_path, capacity, with_ids), schema)


def price(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern that fits: (value, copies of each class). ``sizes`` rises."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], last[c] = best[c - 1], -1
        if fits[c]:
            options = best[c - sizes[:fits[c]]] + value[:fits[c]]
            top = int(options.argmax())
            if options[top] > best[c] + 1e-12:
                best[c], last[c] = options[top], top
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(best[capacity]), pattern


def first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """One pattern per class, and how often each is used, that meet the demand exactly.

    The longest class that is left is filled up with the longest that still fit,
    and the pattern is repeated until a class runs out. The pattern of a class
    that ran out holds no class that ran out before, so they are independent.
    """
    left, basis, use = demand.astype(float).copy(), np.zeros((len(sizes), len(sizes)), np.int64), np.zeros(len(sizes))
    open_classes = list(range(len(sizes)))
    for column in range(len(sizes)):
        pattern, room, top = np.zeros(len(sizes), np.int64), capacity, len(open_classes) - 1
        while top >= 0:
            k = open_classes[top]
            copies = min(room // int(sizes[k]), max(1, int(left[k])) if room == capacity else int(left[k]))
            pattern[k], room = copies, room - copies * int(sizes[k])
            top -= 1
        held = np.flatnonzero(pattern)
        lasts = left[held] / pattern[held]
        gone = int(held[lasts.argmin()])
        basis[:, column], use[column] = pattern, lasts.min()
        left[held] = np.maximum(left[held] - lasts.min() * pattern[held], 0)
        left[gone] = 0
        open_classes.remove(gone)
    return basis, use


def invert(matrix: np.ndarray) -> np.ndarray:
    """Inverse of a small matrix in one thread; threaded linear algebra stalls on a busy driver."""
    n = len(matrix)
    work = np.hstack([matrix.astype(float), np.eye(n)])
    for k in range(n):
        best = k + int(np.abs(work[k:, k]).argmax())
        if best != k:
            work[[k, best]] = work[[best, k]]
        work[k] /= work[k, k]
        others = np.flatnonzero(work[:, k])
        others = others[others != k]
        work[others] -= np.outer(work[others, k], work[k])
    return work[:, n:]


def times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", matrix, vector)


def fractional_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP,
                        turns: int = TURNS) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear program uses them, by column generation.

    Revised simplex on "use each class as often as demanded with fewest
    sequences". Stops at the optimum, when a dual bound shows that at most ``gap``
    is left to gain, or after ``turns`` patterns; any stop is a right solution.
    """
    basis, use = first_basis(sizes, demand, capacity)
    inverse, bound = invert(basis), float((sizes * demand).sum()) / capacity
    for turn in range(1, turns + 1):
        if turn % 200 == 0:  # rounding errors of many updates
            inverse = invert(basis)
            use = np.maximum(times(inverse, demand), 0)
        dual = np.maximum(inverse.sum(axis=0), 0)
        worth, pattern = price(sizes, dual, capacity)
        bound = max(bound, float((dual * demand).sum()) / worth)
        if worth <= 1 + 1e-9 or use.sum() <= bound * (1 + gap):
            break
        column = times(inverse, pattern.astype(float))
        rising = np.flatnonzero(column > 1e-9)
        ratio = use[rising] / column[rising]
        leave = int(rising[ratio.argmin()])
        step = use[leave] / column[leave]
        use = np.maximum(use - step * column, 0)
        use[leave] = step
        row = inverse[leave] / column[leave]
        inverse -= np.outer(column, row)
        inverse[leave] = row
        basis[:, leave] = pattern
    return [(basis[:, j].copy(), float(use[j])) for j in range(len(sizes)) if use[j] > 1e-9]


def first_fit(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns that hold the given counts, longest first into the first that has room."""
    room, out = [], []
    for k in np.argsort(-sizes):
        at = 0
        for _ in range(int(counts[k])):
            while at < len(room) and room[at] < sizes[k]:
                at += 1
            if at == len(room):
                room.append(capacity)
                out.append(np.zeros(len(sizes), np.int64))
            room[at] -= int(sizes[k])
            out[at][k] += 1
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern {class: copies}, times used) that hold exactly the histogram's rests."""
    sizes = np.array(sorted(c for c, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    left, used = demand.copy(), []
    for pattern, share in fractional_patterns(sizes, demand.astype(float), capacity):
        whole = int(share + 1e-6)
        fits = pattern > 0
        whole = min(whole, int((left[fits] // pattern[fits]).min()))
        if whole:
            left -= whole * pattern
            used.append((pattern, whole))
    used += [(p, 1) for p in first_fit(sizes, left, capacity)]
    return [({int(sizes[k]): int(p[k]) for k in np.flatnonzero(p)}, n) for p, n in used]


def _places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first rank, rank after the last, copies, first sequence, first place) per class of each pattern."""
    rows, dealt, sequence = [], {}, 0
    for pattern, n in patterns:
        place = 0
        for size, copies in sorted(pattern.items(), reverse=True):
            first = dealt.get(size, 0)
            dealt[size] = first + copies * n
            rows.append((size, first, dealt[size], copies, sequence, place))
            place += copies
        sequence += n
    return rows


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN, fine: int = FINE) -> DataFrame:
    """Add sequence_id and offset to a staged table of pieces (id, start, length, ...)."""
    spark = pieces.sparkSession
    rounded = F.least(F.ceil(F.col("length") / F.lit(grain)) * F.lit(grain), F.lit(capacity))
    classed = pieces.withColumn("__class", F.when(F.col("length") <= fine, F.col("length")).otherwise(rounded).cast("int"))
    histogram = {r["__class"]: r["n"] for r in classed.groupBy("__class").agg(F.count("*").alias("n")).collect()}
    kind = "__c int, __from long, __to long, __copies int, __sequence long, __place int"
    places = spark.createDataFrame(_places(plan(histogram, capacity)), kind)
    ranked = numbered(classed, ["__class"], ["id", "start", "ids_crc32"], "__rank", partitions(spark))
    # At most a few rows per class and pattern, whatever the corpus.
    here = (F.col("__class") == F.col("__c")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    within = F.col("__rank") - F.col("__from")
    dealt = ranked.join(F.broadcast(places), here).select(
        *pieces.columns,
        (F.col("__sequence") + F.floor(within / F.col("__copies"))).cast("long").alias("sequence_id"),
        (F.col("__place") + within % F.col("__copies")).alias("__place"),
    )
    before = Window.partitionBy("sequence_id").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("__place")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece.

    A null or empty text is its closing id alone. Rows that repeat, and null
    ids, are packed like any other. An empty table gives an empty result.
    """
    pieces = cut_pieces(docs, id_col, text_col, capacity, json_path, ranks_path)
    pieces = Stages(docs.sparkSession).put(pieces, "pieces")
    return pack_pieces(pieces, capacity).withColumnRenamed("id", id_col)


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids) with the token ids themselves, padded with the closing id up to ``capacity``."""
    pieces = Stages(docs.sparkSession).put(cut_pieces(docs, id_col, text_col, capacity, with_ids=True), "pieces")
    packed = pack_pieces(pieces, capacity)
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    return parts.select("sequence_id", F.concat(
        ids, F.array_repeat(F.lit(CLOSING), F.lit(capacity) - F.size(ids))).alias("ids"))
