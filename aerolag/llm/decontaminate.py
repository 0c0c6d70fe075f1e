"""Benchmark decontamination by the q-gram lemma, verified by banded alignment.

An occurrence of a benchmark text of m characters with at most e edits shares
at least m - q + 1 - q * e of its q-grams, on diagonals (place in the document
minus place in the text) at most e apart. Shared q-grams are counted in bands of
2 e + 1 diagonals, of which each begins e + 1 after the last, so every
occurrence lies in one band. Bands below the bound hold no occurrence; the
others are aligned, and the region is kept if the edits stay in the budget.
q is 8, and less for texts so short that their edits could touch every q-gram of
8. Texts too short for an edit are looked up whole. Parts of a benchmark text do not count.

Documents are read once per block of benchmark texts, and never shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
EDIT_RATE = 0.1
# A block of the benchmark holds at most so many characters: the bound on what is broadcast.
BLOCK_CHARS = 2_000_000
SIEVE_BITS = 22
MIX = np.uint64(0x9E3779B97F4A7C15)
# A task handles so many bytes of documents, and so many candidates, at a time.
SLICE = 4_000_000
TOGETHER = 1024


def fold(text: str) -> np.ndarray:
    """One byte per code point: A-Z lowered, white space as blank, others by their low bits.

    Equal folded texts have equal codes, so codes lose no shared q-gram; the
    alignment compares the folded code points themselves.
    """
    points = fold_points(text)
    return np.where(points < 128, points, points & 127 | 128).astype(np.uint8)


def fold_points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    points = np.where((points >= 9) & (points <= 13), np.uint32(32), points)
    return np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Every q-gram as one number; q is at most 8."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    padded = np.concatenate([codes, np.zeros(8 - q, np.uint8)])
    wide = np.ndarray((len(codes) - q + 1,), "<u8", np.ascontiguousarray(padded), 0, (1,))
    return wide & np.uint64((1 << (8 * q)) - 1) if q < 8 else wide.copy()


def gram_size(m: int, rate: float = EDIT_RATE) -> int:
    """The longest q-gram, of at most 8, of which a text of m characters keeps one despite its edits."""
    return max(1, min(Q, m // (int(m * rate) + 1)))


def budget(m: int, rate: float = EDIT_RATE) -> tuple[int, int]:
    """(edits allowed, q-grams that must be shared) for a text of m characters.

    Short texts have shorter q-grams, so the bound selects at every length.
    """
    e, q = min(int(m * rate), max(0, m - 1)), gram_size(m, rate)
    return e, m - q + 1 - q * e


@dataclass
class Grams:
    """The q-grams of the texts that have one q, sorted, with where each occurs."""

    q: int
    keys: np.ndarray
    first: np.ndarray
    count: np.ndarray
    item: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    shift: np.uint64

    def passing(self, keys: np.ndarray) -> np.ndarray:
        """Which q-grams of a document may be among these."""
        return self.sieve[(keys * MIX) >> self.shift]


@dataclass
class Index:
    """One block of benchmark texts and their q-grams."""

    ids: list
    points: list[np.ndarray]
    edits: np.ndarray
    bound: np.ndarray
    grams: list[Grams]
    # Texts without edits shorter than a q-gram of 8: (length, sorted keys, their items) per length.
    short: list[tuple[int, np.ndarray, np.ndarray]]


def _gram_table(items: list[tuple[object, str]], mine: list[int], q: int) -> Grams:
    found = [grams(fold(items[i][1]), q) for i in mine]
    key = np.concatenate(found)
    item = np.repeat(np.array(mine, np.int32), [len(g) for g in found])
    place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in found])
    order = np.argsort(key, kind="stable")
    keys, first, count = np.unique(key[order], return_index=True, return_counts=True)
    bits = min(SIEVE_BITS, len(keys).bit_length() + 6)
    sieve, shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
    sieve[(keys * MIX) >> shift] = True
    return Grams(q, keys, first, count, item[order], place[order], sieve, shift)


def build_index(items: list[tuple[object, str]], rate: float = EDIT_RATE) -> Index:
    points = [fold_points(t) for _, t in items]
    limits = np.array([budget(len(p), rate) for p in points] or np.empty((0, 2)), np.int64).reshape(-1, 2)
    by_q: dict[int, list[int]] = {}
    whole: dict[int, list[int]] = {}
    for i, p in enumerate(points):
        if 0 < len(p) < Q and limits[i, 0] == 0:
            whole.setdefault(len(p), []).append(i)
        elif len(p):
            by_q.setdefault(gram_size(len(p), rate), []).append(i)
    short = []
    for m, mine in sorted(whole.items()):
        keys = np.concatenate([grams(fold(items[i][1]), m) for i in mine])
        by_key = np.argsort(keys, kind="stable")
        short.append((m, keys[by_key], np.array(mine, np.int64)[by_key]))
    tables = [_gram_table(items, mine, q) for q, mine in sorted(by_q.items())]
    return Index([i for i, _ in items], points, limits[:, 0], limits[:, 1], tables, short)


def align(index: Index, whole: np.ndarray, item: np.ndarray, offset: np.ndarray, lo: np.ndarray,
          hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edits, start, end) of the best occurrence of each candidate's text inside lo .. hi.

    Candidate c is aligned on diagonals offset[c] .. offset[c] + 2 e + 1 only. All
    candidates advance together, one text character at a time, and leave when
    their text ends or no cell is within the budget (edits -1). An occurrence
    may begin on any diagonal of the band; each cell carries where its path began.
    """
    sizes = np.array([len(index.points[i]) for i in item], np.int64)
    limit = index.edits[item]
    edits, start, end = (np.full(len(item), -1, np.int64) for _ in range(3))
    width = 2 * int(limit.max(initial=0)) + 2
    letters = np.zeros((len(item), int(sizes.max(initial=0))), np.uint32)
    for c, i in enumerate(item):
        letters[c, :sizes[c]] = index.points[i]
    live = np.arange(len(item))
    diagonal = np.arange(width)
    big = 1 << 20
    begin = offset[:, None] + diagonal
    cost = np.where((begin >= lo[:, None]) & (begin <= hi[:, None]) & (diagonal < 2 * limit[:, None] + 2), 0, big)
    for i in range(letters.shape[1] + 1):
        best = cost.min(axis=1)
        done = sizes[live] == i
        for c in np.flatnonzero(done & (best <= limit[live])):
            d = int(cost[c].argmin())
            edits[live[c]], start[live[c]], end[live[c]] = best[c], begin[c, d], offset[live[c]] + d + i
        stay = ~done & (best <= limit[live])
        if not stay.all():
            live, cost, begin = live[stay], cost[stay], begin[stay]
        if not len(live):
            break
        at = offset[live][:, None] + diagonal + i  # document character that each diagonal meets
        first, last = lo[live][:, None], hi[live][:, None]
        inside = (at >= first) & (at < last)
        same = inside & (whole[np.clip(at, 0, len(whole) - 1)] == letters[live, i][:, None])
        step = np.where(inside, cost + ~same, big)
        # a text character without partner comes from the next diagonal
        skip = np.full_like(cost, big)
        skip[:, :-1] = cost[:, 1:] + 1
        origin = np.where(skip < step, np.roll(begin, -1, axis=1), begin)
        new = np.minimum(skip, step)
        # document characters without partner come from lower diagonals: a running minimum
        slack = new - diagonal
        low = np.minimum.accumulate(slack, axis=1)
        source = np.maximum.accumulate(np.where(slack == low, diagonal, 0), axis=1)
        cost = low + diagonal
        cost[(at + 1 < first) | (at + 1 > last) | (diagonal >= 2 * limit[live][:, None] + 2)] = big
        begin = np.take_along_axis(origin, source, axis=1)
    return edits, start, end


def regions(codes: np.ndarray, owner: np.ndarray, index: Index) -> np.ndarray:
    """Rows (item, lowest diagonal of a band, shared q-grams) that meet the bound.

    ``codes`` holds several documents one after the other, ``owner`` each
    code's document; a q-gram across two documents does not count.
    """
    found = [_regions(codes, owner, index, table) for table in index.grams if len(codes) >= table.q]
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def _regions(codes: np.ndarray, owner: np.ndarray, index: Index, table: Grams) -> np.ndarray:
    mine = grams(codes, table.q)
    at = np.flatnonzero(table.passing(mine))
    at = at[owner[at] == owner[at + table.q - 1]]
    slot = np.searchsorted(table.keys, mine[at])
    slot[slot == len(table.keys)] = 0
    hit = table.keys[slot] == mine[at]
    at, slot = at[hit], slot[hit]
    out = []
    for lo in range(0, len(at), 1_000_000):  # frequent q-grams occur in many texts
        out.append(_expand(at[lo:lo + 1_000_000], slot[lo:lo + 1_000_000], index, table, len(codes)))
    if not out:
        return np.empty((0, 3), np.int64)
    keys = np.concatenate([k for k, _ in out])
    counts = np.concatenate([c for _, c in out])
    merged, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, counts, len(merged)).astype(np.int64)
    span = _span(len(codes), index)
    item, band = merged // span, merged % span
    kept = total >= index.bound[item]
    item, band = item[kept], band[kept]
    lowest = band * (index.edits[item] + 1) - _shift(index)
    return np.stack([item, lowest, total[kept]], axis=1)


def _shift(index: Index) -> int:
    return int(max((len(p) for p in index.points), default=0)) + 2 * int(index.edits.max(initial=0)) + 2


def _span(n: int, index: Index) -> int:
    return n + 2 * _shift(index) + 2


def _expand(at: np.ndarray, slot: np.ndarray, index: Index, table: Grams, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared q-grams as counts per (item, band); a diagonal lies in up to two bands."""
    times = table.count[slot]
    total = int(times.sum())
    inner = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
    where = np.repeat(table.first[slot], times) + inner
    item = table.item[where].astype(np.int64)
    diagonal = np.repeat(at, times) - table.place[where] + _shift(index)
    band = diagonal // (index.edits[item] + 1)
    key = item * _span(n, index) + band
    both = np.concatenate([key, key - 1])  # a band covers its own step and the next
    keys, counts = np.unique(both, return_counts=True)
    return keys, counts


def short_hits(whole: np.ndarray, codes: np.ndarray, owner: np.ndarray, index: Index) -> Iterator[tuple[int, int, int]]:
    """(item, start, end) of every place where a text shorter than a q-gram stands, without edits."""
    for m, keys, items in index.short:
        mine = grams(codes, m)
        at = np.flatnonzero(owner[:len(mine)] == owner[m - 1:])
        low, high = np.searchsorted(keys, mine[at]), np.searchsorted(keys, mine[at], "right")
        times = high - low
        total = int(times.sum())
        inner = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        place, item = np.repeat(at, times), items[np.repeat(low, times) + inner]
        letters = np.zeros((len(index.points), m), np.uint32)
        for i in set(items.tolist()):
            letters[i] = index.points[i]
        same = (whole[place[:, None] + np.arange(m)] == letters[item]).all(axis=1)
        for i, p in zip(item[same].tolist(), place[same].tolist()):
            yield i, p, p + m


def occurrences(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(document, item, start, end, edits) of every occurrence in a few documents.

    Start and end are code points. Of occurrences of one item that overlap, the
    one with fewest edits, then the first, is reported.
    """
    points = [fold_points(t) for t in texts]
    lengths = np.array([len(p) for p in points], np.int64)
    ends = np.cumsum(lengths)
    whole = np.concatenate(points) if points else np.empty(0, np.uint32)
    codes = np.where(whole < 128, whole, whole & 127 | 128).astype(np.uint8)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    wanted = []
    for item, lowest, _ in regions(codes, owner, index).tolist():
        size, e = len(index.points[item]), int(index.edits[item])
        # A band may touch several documents; each is aligned by itself.
        first = min(max(lowest, 0), len(whole) - 1)
        last = min(max(lowest + 3 * e + 1 + size, 0), len(whole) - 1)
        for doc in range(int(owner[first]), int(owner[last]) + 1):
            wanted.append((size, doc, item, lowest, int(ends[doc] - lengths[doc]), int(ends[doc])))
    wanted.sort()  # texts of like length advance together
    found = []
    for k in range(0, len(wanted), TOGETHER):
        _, doc, item, lowest, lo, hi = np.array(wanted[k:k + TOGETHER], np.int64).T
        edits, start, end = align(index, whole, item, lowest, lo, hi)
        got = edits >= 0
        found += zip(doc[got].tolist(), item[got].tolist(), (start - lo)[got].tolist(), (end - lo)[got].tolist(),
                     edits[got].tolist())
    for item, start, end in short_hits(whole, codes, owner, index):
        doc = int(owner[start])
        before = int(ends[doc] - lengths[doc])
        found.append((doc, item, start - before, end - before, 0))
    found.sort(key=lambda x: (x[0], x[1], x[4], x[2]))
    kept: list[tuple[int, int, int, int, int]] = []
    starts: list[int] = []  # of what is kept for the current document and item, which never overlaps
    ends_at: list[int] = []
    for x in found:
        if not kept or kept[-1][:2] != x[:2]:
            starts, ends_at = [], []
        place = bisect_left(starts, x[3])
        if not place or ends_at[place - 1] <= x[2]:
            starts.insert(place, x[2])
            ends_at.insert(place, x[3])
            kept.append(x)
    return kept


def _blocks(bench: DataFrame, id_col: str, text_col: str, chars: int) -> Iterator[list[tuple[object, str]]]:
    """Benchmark texts in blocks of bounded size, fetched one after the other."""
    block, size = [], 0
    rows = bench.where(F.length(text_col) > 0).select(id_col, text_col).orderBy(id_col, text_col)
    for row in rows.toLocalIterator():
        if block and size + len(row[1]) > chars:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += len(row[1])
    if block:
        yield block


def find_passages(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, start, end, edits, item_chars): benchmark texts that occur in documents.

    One row per occurrence, in code points, end exclusive; documents without
    any give none. Null texts hold nothing; benchmark texts that are null or
    empty are not searched, and those whose length times ``rate`` is below one
    are found without edits. Rows that repeat on either side are reported each. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    id_kind = docs.schema[id_col].dataType.simpleString()
    item_kind = bench.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {id_kind}, `{item_col}` {item_kind}, start int, `end` int, edits int, item_chars int"
    narrow = docs.select(F.col(id_col), F.col(text_col))
    out = spark.createDataFrame([], schema)
    for block in _blocks(bench, item_col, "text", block_chars):
        shared = spark.sparkContext.broadcast(build_index(block, rate))
        names = [id_col, item_col, "start", "end", "edits", "item_chars"]
        out = out.unionByName(narrow.mapInArrow(_search(shared, names), schema))
    return out


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a column in slices of whole documents, each about SLICE bytes at most."""
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts], np.int64)
    at = 0
    while at < len(sizes):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), SLICE)))
        yield at, [t or "" for t in texts[at:end].to_pylist()]
        at = end


def _search(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ids = batch.column(0)
            for at, part in _slices(batch.column(1)):
                rows = occurrences(part, index)
                if rows:
                    doc, item, start, end, edits = (list(c) for c in zip(*rows))
                    sizes = [len(index.points[i]) for i in item]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([at + d for d in doc], pa.int64())), pa.array([index.ids[i] for i in item]),
                         *[pa.array(c, pa.int32()) for c in (start, end, edits, sizes)]], names=names)

    return run


def _without_hits(shared, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for at, part in _slices(batch.column(place)):
                for doc, *_ in occurrences(part, shared.value):
                    clean[at + doc] = False
            yield batch.filter(pa.array(clean))

    return run


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents in which no benchmark text occurs, with all their columns; no shuffle.

    Null texts stay, repeated rows stay or go together.
    """
    out, place = docs, docs.columns.index(text_col)
    for block in _blocks(bench, item_col, "text", block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(build_index(block, rate))
        out = out.mapInArrow(_without_hits(shared, place), docs.schema)
    return out
