"""Exact top-k search by inner product, with a uniform threshold in three phases.

A vector is cut into LISTS equal runs of components. For a query, run j gives
every row a partial score, which makes one score list per run; a row's score is
the sum over the lists.

1. Each cell (a block of queries against a block of rows) takes the k best
   entries of each of its lists. The scores of the rows found there are exact,
   so the k-th best over all cells is reached by k rows: a safe cutoff.
2. The cutoff goes back to the query's cells. A row that reaches it has an entry
   of at least cutoff / LISTS in some list. Those entries are collected; the
   ones not collected are below that threshold, which bounds the row's score
   from above. Rows whose bound stays below the cutoff are done.
3. For the rows left, the missing entries are looked up, the exact score
   decides, and the k best over all cells are the result.

The lists of a block of rows lie together, so entries of one row meet without
a shuffle: only queries, rows, cutoffs and at most k rows per query and cell
move. Queries and rows are dealt to cells by row number, so copies and repeated
ids spread evenly. Nothing is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolag.llm.vectors import integer_vectors, largest, matrix
from aerolag.sources.stage import Stages

LISTS = 4
# Queries and rows that meet in one cell.
QUERY_BLOCK, ROW_BLOCK = 4096, 8192
# Partitions at most; further cells share them and are still one group each.
MOST_TASKS = 20_000
# Queries of a cell that are scored at once; a score matrix then has 2 million entries.
CHUNK = 256

NONE = -np.inf  # the score of a row that is no candidate of a query


def _exact(q: np.ndarray, x: np.ndarray) -> type:
    """The fastest number type in which all inner products of two matrices are exact."""
    bound = q.shape[1] * largest(q) * largest(x)
    if bound < 1 << 24:
        return np.float32
    if bound < 1 << 53:
        return np.float64
    raise ArithmeticError("inner products of these vectors pass 2**53; use a smaller scale")


def _chunks(q: np.ndarray, q_row: np.ndarray, x: np.ndarray, x_row: np.ndarray, lists: int):
    """(slice of queries, partial scores by list); a query's own row scores NONE in every list."""
    kind = _exact(q, x)
    q, x = q.astype(kind), x.astype(kind)
    order = np.argsort(x_row)
    at = np.minimum(np.searchsorted(x_row, q_row, sorter=order), len(x_row) - 1)
    place = order[at]
    own = x_row[place] == q_row
    runs = np.array_split(np.arange(q.shape[1]), lists)
    for start in range(0, len(q), CHUNK):
        part = slice(start, min(start + CHUNK, len(q)))
        scores = [q[part][:, run] @ x[:, run].T for run in runs]
        mine = np.flatnonzero(own[part])
        for s in scores:
            s[mine, place[part][mine]] = NONE
        yield part, scores


def list_heads(q: np.ndarray, q_row: np.ndarray, x: np.ndarray, x_row: np.ndarray, k: int, lists: int):
    """Phase 1 in a cell: (query index, score) of the at most k best rows among the heads of its lists."""
    found_q, found_s = [], []
    for part, scores in _chunks(q, q_row, x, x_row, lists):
        n = scores[0].shape[1]
        if n > k:
            heads = np.concatenate([np.argpartition(s, n - k, axis=1)[:, n - k:] for s in scores], axis=1)
        else:
            heads = np.broadcast_to(np.arange(n), (scores[0].shape[0], n))
        heads = np.sort(heads, axis=1)
        totals = sum(np.take_along_axis(s, heads, axis=1).astype(np.float64) for s in scores)
        totals[:, 1:][heads[:, 1:] == heads[:, :-1]] = NONE  # the head of several lists counts once
        best = -np.sort(-totals, axis=1)[:, :k]
        which, place = np.nonzero(best > NONE)
        found_q.append(which + part.start)
        found_s.append(best[which, place])
    return np.concatenate(found_q), np.concatenate(found_s).astype(np.int64)


def sufficient(scores: list[np.ndarray], cutoff: np.ndarray) -> np.ndarray:
    """Phase 2: which (query, row) can still reach the query's cutoff, by its collected entries alone."""
    m = len(scores)
    threshold = np.ceil(cutoff / m)[:, None].astype(scores[0].dtype)
    bound = np.zeros_like(scores[0])
    some = np.zeros(scores[0].shape, bool)
    for s in scores:
        collected = s >= threshold
        some |= collected
        # An entry that was not collected is a whole number below the threshold.
        bound += np.where(collected, s, threshold - 1)
    return some & (bound >= cutoff[:, None])


def resolve(q: np.ndarray, q_row: np.ndarray, cutoff: np.ndarray, x: np.ndarray, x_row: np.ndarray,
            ids: np.ndarray, k: int, lists: int):
    """Phases 2 and 3 in a cell: (query index, row index, score) of its at most k best rows per query.

    ``ids`` are the rows' ranks by id; a query without a cutoff (minus
    infinity) has too few rows anywhere, so all its rows count.
    """
    found = []
    for part, scores in _chunks(q, q_row, x, x_row, lists):
        limit = cutoff[part]
        known = np.isfinite(limit)
        left = sufficient(scores, np.where(known, limit, 0.0)) | ~known[:, None]
        which, row = np.nonzero(left)
        total = sum(s[which, row].astype(np.float64) for s in scores)
        keep = (total > NONE) & (total >= limit[which])
        which, row, total = which[keep], row[keep], total[keep]
        order = np.lexsort((ids[row], -total, which))
        which, row, total = which[order], row[order], total[order]
        first = np.searchsorted(which, which)  # where the rows of a query begin
        top = np.arange(len(which)) - first < k
        found.append((which[top] + part.start, row[top], total[top].astype(np.int64)))
    return tuple(np.concatenate(column) for column in zip(*found))


def _cells(df: DataFrame, mine: str, other: str, blocks: int, others: int) -> DataFrame:
    """Each row in one of ``blocks`` blocks, once for each block of the other side."""
    return df.withColumns({
        mine: F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"),
        other: F.explode(F.sequence(F.lit(0), F.lit(others - 1))),
    })


def _in_cells(queries: DataFrame, rows: DataFrame, shape: tuple[int, int], work: Callable, schema: str) -> DataFrame:
    """Apply ``work`` to every cell; each is one group, cells of one partition run one after another."""
    q_blocks, x_blocks = shape
    keys = ["dim", "q_block", "x_block"]
    # Few bytes make much work here, so partitions are counted by cells and not left to their sizes.
    tasks = min(q_blocks * x_blocks, MOST_TASKS)
    left = _cells(queries, "q_block", "x_block", q_blocks, x_blocks).repartition(tasks, *keys)
    right = _cells(rows, "x_block", "q_block", x_blocks, q_blocks).repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 64, lists: int = LISTS, query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, id, score): for each row that meets ``is_query``, its k best other rows.

    Components become floor(scale * x); the score is the inner product. Ties go
    to the smaller id, a null id comes last. Vectors that are null or hold null
    or non-finite components take no part; a vector meets only vectors of its
    own length. Repeated rows are rows of their own: only the query's own row is
    left out, and a repeated query is answered as often as it occurs. A query
    with fewer than k other rows gets all of them. Other columns are not read.
    An empty table or one without queries gives an empty result.
    """
    stages = Stages(df.sparkSession)
    marked = df.withColumn("__query", F.coalesce(is_query, F.lit(False)))
    rows = stages.put(
        integer_vectors(marked, id_col, vector_col, scale, "__query")
        .withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()}), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if("__query")).first()
    shape = max(1, -(-n_queries // query_block)), max(1, -(-n // row_block))
    # New columns for one side, or the two sides of a cell could not be told apart.
    queries = rows.where("__query").select(*[F.col(c).alias(c) for c in ("row", "id", "dim", "v")])
    rows = rows.select("row", "id", "dim", "v")

    def heads(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"row": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        q, x, q_row, x_row = _pair(left, right)
        which, score = list_heads(q, q_row, x, x_row, k, lists)
        return pa.table({"row": q_row[which], "score": score})

    def answers(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {c: pa.array([], pa.int64()) for c in ("row", "query_id", "id", "score")}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        q, x, q_row, x_row = _pair(left, right)
        cutoff = left["cutoff"].combine_chunks().cast(pa.float64()).fill_null(NONE).to_numpy(zero_copy_only=False)
        ids = right["id"].combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        # Ids up to 2**63 do not fit a double, so rows are compared by the rank of their id.
        rank = np.where(known, np.unique(ids.fill_null(0).to_numpy(), return_inverse=True)[1], len(ids))
        which, row, score = resolve(q, q_row, cutoff, x, x_row, rank, k, lists)
        return pa.table({"row": q_row[which], "query_id": left["id"].combine_chunks().take(pa.array(which)),
                         "id": ids.take(pa.array(row)), "score": score})

    best = Window.partitionBy("row").orderBy(F.desc("score"))
    cutoffs = (
        _in_cells(queries, rows, shape, heads, "row long, score long")
        .withColumn("__n", F.row_number().over(best)).where(F.col("__n") <= k).where(F.col("__n") == k)
        .select("row", F.col("score").alias("cutoff"))
    )
    cutoffs = stages.put(cutoffs, "cutoffs")
    informed = queries.join(cutoffs, "row", "left")
    found = _in_cells(informed, rows, shape, answers, "row long, query_id long, id long, score long")
    rank = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (
        found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )


def _pair(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    width = left["dim"][0].as_py()
    return (matrix(left["v"], width), matrix(right["v"], width), left["row"].to_numpy(), right["row"].to_numpy())


def every(id_col: str, step: int) -> Column:
    """Rows whose id is divisible by ``step``."""
    return F.col(id_col) % step == 0


ORACLE = """
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM kept q JOIN kept c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
