"""Vector codes: a product quantizer whose codebooks are fitted by ball k-means.

Every vector is cut into parts; part position p has a codebook of entries. The
parts assigned to an entry form its ball. Between rounds:

* the radius of a ball bounds which entries can be its neighbours: an entry
  further from the ball's own than twice the radius is nearest to no part in it;
* a part no further from its entry than half the way to the nearest neighbour
  lies in the stable core and stays without any distance to other entries;
* the other parts lie in rings around the core. Neighbours are sorted by their
  distance, and a part in ring j is compared with the first j of them only;
* a ball whose entry and neighbours did not move since the last round is left
  as it is.

All of this is decided in squared whole numbers, so the result is that of
comparing every part with every entry, ties included.

Rows are assigned in tasks, each on its own; sums per entry are a grouped
aggregate. Only codebooks and those sums (entries x parts rows, whatever the
table's size) pass through the driver. Each round's assignment is a stage table,
so a lost executor costs one round's tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import partitions, skew_join
from aerolag.llm.vectors import integer_vectors, largest, matrix
from aerolag.sources.stage import Stages

BATCH = 4096  # parts compared with a codebook at once


@dataclass
class Balls:
    """Codebooks and what is known of the balls around their entries before an assignment."""

    entries: np.ndarray  # parts x entries x width, whole numbers
    radius: np.ndarray | None = None  # parts x entries: no part of the ball lies further out
    moved: np.ndarray | None = None  # parts x entries: whether the entry is new since the last assignment

    def neighbours(self, part: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Per entry of a part: its neighbours by distance, their squared distances, and whether all is still."""
        entries = self.entries[part].astype(np.float64)
        apart = squared(entries, entries)
        # Rounding up keeps every neighbour; a spare one does no harm.
        reach = 4 * np.ceil(self.radius[part] * (1 + 1e-9) + 1e-6) ** 2
        near, distance, still = [], [], np.zeros(len(entries), bool)
        for e in range(len(entries)):
            order = np.argsort(apart[e], kind="stable")
            order = order[(order != e) & (apart[e][order] <= reach[e])]
            near.append(order)
            distance.append(apart[e][order])
            still[e] = not self.moved[part][e] and not self.moved[part][order].any()
        return near, distance, still


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries; exact, since no value passes 2**53."""
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]


def check_size(entries: np.ndarray, x: np.ndarray) -> None:
    width = entries.shape[-1]
    if 4 * max(1, width) * max(largest(entries), largest(x)) ** 2 >= 1 << 53:
        raise ArithmeticError("squared distances of these vectors pass 2**53; use a smaller scale")


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the entry nearest to each row, from all entries; ties to the lower index."""
    entries = entries.astype(np.float64)
    index, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for start in range(0, len(x), BATCH):
        rows = slice(start, start + BATCH)
        d = squared(x[rows].astype(np.float64), entries)
        index[rows] = d.argmin(1)
        distance[rows] = d[np.arange(len(d)), index[rows]]
    return index, distance


def settle(x: np.ndarray, balls: Balls, part: int, index: np.ndarray, distance: np.ndarray,
           tables: tuple) -> tuple[np.ndarray, np.ndarray, int]:
    """Assignment of a part's rows after the entries moved, and how many distances to other entries it took.

    ``index`` and ``distance`` are the last assignment's; ``tables`` is ``balls.neighbours(part)``.
    """
    near, apart, still = tables
    entries = balls.entries[part].astype(np.float64)
    count = len(entries)
    index, distance = index.copy(), distance.copy()
    todo = np.flatnonzero(~still[index])
    rows = x[todo].astype(np.float64)
    own = ((rows - entries[index[todo]]) ** 2).sum(1)
    distance[todo] = own
    by_entry = np.argsort(index[todo], kind="stable")
    bounds = np.searchsorted(index[todo][by_entry], np.arange(count + 1))
    compared = 0
    for e in range(count):
        members = by_entry[bounds[e]:bounds[e + 1]]
        if not len(members) or not len(near[e]):
            continue
        # Entry c can be as near as the own one only if |own - c| <= 2 |x - own|.
        ring = np.searchsorted(apart[e], 4 * own[members], side="right")
        members, ring = members[ring > 0], ring[ring > 0]
        # Rings of similar size are compared together; the outermost sets the number of neighbours.
        size = np.ceil(np.log2(ring)).astype(int)
        for s in np.unique(size):
            at = members[size == s]
            others = near[e][:ring[size == s].max()]
            d = squared(rows[at], entries[others])
            compared += d.size
            # Ordered by distance and then index, in one number.
            best = (d.astype(np.int64) * count + others).min(1)
            best = np.minimum(best, own[at].astype(np.int64) * count + e)
            index[todo[at]] = best % count
            distance[todo[at]] = best // count
    return index, distance, compared


def assign(rows: DataFrame, balls: Balls) -> DataFrame:
    """Rows with the entries nearest to their parts: codes and squared distances."""
    parts, _, width = balls.entries.shape
    first = balls.radius is None
    keep = [c for c in rows.columns if c not in ("codes", "distances")]
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*[f"`{c}` {fields[c]}" for c in keep], "codes array<int>", "distances array<bigint>"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None if first else [balls.neighbours(p) for p in range(parts)]
        for batch in batches:
            n = batch.num_rows
            x = matrix(batch.column("v"), parts * width)
            check_size(balls.entries, x)
            index, distance = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
            if not first:
                old, far = matrix(batch.column("codes"), parts), matrix(batch.column("distances"), parts)
            for p in range(parts):
                mine = x[:, p * width:(p + 1) * width]
                if first:
                    index[:, p], distance[:, p] = nearest(mine, balls.entries[p])
                else:
                    index[:, p], distance[:, p], _ = settle(mine, balls, p, old[:, p], far[:, p], tables[p])
            at = pa.array(np.arange(0, (n + 1) * parts, parts), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep],
                 pa.ListArray.from_arrays(at, pa.array(index.ravel().astype(np.int32))),
                 pa.ListArray.from_arrays(at, pa.array(distance.ravel()))],
                names=[*keep, "codes", "distances"])

    return rows.mapInArrow(work, schema)


def moved_balls(assigned: DataFrame, balls: Balls) -> Balls:
    """The next codebooks: each entry becomes its parts' mean, rounded down; unused entries stay.

    The new radius is bounded by the old one plus the way the entry moved.
    """
    parts, count, width = balls.entries.shape
    pieces = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.struct(
        p.alias("part"), F.get("codes", p).alias("entry"), F.get("distances", p).alias("distance"),
        F.slice("v", p * width + 1, width).alias("x")))
    sums = (
        assigned.select(F.explode(pieces).alias("a")).groupBy("a.part", "a.entry")
        .agg(F.count("*").alias("n"), F.max("a.distance").alias("far"),
             F.array(*[F.sum(F.get("a.x", F.lit(i))) for i in range(width)]).alias("sums"))
        .collect()  # at most parts x entries rows
    )
    entries = balls.entries.copy()
    radius = np.zeros((parts, count))
    for r in sums:
        entries[r.part, r.entry] = [s // r.n for s in r.sums]
        radius[r.part, r.entry] = np.sqrt(r.far)
    step = np.sqrt(((entries - balls.entries).astype(np.float64) ** 2).sum(2))
    return Balls(entries, radius + step, step > 0)


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every vector that takes part.

    Components become floor(scale * x). Rows whose vector is null or holds null
    or non-finite components are left out, and so are those whose length differs
    from that of the kept vector of least id. Codebooks start as the parts of
    the ``entries`` least ids (null ids last, ties by vector), fewer if there are
    fewer rows; ``rounds`` times the parts are assigned and the entries moved,
    and the parts are assigned once more. ``code`` has two hex digits a part,
    ``error`` is the squared distance of a vector to its entries, ``label_error``
    its sum over rows of one label, null labels together. Repeated rows stay.
    An empty table gives an empty result; other columns are not read.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part, so at most 256 entries")
    spark = df.sparkSession
    # Few bytes make much work here, so rows are dealt out whatever the number of files.
    rows = integer_vectors(df.withColumn("__label", F.col(label_col)), id_col, vector_col, scale, "__label")
    with Stages(spark) as stages:
        rows = stages.put(rows.repartition(partitions(spark)), "vectors")
        start = rows.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()  # bounded
        length = len(start[0].v) if start else parts
        if length % parts:
            raise ValueError(f"vectors of {length} components do not make {parts} equal parts")
        if start and any(len(r.v) != length for r in start):
            start = rows.where(F.size("v") == length).orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()
        width = length // parts
        first = np.array([r.v for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)
        balls = Balls(first)
        state = rows.where(F.size("v") == length)
        for i in range(rounds):
            if not start:
                break
            before, state = state, stages.put(assign(state, balls), "assigned")
            stages.drop(rows if i == 0 else before)
            balls = moved_balls(state, balls)
        done = assign(state, balls) if start else state.withColumns({
            "codes": F.array().cast("array<int>"), "distances": F.array().cast("array<bigint>")})
        digest = hashlib.sha256(",".join(map(str, balls.entries.ravel().tolist())).encode()).hexdigest()
        code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
        out = done.select(
            F.col("id").alias(id_col), code.alias("code"),
            F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d).alias("error"),
            # Labels as texts, so that null is a key like the others.
            F.coalesce(F.concat(F.lit("="), F.col("__label").cast("string")), F.lit("")).alias("__label"))
        kept = Stages(spark)
        out = kept.put(out, "codes")
        totals = kept.put(out.groupBy("__label").agg(F.sum("error").alias("label_error"), F.count("*").alias("__n")), "labels")
    return skew_join(out, totals, "__label", "__n").select(
        id_col, "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The same in SQL, every part against every entry."""
    def assigned(t: int) -> str:
        return f"""a{t} AS MATERIALIZED (
  SELECT vec_id, label, p, x, floor(k / {entries}) AS d, (k - {entries} * floor(k / {entries}))::INTEGER AS e FROM (
    SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x,
      min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)) * {entries} + e) AS k
    FROM pieces JOIN c{t} USING (p) GROUP BY vec_id, p))"""

    def means(t: int) -> str:
        return f"""c{t + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, c) AS c FROM c{t} LEFT JOIN (
    SELECT p, e, list(y ORDER BY i) AS m FROM (
      SELECT p, e, i, floor(sum(x[i]) / count(*)) AS y FROM a{t}, range(1, len(x) + 1) AS r(i) GROUP BY p, e, i)
    GROUP BY p, e) USING (p, e))"""

    steps = [s for t in range(rounds) for s in (assigned(t), means(t))] + [assigned(rounds)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pieces AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x
  FROM kept, range({parts}) AS r(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM pieces QUALIFY e < {entries}
), {", ".join(steps)},
errors AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT), ','), ',' ORDER BY p, e)) AS h FROM c{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM errors, books
"""


ORACLE = _oracle()
