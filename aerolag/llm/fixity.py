"""Merkle fixity audit of archive replicas.

Records lie in files, ordered; a record covers an offset range. Each record is
a leaf; ``fanout`` neighbours form a node, level by level up to the file's root,
and the files' roots form levels up to one root of the replica. Two replicas are
compared from the root down, and only below nodes that differ.

A level is one aggregation over the level below, so the tables shrink by the
fanout at each level, and no node gathers more than ``fanout`` children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolag.sources.stage import Stages

FANOUT = 16
FILE_RECORDS = 512


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
            file_records: int = FILE_RECORDS) -> DataFrame:
    """(file, ordinal, id, start, end, hash) of every page as an archive record.

    A file holds the pages whose id falls into one range of ``file_records``
    ids, by id; a record is its url line and its body. Null url or body count
    as empty, a null id goes into file 0. Rows that repeat become records
    of their own. start and end are byte offsets in the file, end exclusive.
    """
    body = F.concat(F.lit("WARC-Target-URI: "), F.coalesce(F.col(url_col), F.lit("")), F.lit("\r\n\r\n"),
                    F.coalesce(F.col(body_col), F.lit("")), F.lit("\r\n\r\n"))
    rows = pages.select(
        F.coalesce(F.floor(F.col(id_col) / F.lit(file_records)) + 1, F.lit(0)).cast("long").alias("file"),
        F.col(id_col).cast("long").alias("id"),
        F.octet_length(body).cast("long").alias("size"),
        F.sha2(body, 256).alias("hash"),
    )
    order = Window.partitionBy("file").orderBy("id", "hash")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("file", (F.row_number().over(order) - 1).cast("long").alias("ordinal"), "id",
                       (end - F.col("size")).alias("start"), end.alias("end"), "hash")


def _levels(leaves: DataFrame, height: int, fanout: int, stages: Stages) -> list[DataFrame]:
    """``height`` levels over (part, node, start, end, hash), the given one first.

    A node's hash covers the places, ranges and hashes of its children, in order.
    """
    out = [leaves]
    child = F.struct("node", "start", "end", "hash")
    for _ in range(height):
        up = out[-1].groupBy("part", F.floor(F.col("node") / F.lit(fanout)).cast("long").alias("node")).agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(child)).alias("c"))
        text = F.array_join(F.transform(
            "c", lambda x: F.concat_ws(":", x["node"], x["start"], x["end"], x["hash"])), "\n")
        out.append(stages.put(up.select("part", "node", "start", "end", F.sha2(text, 256).alias("hash")), "level"))
    return out


def _height(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes up to a single one."""
    height = 0
    while n > 1:
        n, height = -(-n // fanout), height + 1
    return height


def _differing(one: DataFrame, two: DataFrame, above: DataFrame | None, fanout: int, stages: Stages) -> DataFrame:
    """(part, node) of nodes that are not alike on both sides, below the nodes ``above`` only."""
    def side(level: DataFrame, name: str) -> DataFrame:
        if above is not None:
            parents = above.select("part", F.col("node").alias("__up"))
            level = level.withColumn("__up", F.floor(F.col("node") / F.lit(fanout)).cast("long"))
            level = level.join(parents, ["part", "__up"], "left_semi")
        return level.select("part", "node", F.struct("start", "end", "hash").alias(name))

    both = side(one, "one").join(side(two, "two"), ["part", "node"], "full")
    return stages.put(both.where(~F.col("one").eqNullSafe(F.col("two"))).select("part", "node"), "differing")


def audit(one: DataFrame, two: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Records in which two replicas differ, found from the roots down.

    (file, ordinal, id, state, start, end, hash_one, hash_two); ``state``:
    changed (other content or id), moved (same content at another offset), missing (only in
    ``one``) or extra (only in ``two``). id, start and end are those of ``one``
    where it has the record. Inputs are as ``records`` gives them. Equal
    replicas, and two empty ones, give no rows.
    """
    stages = Stages(one.sparkSession)
    sides = [stages.put(x.select("file", "ordinal", "id", "start", "end", "hash"), "leaves") for x in (one, two)]
    ends = sides[0].unionByName(sides[1]).agg(
        F.max("ordinal").alias("ordinal"), F.min("file").alias("first"), F.max("file").alias("last")).first()
    inner = _height((ends.ordinal or 0) + 1, fanout)
    outer = _height((ends.last or 0) - (ends.first or 0) + 1, fanout)
    files, archives = [], []
    for x in sides:
        leaves = x.select(F.col("file").alias("part"), F.col("ordinal").alias("node"), "start", "end",
                          F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "hash").alias("hash"))
        levels = _levels(leaves, inner, fanout, stages)
        roots = levels[-1].select(F.lit(0).cast("long").alias("part"), (F.col("part") - F.lit(ends.first)).alias("node"),
                                  "start", "end", "hash")
        files.append(levels)
        archives.append(_levels(roots, outer, fanout, stages))
    above = None
    for at in reversed(range(outer + 1)):
        above = _differing(archives[0][at], archives[1][at], above, fanout, stages)
    above = above.select((F.col("node") + F.lit(ends.first)).alias("part"), F.lit(0).cast("long").alias("node"))
    for at in reversed(range(inner + 1)):  # a file's root is node 0, also as its own parent
        above = _differing(files[0][at], files[1][at], above, fanout, stages)
    found = above.select(F.col("part").alias("file"), F.col("node").alias("ordinal"))
    a, b = [x.select("file", "ordinal", F.struct("id", "start", "end", "hash").alias(n))
            for x, n in zip(sides, ("a", "b"))]
    both = found.join(a, ["file", "ordinal"], "left").join(b, ["file", "ordinal"], "left")
    state = (F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra")
             .when(F.col("a.hash").eqNullSafe(F.col("b.hash")) & F.col("a.id").eqNullSafe(F.col("b.id")), "moved")
             .otherwise("changed"))
    known = F.coalesce("a", "b")
    return both.select("file", "ordinal", known["id"].alias("id"), state.alias("state"), known["start"].alias("start"),
                       known["end"].alias("end"), F.col("a.hash").alias("hash_one"), F.col("b.hash").alias("hash_two"))


def damaged(pages: DataFrame, id_col: str = "page_id", body_col: str = "html") -> DataFrame:
    """A replica with known damage: one byte turned in some bodies, others cut in half."""
    body, n = F.col(body_col), F.col(id_col)
    cut = F.substring(body, 1, F.floor(F.length(body) / 2).cast("int"))
    turned = F.concat(F.lit("~"), F.substring(body, 2, F.length(body)))
    return pages.withColumn(body_col, F.when(n % 97 == 13, turned).when(n % 3001 == 7, cut).otherwise(body))


ORACLE = f"""
WITH replica AS (
  SELECT 1 AS r, page_id, 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS body FROM pages
  UNION ALL
  SELECT 2, page_id, 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(CASE WHEN page_id % 97 = 13 THEN '~' || substring(html, 2)
                     WHEN page_id % 3001 = 7 THEN substring(html, 1, length(html) // 2) ELSE html END, '')
    || chr(13) || chr(10) || chr(13) || chr(10) FROM pages),
placed AS (
  SELECT r, page_id, page_id // {FILE_RECORDS} + 1 AS file, sha256(body) AS hash, strlen(body) AS size,
    row_number() OVER (PARTITION BY r, page_id // {FILE_RECORDS} ORDER BY page_id) - 1 AS ordinal,
    sum(strlen(body)) OVER (PARTITION BY r, page_id // {FILE_RECORDS} ORDER BY page_id) AS stop
  FROM replica)
SELECT a.file, a.ordinal, a.page_id,
  CASE WHEN a.hash = b.hash THEN 'moved' ELSE 'changed' END AS state,
  CAST(a.stop - a.size AS BIGINT) AS "start", CAST(a.stop AS BIGINT) AS "end", a.hash AS hash_one, b.hash AS hash_two
FROM placed a JOIN placed b ON a.r = 1 AND b.r = 2 AND a.file = b.file AND a.ordinal = b.ordinal
WHERE a.hash <> b.hash OR a.stop <> b.stop
"""
