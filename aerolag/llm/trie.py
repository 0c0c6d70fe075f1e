"""Prefix tries of conversations, by adaptive radix trees over turn ids.

A turn's id is 16 bytes of a digest of its role and text, big-endian, so a
conversation is the string of its turns' ids, and byte order is the order of
the sequences. Trees over these strings have nodes of four layouts, which grow
with their children, and compress paths without branches. A node of the trie is
a tree position at a whole number of turns; positions inside a turn give none.

The work is dealt by ranges of the sorted strings. Each range has a tree of its
own; the only trie nodes that two ranges share are prefixes of the strings on
either side of a cut. Their parts are added up, and what lies below them is
final already. Equal conversations are one string, however many there are.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolag.llm.common import partitions, skew_join
from aerolag.sources.stage import Stages

WIDTH = 16  # bytes of a turn id
# Bytes of strings in a range: no more on large tables, no less on small ones.
MOST_BYTES, LEAST_BYTES = 8 << 20, 256 << 10
IDS = 512  # conversation ids that are joined to one text before they are hashed
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()


# -- the tree ---------------------------------------------------------------


class Sorted:
    """Up to ``room`` children, found by their byte in a short sorted list."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def find(self, byte: int):
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def add(self, byte: int, node) -> Sorted | Indexed:
        """The layout with the child in it: this one, or a larger one if this is full."""
        if len(self.nodes) < self.room:
            at = bisect_left(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)
            return self
        grown = Sorted(16) if self.room < 16 else Indexed()
        for b, n in zip(self.bytes, self.nodes):
            grown.add(b, n)
        return grown.add(byte, node)

    def all(self):
        return self.nodes


class Indexed:
    """Up to 48 children, found through a table of 256 places."""

    __slots__ = ("place", "nodes")

    def __init__(self):
        self.place, self.nodes = bytearray(256), []

    def find(self, byte: int):
        at = self.place[byte]
        return self.nodes[at - 1] if at else None

    def add(self, byte: int, node) -> Indexed | Direct:
        if len(self.nodes) < 48:
            self.nodes.append(node)
            self.place[byte] = len(self.nodes)
            return self
        grown = Direct()
        for b in range(256):
            if self.place[b]:
                grown.add(b, self.nodes[self.place[b] - 1])
        return grown.add(byte, node)

    def all(self):
        return self.nodes


class Direct:
    """A place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def find(self, byte: int):
        return self.nodes[byte]

    def add(self, byte: int, node) -> Direct:
        self.nodes[byte] = node
        return self

    def all(self):
        return [n for n in self.nodes if n is not None]


class Node:
    """A branch or an end, with the bytes between its parent's branch and itself."""

    __slots__ = ("path", "children", "value", "some")

    def __init__(self, path: bytes, value: int | None = None, some: int | None = None):
        self.path, self.children, self.value = path, None, value
        self.some = value if some is None else some  # the value of some string through this node

    def add(self, byte: int, node: Node) -> None:
        self.children = (self.children or Sorted(4)).add(byte, node)


def common(a: bytes, b: bytes) -> int:
    """How many leading bytes two strings share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


class RadixTree:
    """Distinct byte strings, each with a value."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value: int) -> None:
        node, at = self.root, 0
        if node.some is None:
            node.some = value
        while True:
            rest = key[at:]
            shared = common(rest, node.path)
            if shared < len(node.path):
                # Split the path: what is below stays below, behind the byte that differs.
                below = Node(node.path[shared + 1:], node.value, node.some)
                below.children = node.children
                byte = node.path[shared]
                node.path, node.children, node.value = node.path[:shared], None, None
                node.add(byte, below)
            at += shared
            if at == len(key):
                node.value = value
                return
            child = node.children.find(key[at]) if node.children else None
            if child is None:
                node.add(key[at], Node(key[at + 1:], value))
                return
            node, at = child, at + 1

    def through(self, key: bytes) -> list[Node]:
        """The nodes on the way to a string that is in the tree."""
        out, node, at = [], self.root, 0
        while True:
            out.append(node)
            at += len(node.path)
            if at >= len(key):
                return out
            node, at = node.children.find(key[at]), at + 1


def prefix_ids(key: bytes, depth: int) -> list[bytes]:
    """An id for each prefix of 0 to ``depth`` turns, equal wherever the prefix is."""
    state, out = hashlib.blake2b(digest_size=16), []
    out.append(state.digest())
    for i in range(depth):
        state.update(key[i * WIDTH:(i + 1) * WIDTH])
        out.append(state.digest())
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, prefix binary, parent_prefix binary, words long"
)


def trie_nodes(keys: list[bytes], words: list, counts: list[int], firsts: list[int], ends: list[str],
               before: int = -1, after: int = -1) -> dict[str, list]:
    """Trie nodes of one range of distinct strings, as columns of NODES.

    ``counts`` conversations equal a string, the least of them is ``firsts``.
    Prefixes of the least string up to ``before`` turns and of the greatest up
    to ``after`` turns occur in other ranges too. Such nodes carry their prefix;
    their counts are this range's part, and sums over their subtree leave out
    themselves and their shared children. Nodes right below them carry the
    parent's prefix instead of its conversation.
    """
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    # How deep a node is shared, and the ids of the prefixes on its way.
    shared: dict[int, tuple[int, list[bytes]]] = {}
    for key, depth in ((min(keys), before), (max(keys), after)):
        if depth >= 0:
            ids = prefix_ids(key, depth)
            for node in tree.through(key):
                if shared.get(id(node), (-1,))[0] < depth:
                    shared[id(node)] = depth, ids
    # Nodes in an order that has parents first; `top` is the nearest node above with a whole number of turns in it.
    order: list[tuple[Node, int, int, int]] = []
    stack = [(tree.root, -1, -1, -1)]
    while stack:
        node, above, start, top = stack.pop()
        end = start + 1 + len(node.path)
        at = len(order)
        order.append((node, above, start, top))
        if node.children:
            inner = at if end // WIDTH > start // WIDTH else top
            stack.extend((child, at, end, inner) for child in node.children.all())
    size = len(order)
    convs, least = [0] * size, [None] * size
    # Of what lies below the next whole turn up: its nodes, leaves and savings, without shared ones.
    heads, leaves, saved = [0] * size, [0] * size, [0] * size
    whole = [0] * size  # child nodes, shared ones included
    out: dict[str, list] = {c: [] for c in (*COLUMNS, "prefix", "parent_prefix", "words")}
    emitted: list[tuple[int, int]] = []

    for i in range(size - 1, -1, -1):
        node, above, start, top = order[i]
        end = start + 1 + len(node.path)
        if node.value is not None:
            convs[i] += counts[node.value]
            least[i] = firsts[node.value] if least[i] is None else min(least[i], firsts[node.value])
        n, below, all_below, ends_below, saved_below = convs[i], heads[i], whole[i], leaves[i], saved[i]
        limit, ids = shared.get(id(node), (-1, []))
        high, low = end // WIDTH, start // WIDTH + 1
        for depth in range(high, low - 1, -1):
            own = words[node.some][depth - 1] if depth else 0
            is_end = node.value is not None and depth * WIDTH == end
            part = depth <= limit
            if not part:
                ends_below = ends_below if all_below else 1
                saved_below += (n - 1) * own
            out["depth"].append(depth)
            out["n_convs"].append(n)
            out["n_children"].append(below)
            out["n_leaves"].append(ends_below)
            out["saved_tokens"].append(saved_below)
            out["ends_sha256"].append(ends[node.value] if is_end else None if part else EMPTY)
            out["prefix"].append(ids[depth] if part else None)
            out["words"].append(own)
            emitted.append((i, depth))
            all_below = 1
            below, ends_below, saved_below = (0, 0, 0) if part else (1, ends_below, saved_below)
        if high >= low:
            all_below = 1
        if above >= 0:
            convs[above] += n
            least[above] = least[i] if least[above] is None else min(least[above], least[i])
            heads[above] += below
            whole[above] += all_below
            leaves[above] += ends_below
            saved[above] += saved_below

    for i, depth in emitted:
        node, _, start, top = order[i]
        out["conv_id"].append(least[i])
        # The parent is on the same path, or at the nearest node above that holds a whole turn.
        upper = i if depth > start // WIDTH + 1 else top
        out["parent_conv_id"].append(least[upper] if upper >= 0 else None)
        limit, ids = shared.get(id(order[upper][0]), (-1, [])) if upper >= 0 else (-1, [])
        out["parent_prefix"].append(ids[depth - 1] if 0 < depth <= limit + 1 else None)
    return out


def join_parts(rows: list[dict]) -> list[dict]:
    """Shared nodes, one per prefix, with their sums over the subtree made whole."""
    by_prefix = {r["prefix"]: r for r in rows}
    for r in sorted(rows, key=lambda r: -r["depth"]):
        if not r["n_children"]:
            r["n_leaves"] = 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        parent = by_prefix.get(r["parent_prefix"])
        if parent is not None:
            parent["n_children"] += 1
            parent["n_leaves"] += r["n_leaves"]
            parent["saved_tokens"] += r["saved_tokens"]
            r["parent_conv_id"] = parent["conv_id"]
    return rows


# -- conversations ------------------------------------------------------------


def turn_id(role: Column, text: Column) -> Column:
    """Hex digits of a turn's id; the role's length keeps role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * WIDTH)


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (id, words).

    Order is by turn, null first, and by id among equal turn numbers. Null role
    and text are empty texts. Rows without a conversation are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct("turn", turn_id(role, text).alias("id"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def shared_heads(lists: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin like the one of their group.

    The first h turns of conversation c come from conversation c - c % every,
    none if it is absent, and the rest are its own after its first h;
    h = crc32(c in decimal digits) % most.
    """
    group = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = lists.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("__group"), F.slice("turns", 1, most - 1).alias("__head"))
    rows = lists.withColumns({"__group": group, "__h": h}).join(heads, "__group", "left")
    nothing = F.slice("turns", 1, 0)
    return rows.select("conv_id", F.concat(
        F.slice(F.coalesce("__head", nothing), F.lit(1), F.col("__h")),
        F.slice("turns", F.col("__h") + 1, F.greatest(F.size("turns") - F.col("__h"), F.lit(0)))).alias("turns"))


def end_digests(members: DataFrame) -> DataFrame:
    """(string, n, first, ends): how many conversations equal a string, the least, and the digest of all ids.

    Rows are range-sorted by string and id, so that a string of very many
    conversations is spread, and joined to texts of some ids. The texts of a
    string then pass one task in order, one at a time.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids = batch.column("string").to_pylist(), batch.column("conv_id").to_pylist()
            start, out = 0, []
            for i in range(1, len(ids) + 1):
                if i == len(ids) or names[i] != names[start] or i - start == IDS:
                    out.append((names[start], ids[start], i - start, ",".join(map(str, ids[start:i]))))
                    start = i
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))] if out
                else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())],
                names=["string", "first", "n", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, n, state = None, None, 0, None

        def row(*values):
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["string", "n", "first", "ends"])

        for batch in batches:
            done = []
            for name, least, count, ids in zip(*(batch.column(c).to_pylist() for c in ("string", "first", "n", "ids"))):
                if name != now:
                    if now is not None:
                        done.append((now, n, first, state.hexdigest()))
                    now, first, n, state = name, least, 0, hashlib.sha256()
                state.update(("," if n else "").encode() + ids.encode())
                n += count
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["string", "n", "first", "ends"])
        if now is not None:
            yield row(now, n, first, state.hexdigest())

    n = partitions(members.sparkSession)
    texts = (
        members.select("string", "conv_id").repartitionByRange(n, "string", "conv_id")
        .sortWithinPartitions("string", "conv_id").mapInArrow(joined, "string string, first long, n long, ids string")
    )
    return (
        texts.repartition(n, "string").sortWithinPartitions("string", "first")
        .mapInArrow(hashed, "string string, n long, first long, ends string")
    )


def _shared_turns(a: str, b: str) -> Column:
    """How many leading turns two strings share; -1 if one of them is missing."""
    turns = (F.least(F.octet_length(a), F.octet_length(b)) / WIDTH).cast("int")

    def same(i: Column) -> Column:
        at = i * WIDTH + 1
        return (i < turns) & (F.substring(F.col(a), at, F.lit(WIDTH)) == F.substring(F.col(b), at, F.lit(WIDTH)))

    count = F.array_position(F.transform(F.sequence(F.lit(0), turns), same), F.lit(False)) - 1
    return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), count).otherwise(-1).cast("int")


def build(lists: DataFrame, most_bytes: int = MOST_BYTES, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The trie's nodes, one row each, of conversations (conv_id, turns: array of (id, words)).

    conv_id: least member; depth; parent_conv_id: the parent's conv_id, null for
    the root; n_convs: members; n_children; n_leaves: childless nodes in the
    subtree, itself included; saved_tokens: over the subtree, (n_convs - 1) times
    the words of the node's last turn; ends_sha256: digest of the ids of members
    that end here. A conversation without turns ends at the root. conv_id is
    not null and tells the rows apart. No conversation, no node.

    One task holds the ids of one range of strings, and of one conversation
    whole. The nodes that ranges share are joined in one task: at most as many
    as neighbouring strings at the cuts have turns in common.
    """
    spark = lists.sparkSession
    stages = Stages(spark)
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    rows = lists.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = stages.put(rows.withColumn("string", F.sha2("key", 256)), "strings")
    ends = end_digests(rows).alias("ends")
    distinct = rows.groupBy("string").agg(F.first("key").alias("key"), F.first("words").alias("words"))
    distinct = stages.put(distinct.join(ends, "string").drop("string"), "distinct")
    stages.drop(rows)
    total = distinct.agg(F.sum(F.octet_length("key"))).first()[0] or 0
    cuts = max(1, -(-total // most_bytes), min(partitions(spark), total // least_bytes))
    ranges = distinct.repartitionByRange(cuts, "key").sortWithinPartitions("key")
    ranges = stages.put(ranges.withColumn("range", F.spark_partition_id()), "ranges")
    stages.drop(distinct)

    # One row per range: its first and last string, next to those of its neighbours.
    beside = Window.orderBy("range")
    limits = ranges.groupBy("range").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    limits = limits.withColumns({"left": F.lag("high").over(beside), "right": F.lead("low").over(beside)})
    limits = stages.put(limits.select(
        "range", _shared_turns("left", "low").alias("before"), _shared_turns("high", "right").alias("after")), "limits")

    def grow(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({c: [] for c in (*COLUMNS, "prefix", "parent_prefix", "words")}).cast(schema)
        found = trie_nodes(*[table[c].to_pylist() for c in ("key", "words", "n", "first", "ends")],
                           table["before"][0].as_py(), table["after"][0].as_py())
        return pa.table(found, schema=schema)

    schema = pa.schema([
        *[(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in COLUMNS],
        ("prefix", pa.binary()), ("parent_prefix", pa.binary()), ("words", pa.int64())])
    tasks = max(1, min(cuts, 100_000))
    nodes = (
        ranges.join(F.broadcast(limits), "range")  # one row of numbers per range
        .repartition(tasks, "range").groupBy("range").applyInArrow(grow, NODES)
    )
    nodes = stages.put(nodes, "nodes")
    stages.drop(ranges)

    done = nodes.where("prefix is null and parent_prefix is null").select(*COLUMNS)
    below = nodes.where("prefix is null and parent_prefix is not null")
    parts = nodes.where("prefix is not null").groupBy("prefix").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.lit(EMPTY)).alias("ends_sha256"),
        F.first("parent_prefix").alias("parent_prefix"), F.first("words").alias("words"))
    # Before the parts are joined, n_children counts the rows below a shared node.
    parts = stages.put(parts.withColumn("__n", F.col("n_children")), "parts")

    def whole(table: pa.Table) -> pa.Table:
        table = table.drop_columns(["__one"])
        return pa.Table.from_pylist(join_parts(table.to_pylist()), schema=table.schema)

    joined = parts.withColumn("__one", F.lit(0)).groupBy("__one").applyInArrow(whole, parts.schema)
    parents = parts.where("__n > 0").select(F.col("prefix").alias("parent_prefix"), F.col("conv_id").alias("__parent"), "__n")
    below = skew_join(below, parents, "parent_prefix", "__n").withColumn("parent_conv_id", F.col("__parent"))
    return done.unionByName(below.select(*COLUMNS)).unionByName(joined.select(*COLUMNS))


_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), " \
       "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
ORACLE = f"""
WITH bytes AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
), plain AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids FROM plain GROUP BY conv_id
), words AS (
  SELECT id, any_value(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) AS n FROM plain GROUP BY id
), heads AS (
  SELECT conv_id, ids, {_CRC} % 4 AS h FROM lists, bytes
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(p.ids[1:c.h], []), c.ids[c.h + 1:]) AS ids
  FROM heads c LEFT JOIN lists p ON p.conv_id = c.conv_id - c.conv_id % 20
), members AS (
  SELECT conv_id, d, len(ids) = d AS ends, array_to_string(ids[1:d], '') AS key, CASE WHEN d > 0 THEN ids[d] END AS last
  FROM rebuilt, lateral (SELECT unnest(range(len(ids) + 1)) AS d) AS depths
), nodes AS (
  SELECT key, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(last) AS last,
    CASE WHEN any_value(d) > 0 THEN left(key, 64 * (any_value(d) - 1)::INTEGER) END AS parent,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY key
), children AS (
  SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), parts AS (
  SELECT left(key, (64 * j)::INTEGER) AS top, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * coalesce(w.n, 0) AS saved
  FROM nodes LEFT JOIN children c ON c.parent = key LEFT JOIN words w ON w.id = last,
    lateral (SELECT unnest(range(depth + 1)) AS j) AS tops
), sums AS (
  SELECT top, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM parts GROUP BY top
)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
  s.saved_tokens, x.ends_sha256
FROM nodes x JOIN sums s ON s.top = x.key LEFT JOIN nodes p ON p.key = x.parent LEFT JOIN children c ON c.parent = x.key
"""
