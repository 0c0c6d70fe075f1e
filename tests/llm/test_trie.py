"""Conversation tries against plain prefix counting."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from aerolag.llm import catalog, trie

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # names that the operator uses inside
    T.StructField("key", T.StringType()), T.StructField("words", T.StringType()), T.StructField("t", T.StringType()),
    T.StructField("turns", T.StringType()), T.StructField("range", T.StringType()), T.StructField("string", T.StringType()),
])


def turns(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], TURNS)


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def plain(sequences):
    """Nodes of (conv_id -> list of (role, text)), by counting every prefix."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, s in sequences.items():
        s = tuple(s)
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[:d - 1]].add(s[:d])
    below = defaultdict(lambda: [0, 0])
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += not children[p]
            below[p[:d]][1] += (len(m) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), *below[p], sha(ends[p]))
                  for p, m in members.items())


def rebuilt(rows, every=20, most=4):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = own.get(c - c % every, [])[:h] + s[h:]
    return out


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def talk(rng, n, kinds, most=7):
    """Conversations that share many beginnings; some are equal, some are prefixes of others."""
    rows, seen = [], []
    for c in range(n):
        s = list(rng.choice(seen)[:rng.randint(0, most)]) if seen and rng.random() < 0.6 else []
        s += [(rng.choice(["user", "assistant", None]), f"w{rng.randrange(kinds)} and\tmore " * rng.randint(0, 2))
              for _ in range(rng.randint(0, 3))]
        seen.append(s)
        rows += [(c, t, *x) for t, x in enumerate(s)]
    return rows


@pytest.mark.parametrize("n", [1, 4, 5, 16, 17, 48, 49, 256])
def test_layouts_grow(n):
    tree = trie.RadixTree()
    keys = [bytes([b]) * 3 for b in range(n)]
    random.Random(n).shuffle(keys)
    for i, k in enumerate(keys):
        tree.insert(k, i)
    kind = "Sorted" if n <= 16 else "Indexed" if n <= 48 else "Direct"
    if n > 1:
        assert type(tree.root.children).__name__ == kind
        assert len(tree.root.children.all()) == n
    assert [tree.through(k)[-1].value for k in keys] == list(range(n))


def test_paths_split_and_prefixes_stay():
    rng = random.Random(3)
    keys = {bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(400)}
    tree = trie.RadixTree()
    for i, k in enumerate(keys):
        tree.insert(k, i)
    assert [tree.through(k)[-1].value for k in keys] == list(range(len(keys)))
    for a in list(keys)[:40]:
        for b in list(keys)[:40]:
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert trie.common(a, b) == n


def test_ranges_join_to_the_whole():
    """Any cuts of the sorted strings give the nodes of one tree."""
    rng = random.Random(4)
    strings = {tuple(rng.randrange(3) for _ in range(rng.randint(0, 6))) for _ in range(120)}
    keys = sorted((b"".join(hashlib.md5(bytes([x])).digest() for x in s) for s in strings))
    words = [[len(k) + i for i in range(len(k) // trie.WIDTH)] for k in keys]
    turn = {k[i:i + 16]: k[i] % 7 for k in keys for i in range(0, len(k), 16)}
    words = [[turn[k[i:i + 16]] for i in range(0, len(k), 16)] for k in keys]
    counts, firsts = [rng.randint(1, 4) for _ in keys], rng.sample(range(10_000), len(keys))
    ends = [f"e{i}" for i in range(len(keys))]

    def rows(found):
        names = list(found)
        return [dict(zip(names, r)) for r in zip(*found.values())]

    def shared(a, b):
        return next((i for i in range(min(len(a), len(b)) // 16) if a[i * 16:i * 16 + 16] != b[i * 16:i * 16 + 16]),
                    min(len(a), len(b)) // 16)

    whole = rows(trie.trie_nodes(keys, words, counts, firsts, ends))
    expected = sorted(tuple(r[c] for c in trie.COLUMNS if c != "parent_conv_id") + (r["parent_conv_id"] or 0,) for r in whole)
    for count in (2, 3, 10, len(keys)):
        cuts = sorted({0, len(keys), *rng.sample(range(1, len(keys)), count - 1)})
        found, parts = [], defaultdict(list)
        for a, b in zip(cuts, cuts[1:]):
            before = shared(keys[a - 1], keys[a]) if a else -1
            after = shared(keys[b - 1], keys[b]) if b < len(keys) else -1
            for r in rows(trie.trie_nodes(keys[a:b], words[a:b], counts[a:b], firsts[a:b], ends[a:b], before, after)):
                (parts[r["prefix"]] if r["prefix"] else found).append(r)
        joined = []
        for same in parts.values():
            r = dict(same[0], conv_id=min(x["conv_id"] for x in same),
                     ends_sha256=next((x["ends_sha256"] for x in same if x["ends_sha256"]), trie.EMPTY), parent_conv_id=None)
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                r[c] = sum(x[c] for x in same)
            joined.append(r)
        joined = trie.join_parts(joined)
        least = {r["prefix"]: r["conv_id"] for r in joined}
        for r in found:
            if r["parent_prefix"]:
                r["parent_conv_id"] = least[r["parent_prefix"]]
        assert sorted(tuple(r[c] for c in trie.COLUMNS if c != "parent_conv_id") + (r["parent_conv_id"] or 0,)
                      for r in found + joined) == expected


@pytest.mark.parametrize("least_bytes", [16, 200, 1 << 20])
def test_same_as_counting(spark, least_bytes):
    rows = talk(random.Random(least_bytes), 200, 5)
    lists = trie.shared_heads(trie.turn_lists(turns(spark, rows)))
    assert got(trie.build(lists, most_bytes=max(least_bytes, 64), least_bytes=least_bytes)) == plain(rebuilt(rows))


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "nobody"), (1, None, "user", "no turn"), (1, 0, None, None), (1, 2, "", ""), (2, 5, "user", "x" * 300_000),
        (-5, 0, "user", "below zero"), (-5, 0, "user", "below zero"), (3, 0, "us", "er"), (23, 0, "user", ""), (43, 0, "u", "ser"),
        (7, 1, "user", "only one"), (5, 9, "a", "b c"), (10**15, 0, "user", "far"), (41, 0, "user", "one two"),
    ]
    # one conversation that a third of all are copies of, and one very long
    rows += [(c, t, "user", f"copy {t}") for c in range(100, 400) for t in range(3)]
    rows += [(60, t, "user", f"long {t % 50}") for t in range(3000)]
    out = got(trie.build(trie.shared_heads(trie.turn_lists(turns(spark, rows))), most_bytes=2000, least_bytes=100))
    expected = {}
    own = rebuilt(rows)
    for c, s in own.items():
        expected[c] = s
    long = expected.pop(60)
    assert len(long) == 3000
    kept = [r for r in out if not (r[1] > 3 and r[0] == 60)]
    # counting prefixes of the long one takes too long, so its depth is tested by itself
    assert sum(r[1] > 3 and r[0] == 60 for r in out) == 2997
    short = plain(expected | {60: long[:3]})
    assert [r[:5] for r in kept if r[0] != 60 and r[1]] == [r[:5] for r in short if r[0] != 60 and r[1]]
    assert [r for r in out if r[1] == 0][0][3] == len(expected) + 1
    assert got(trie.build(trie.turn_lists(turns(spark, [])))) == []
    empty = trie.turn_lists(turns(spark, [(1, 0, "user", "a")])).selectExpr("conv_id", "slice(turns, 1, 0) turns")
    assert got(trie.build(empty)) == [(1, 0, -1, 1, 0, 1, 0, sha([1]))]


def test_query_is_whole(spark, tmp_path):
    rows = talk(random.Random(9), 150, 4)
    turns(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(catalog.QUERIES["op12_prefix_radix_trie"](spark, str(tmp_path))) == plain(rebuilt(rows))
