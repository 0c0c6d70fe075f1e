"""Jump consistent hashing against a plain version."""

import zlib
from collections import Counter, defaultdict

import pytest

from aerolag.llm import catalog, shards
from aerolag.llm.common import table
from tests.llm.helpers import by_id, frame

SF = "/root/testdata/sf0.001"


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 8, 9, 17, 1000, 50_000])
def test_same_as_plain(spark, n):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 42, 10**12, *range(2, 300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.shard for r in shards.with_shard(df, "k", n).collect()}
    assert got == {k: jump(k, n) for k in keys}


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = by_id(catalog.QUERIES["op5_jump_hash_shards"](spark, SF))
    assert rows.keys() == docs.keys()
    slots = defaultdict(list)
    for i, r in rows.items():
        raw = docs[i].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (jump(i, 8), jump(i, 9))
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_rows(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (None, None), (None, ""), (7, "é" * 100_000)] + [(9, "hot")] * 50
    out = shards.assign(frame(spark, rows), 8).collect()
    assert len(out) == len(rows)
    assert Counter(r.size for r in out)[1] == 2 and Counter(r.size for r in out)[200_001] == 1
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.assign(frame(spark, []), 8).count() == 0


def test_written_shards(spark, tmp_path):
    df = table(spark, SF, "documents")
    shards.write_shards(df, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count()
    assert all(r["__shard"] == jump(r.doc_id, 4) for r in back.select("doc_id", "__shard").collect())
