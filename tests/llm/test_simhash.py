"""SimHash classes against all pairs."""

import numpy as np
import pytest
import xxhash

from aerolag.llm import catalog, simhash
from aerolag.llm.common import table
from tests.llm.helpers import by_id, frame

SF = "/root/testdata/sf0.001"


def plain_print(text, k=3):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, distance=3):
    """prints: (id, fp); least id reachable for each row."""
    distinct = sorted({f for _, f in prints})
    arr, root = np.array(distinct, np.uint64), list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= distance):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    place, least = {f: find(i) for i, f in enumerate(distinct)}, {}
    for i, f in prints:
        if i is not None:
            least[place[f]] = min(i, least.get(place[f], i))
    return [(i, f"{f:016x}", least.get(place[f])) for i, f in prints]


def test_query(spark):
    docs = [(r.doc_id, plain_print(r.text)) for r in table(spark, SF, "documents").collect()]
    rows = by_id(catalog.QUERIES["op8_simhash_pivots"](spark, SF))
    assert {(i, r["fingerprint"], r["component_id"]) for i, r in rows.items()} == set(plain_classes(docs))


def test_awkward_rows(spark):
    rows = [(5, "A b\tc d"), (3, "a B c d"), (3, "a B c d"), (None, "a b c d"), (8, None), (7, ""), (9, " \n"),
            (11, "é É one"), (12, "one"), (2, "lorem " * 400_000), (None, "only null here now")]
    got = simhash.near_duplicates(frame(spark, rows))
    want = plain_classes([(i, plain_print(t)) for i, t in rows])
    assert sorted(map(repr, [tuple(r) for r in got.collect()])) == sorted(map(repr, want))
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("distance,run", [(3, 4096), (3, 4), (0, 8), (7, 16)])
def test_links_hold_every_pair(spark, distance, run):
    """A ball of close fingerprints, far more of them than a run may hold, chains and strangers."""
    rng = np.random.default_rng(distance + run)
    center = int(rng.integers(0, 2**63))
    ball = {center}
    while len(ball) < 60:
        f = center
        for b in rng.integers(0, 64, 3):
            f ^= 1 << int(b)
        ball.add(f)
    chain = [0]
    for i in range(0, 60, 3):
        chain.append(chain[-1] ^ (7 << i))
    prints = sorted(ball | set(chain) | {int(x) for x in rng.integers(0, 2**63, 200)})
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in prints]
    from aerolag.llm.common import components
    from aerolag.sources.stage import Stages

    stages = Stages(spark)
    df = stages.put(spark.createDataFrame(signed, "fp long"), "t")
    links = stages.put(simhash.fingerprint_links(df, len(prints), distance, run), "links")
    roots = {r.node % 2**64: r.root % 2**64 for r in components(links, stages).collect()}
    want = plain_classes([(i, f) for i, f in enumerate(prints)], distance)
    groups, mine = {}, {}
    for (i, _, c), f in zip(want, prints):
        groups.setdefault(c, set()).add(f)
        mine.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


@pytest.mark.parametrize("n", [10, 300_000, 5_000_000, 10**9, 10**13])
def test_blocks_are_exact_and_select(n):
    masks = simhash.block_masks(n, 3)
    rng = np.random.default_rng(1)
    for _ in range(200):
        diff = sum({1 << int(b) for b in rng.integers(0, 64, 3)})
        assert any(diff & m == 0 for m in masks)
    assert n > 10**10 or simhash.expected_shared(n, masks) < 8


def test_pivots_decide_what_meets(spark):
    """Distances are right, every close pair shares a key, and fewer pairs do than by blocks of bits alone."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 4).tolist()
    # Fingerprints alike in the low 40 bits, so that blocks agree and pivots must tell them apart.
    prints = {(b & (1 << 40) - 1) | int(x) << 40 for b in base for x in rng.integers(0, 2**23, 80)}
    prints |= {p ^ (1 << 41) ^ (1 << 50) for p in list(prints)[:50]}
    table = simhash.with_distances(spark.createDataFrame([(p,) for p in prints], "fp long"))
    for r in table.collect():
        got = [b for name in simhash.NEAR for b in (r[name] % 2**64).to_bytes(8, "little")]
        assert got == [(r.fp % 2**64 ^ p).bit_count() for p in simhash.pivots()]
    met = {}
    for r in simhash.candidate_keys(table, len(prints), 3).collect():
        met.setdefault(r.key, set()).add(r.fp)
    pairs = {(a, b) for group in met.values() for a in group for b in group if a < b}
    close = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}
    masks = simhash.block_masks(len(prints), 3)
    blocks = {(a, b) for a in prints for b in prints if a < b and any((a ^ b) & m == 0 for m in masks)}
    assert close and close <= pairs < blocks
