"""Weighted samples: exact digests, and a collision rate that equals generalised Jaccard."""

import hashlib
from collections import Counter

import numpy as np

from aerolag.llm import catalog, cws
from aerolag.llm.common import table
from tests.llm.helpers import by_id, frame

SF = "/root/testdata/sf0.001"


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def share(a, b):
    parts = [a[i:i + cws.DIGITS] == b[i:i + cws.DIGITS] for i in range(0, len(a), cws.DIGITS)]
    return sum(parts) / len(parts)


def expected(docs):
    """docs: (id, text) with unique ids; id -> (n, edited text, next id)."""
    order = sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        after, text = order[(k + 1) % len(order)], text or ""
        n = len(text)
        out[i] = (n, text[:n - n // 2] + (after[1] or "")[:n // 2], after[0])
    return out


def verify(rows, docs):
    want = expected(docs)
    assert rows.keys() == want.keys()
    for i, (n, edited, after) in want.items():
        r = rows[i]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == share(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == share(r["fingerprint"], rows[after]["fingerprint"])
    return want


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = by_id(catalog.QUERIES["op1_weighted_sampling"](spark, SF))
    want = verify(rows, docs)
    texts = dict(docs)
    bias = [rows[i]["near_edited"] - jaccard(texts[i], want[i][1]) for i in texts]
    assert abs(np.mean(bias)) < 0.03 and np.std(bias) < 0.12
    alone = by_id(cws.fingerprints(table(spark, SF, "documents")))
    assert all(alone[i]["fingerprint"] == rows[i]["fingerprint"] for i in texts)


def test_awkward_rows(spark):
    docs = [(5, "one two  two\nthree"), (4, None), (3, ""), (2, " \t "), (1, "é😀 word"), (None, "last of all"),
            (-4, "word " * 100_000), (9, "one two two three"), (10, "x")]
    rows = by_id(cws.compare_with_edits(frame(spark, docs)))
    verify(rows, docs)
    assert rows[5]["fingerprint"] == rows[9]["fingerprint"]
    assert rows[4]["fingerprint"] == rows[3]["fingerprint"] == rows[2]["fingerprint"] == "f" * len(rows[3]["fingerprint"])
    assert cws.compare_with_edits(frame(spark, [])).count() == 0
    single = cws.compare_with_edits(frame(spark, [(1, "a b c d")])).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


def test_repeated_rows_are_kept(spark):
    docs = [(2, "same text here")] * 3 + [(2, "other words"), (1, "a b c d e f")]
    rows = cws.compare_with_edits(frame(spark, docs)).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 2, 2, 2]
    assert len({r.fingerprint for r in rows if r.doc_id == 2}) == 2


def test_collision_rate(spark):
    texts = [(0, "a b b c c c"), (1, "a a b c c c d"), (2, "a " * 10 + "b"), (3, "a " * 5 + "b " * 5), (4, "q"), (5, "q q q"),
             (6, " ".join(f"w{i % 40}" for i in range(300))), (7, " ".join(f"w{i % 55}" for i in range(200)))]
    prints = {r.doc_id: r.fingerprint for r in cws.fingerprints(frame(spark, texts), samples=2048).collect()}
    for a, b in ((0, 1), (2, 3), (4, 5), (6, 7), (0, 6), (2, 5)):
        assert abs(share(prints[a], prints[b]) - jaccard(texts[a][1], texts[b][1])) < 0.045
