"""Replica audits against plain comparison."""

import random

import pytest

from aerolag.llm import fixity

SCHEMA = "page_id long, url string, html string, hash string, node long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


def placed(df):
    return {(r.file, r.ordinal): (r.id, r.start, r.end, r.hash) for r in df.collect()}


def plain(one, two):
    out = {}
    for k in one.keys() | two.keys():
        a, b = one.get(k), two.get(k)
        if a != b:
            state = ("missing" if b is None else "extra" if a is None
                     else "moved" if (a[0], a[3]) == (b[0], b[3]) else "changed")
            out[k] = (state, (a or b)[:3], a and a[3], b and b[3])
    return out


@pytest.mark.parametrize("fanout", [2, 5, 16])
def test_located(spark, fanout):
    rng = random.Random(fanout)
    rows = [(i, f"u{i}", "é" * rng.randrange(50)) for i in range(0, 900, 3)]
    rows += [(None, None, None), (0, "u0", ""), (0, "u0", ""), (-7, "neg", "x"), (3, "long", "y" * 200_000)]
    other = [(i, u, "!" + (h or "") if k % 41 == 5 else h) for k, (i, u, h) in enumerate(rows) if k % 83 != 7]
    other += [(100_000, "far", "z")]
    one, two = (fixity.records(pages(spark, r), file_records=64) for r in (rows, other))
    want = plain(placed(one), placed(two))
    got = {(r.file, r.ordinal): (r.state, (r.id, r.start, r.end), r.hash_one, r.hash_two)
           for r in fixity.audit(one, two, fanout).collect()}
    assert got == want and {s for s, *_ in want.values()} == {"missing", "extra", "moved", "changed"}


def test_equal_empty_and_one_sided(spark):
    rows = fixity.records(pages(spark, [(i, "u", "h") for i in range(30)]))
    none = rows.where("false")
    assert fixity.audit(rows, rows).count() == 0
    assert fixity.audit(none, none).count() == 0
    assert {r.state for r in fixity.audit(rows, none).collect()} == {"missing"}
    assert fixity.audit(none, rows).count() == 30
