"""Passage search against plain edit distance."""

import random

import numpy as np
import pytest

from aerolag.llm import catalog, decontaminate
from aerolag.llm.common import table
from tests.llm.helpers import frame

SF = "/root/testdata/sf0.01"
WORDS = "the of and thion ered hesh ouat inble lyre stea wher nton ingea".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "th"]) for _ in range(n))


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("xyzé")
        elif kind == 1:
            out.insert(at, rng.choice("xyz "))
        else:
            del out[at]
    return "".join(out)


def least_edits(pattern, text):
    """Fewest edits between a pattern and any part of a text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_against_plain_distance():
    rng = random.Random(3)
    items = [(i, prose(rng, n)) for i, n in enumerate((12, 20, 30, 45, 60, 3))] + [(9, "éàü " * 20)]
    index = decontaminate.build_index(items)
    texts = []
    for _ in range(60):
        i, item = rng.choice(items)
        e, _ = decontaminate.budget(len(item))
        texts.append(prose(rng, rng.randrange(30)) + " " + edited(rng, item, rng.randrange(e + 4)) + " " + prose(rng, 10))
    texts += ["", items[0][1], items[0][1][3:], items[1][1].upper(), items[2][1].replace(" ", "\n"), prose(rng, 80)]
    found = {}
    for doc, item, start, end, edits in decontaminate.occurrences(texts, index):
        found.setdefault((doc, item), (edits, start, end))
    low = [t.lower().replace("\n", " ") for t in texts]
    for d, text in enumerate(low):
        for k, (_, item) in enumerate(items):
            e, bound = decontaminate.budget(len(item))
            if bound < 1:
                continue
            best = least_edits(item.lower(), text)
            assert ((d, k) in found) == (best <= e), (d, k, best, e)
            if best <= e:
                edits, start, end = found[d, k]
                assert edits == best and least_edits(item.lower(), text[start:end]) == best
                assert abs(end - start - len(item)) <= best


def test_budget_always_selects():
    for m in range(8, 2000):
        e, bound = decontaminate.budget(m)
        assert bound >= 1 and e <= m * decontaminate.EDIT_RATE


def test_short_texts_are_allowed_a_tenth_too():
    """Texts of 8 to 45 characters: every occurrence within a tenth of edits, and none beyond."""
    rng = random.Random(11)
    for m in range(8, 46):
        e, bound = decontaminate.budget(m)
        assert e == m // 10 and bound >= 1
        items = [(k, "".join(rng.choice("abcdefg hij") for _ in range(m))) for k in range(3)]
        index = decontaminate.build_index(items)
        for edits in range(e + 2):
            for _ in range(6):
                k, item = rng.choice(items)
                text = prose(rng, 5) + edited(rng, item, edits) + prose(rng, 5)
                found = {i: x for _, i, _, _, x in reversed(decontaminate.occurrences([text], index))}
                for i, (_, other) in enumerate(items):
                    best = least_edits(other, text)
                    assert (i in found) == (best <= e), (m, text, other, best)


def test_high_rates_leave_a_bound():
    for rate in (0.0, 0.3, 0.9, 1.0):
        for m in range(1, 60):
            e, bound = decontaminate.budget(m, rate)
            assert e < m and bound >= 1
    item = "some words in a row"
    index = decontaminate.build_index([(1, item)], rate=0.3)
    assert decontaminate.occurrences(["xx s0me wrds iin a r0w yy"], index)[0][4] == 4
    assert not decontaminate.occurrences(["nothing to see"], index)


def test_query_finds_every_exact_passage(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    rows = catalog.QUERIES["op10_qgram_decontamination"](spark, SF).collect()
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert exact and exact <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        best = least_edits(items[r.item_id].lower(), docs[r.doc_id][r.start:r.end].lower())
        assert best <= r.edits <= 0.1 * r.item_chars


def test_awkward_rows_and_blocks(spark):
    rng = random.Random(5)
    item = prose(rng, 25)
    rows = [(1, "x " + item), (1, "x " + item), (2, None), (None, item + " y"), (3, ""), (4, "z" * 200_000 + item),
            (5, prose(rng, 50)), (6, item[: len(item) // 2])]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "short"), (4, prose(rng, 40))],
                                  "item_id long, text string")
    for chars in (decontaminate.BLOCK_CHARS, 10):  # one block, and one block per text
        got = decontaminate.find_passages(docs, bench, block_chars=chars).collect()
        assert sorted((str(r.doc_id), r.item_id) for r in got) == sorted(
            [(i, 1) for i in ("1", "1", "None", "4")] * 2)
        clean = decontaminate.decontaminate(docs, bench, block_chars=chars)
        assert clean.columns == docs.columns
        assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 5, 6]
    none = docs.where("false")
    assert decontaminate.find_passages(none, bench).count() == 0
    assert decontaminate.find_passages(docs, bench.where("false")).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("false")).count() == len(rows)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_grams_of_short_texts(size):
    assert len(decontaminate.grams(np.arange(size, dtype=np.uint8))) == 0


def test_overlaps_are_sought_among_all_occurrences(monkeypatch):
    item = "abcdefghijklmnopqrstuvwx"
    index = decontaminate.build_index([(1, item)])
    real = decontaminate.align

    def with_worse(index, whole, item, offset, lo, hi):
        edits, start, end = real(index, whole, item, offset, lo, hi)
        again = np.flatnonzero(edits >= 0)[:1]  # the first occurrence once more, one edit worse
        edits[again[0] + 1], start[again[0] + 1], end[again[0] + 1] = 1, start[again[0]], end[again[0]] + 1
        return edits, start, end

    monkeypatch.setattr(decontaminate, "align", with_worse)
    text = (item + " 0123456789 ") * 200
    kept = decontaminate.occurrences([text], index)
    places = sorted((s, e) for _, _, s, e, _ in kept)
    assert len(kept) >= 199 and all(a[1] <= b[0] for a, b in zip(places, places[1:]))


def test_short_items_are_found_exactly(spark):
    bench = spark.createDataFrame([(1, "Ab c"), (2, "é"), (3, ""), (4, "aa"), (5, "seven77"), (6, "Ab c")],
                                  "item_id long, text string")
    rows = [(1, "x aB\tc y"), (2, "cafés"), (3, "abc"), (4, "aaa"), (5, "a"), (6, "end seven77"), (7, "seven7")]
    docs = frame(spark, rows)
    got = {(r.doc_id, r.item_id, r.start, r.end, r.edits) for r in decontaminate.find_passages(docs, bench).collect()}
    assert got == {(1, 1, 2, 6, 0), (1, 6, 2, 6, 0), (2, 2, 3, 4, 0), (4, 4, 0, 2, 0), (6, 5, 4, 11, 0)}
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()) == [3, 5, 7]
