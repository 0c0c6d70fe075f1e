"""Toxicity on rows whose labels were not seen, and on awkward inputs."""

import zlib

import pytest

from aerolag.llm import catalog, toxicity
from aerolag.llm.common import table
from tests.llm.helpers import frame

SF = "/root/testdata/sf0.1"


def area(scores, labels):
    ranked = sorted(zip(scores, labels))
    below = wins = 0.0
    i = 0
    while i < len(ranked):
        j = i
        while j < len(ranked) and ranked[j][0] == ranked[i][0]:
            j += 1
        good = sum(1 - y for _, y in ranked[i:j])
        wins += (j - i - good) * (below + good / 2)
        below, i = below + good, j
    bad = sum(labels)
    return wins / (bad * (len(labels) - bad))


def test_held_out(spark):
    rows = {r.doc_id: r for r in catalog.QUERIES["op7_toxicity_gbt"](spark, SF).collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    unseen = [(rows[r.doc_id], r.toxic) for r in table(spark, SF, "labels").collect() if rows[r.doc_id].held_out]
    assert area([r.score for r, _ in unseen], [y for _, y in unseen]) > 0.97
    caught = [r.predicted for r, y in unseen if y]
    assert sum(caught) / len(caught) > 0.9
    assert sum(r.predicted for r, y in unseen if not y) <= 0.005 * len(unseen)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_awkward_inputs(spark):
    # texts differ, since copies count once when the lexicon is learned
    docs = [(i, f"you are a vile grub, really x{i}" if i % 4 == 0 else f"a calm day by the sea y{i}") for i in range(80)]
    docs += [(None, "vile grub"), (200, None), (201, ""), (5, docs[5][1]), (202, "word " * 200_000)]
    labels = [(i, int(i % 4 == 0)) for i in range(80)] + [(1, 0), (None, 1), (3, None), (999, 1)]
    df = frame(spark, docs)
    scorer = toxicity.fit(df, labelled(spark, labels))
    out = toxicity.score_documents(df, scorer).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out)
    assert {r.predicted for r in out if r.doc_id in range(0, 80, 4)} == {1}
    assert {r.predicted for r in out if r.doc_id in (1, 2, 3, 200, 201, 202)} == {0}
    kept = toxicity.keep_clean(df, scorer)
    assert kept.columns == df.columns and kept.count() == len(docs) - 21
    assert toxicity.score_documents(frame(spark, []), scorer).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)], [(999, 1)]])
def test_without_two_labels(spark, labels):
    df = frame(spark, [(1, "a b c"), (2, None)])
    scorer = toxicity.fit(df, labelled(spark, labels))
    assert {r.score for r in toxicity.score_documents(df, scorer).collect()} == {1.0 if labels == [(1, 1)] else 0.0}
    assert toxicity.fit(frame(spark, []), labelled(spark, labels)).trees is None


def test_bound_on_labels(spark):
    many = spark.range(5000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    assert 800 < toxicity.sampled_labels(many, "doc_id", "toxic", 1000).count() < 1200
    assert toxicity.sampled_labels(many.unionByName(many), "doc_id", "toxic").count() == 5000


@pytest.mark.parametrize("n", [40, 4000])
def test_rare_words_are_learned_at_any_size(spark, n):
    """A word in five toxic texts and no other, among few labels and among many; words of both labels never."""
    rows = [(f"common words x{i} {'skrelb' if i < 5 else ''} {'both' if i % 8 == 0 else ''}", 1.0) for i in range(n)]
    rows += [(f"common words y{i} {'both' if i % 8 == 0 else ''}", 0.0) for i in range(9 * n)]
    found = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label double"))
    assert "skrelb" in found and found["skrelb"] > 2 and not {"common", "words", "both", "x1"} & set(found)


def test_features():
    lexicon = toxicity.Lexicon({"grub": 3.0, "vile*": 2.0})
    names = dict(zip(toxicity.FEATURES, toxicity.features("You GRUB! vilest gr0ub g.r.u.b stay away, hmmmm", lexicon)))
    assert names["hits"] == 2 and names["near_you"] > 0 and names["obfuscated"] > 0 and names["drawn"] > 0
    assert names["unmasked"] > 0 and names["capitals"] > 0 and names["exclaimed"] > 0
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * len(toxicity.FEATURES)
