"""The stages against what they must keep, one by one."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from aerolag.llm import secrets, simhash
from tests.llm.helpers import frame
from tests.llm.test_packing import plain, verify  # noqa: F401
from tests.llm.test_simhash import plain_classes
from tests.llm.test_spans import base_secrets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Rows after each stage, each written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "decontamination", "secret_scan", "packing"]
    for df in results[1:-1]:
        assert df.columns == results[0].columns


def test_toxic_documents_go(spark, results):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = texts(results[0]), texts(results[1])
    gone = before.keys() - after.keys()
    assert all(labels.get(i, 1) for i in gone)
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_class_stays(results):
    before, after = texts(results[1]), texts(results[2])
    classes = plain_classes([(i, simhash.fingerprint(t)) for i, t in before.items()])
    assert set(after) == {c for *_, c in classes}


def test_benchmark_passages_go(spark, results):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(results[2]), texts(results[3])
    assert not any(x in t for x in items for t in after.values())
    assert all(any(x[:40] in t or x[-40:] in t for x in items) for i, t in before.items() if i not in after)


def test_secrets_are_replaced(results):
    before, after = texts(results[3]), texts(results[4])
    assert before.keys() == after.keys()
    for i, t in before.items():
        if not base_secrets(t):
            assert after[i] == t
        assert not base_secrets(after[i])
    assert all(r.n_chars == len(r.text) for r in results[4].collect())


def test_packed(results, plain):  # noqa: F811
    verify(results[5].collect(), list(texts(results[4]).items()), plain)


def test_run_is_the_registered_query(spark, results):
    rows = entry.queries()["pipeline"](spark, SF)
    assert sorted(rows.columns) == sorted(results[5].columns)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, rows.select(key).collect())) == sorted(map(tuple, results[5].select(key).collect()))


def test_awkward_documents(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(1, "token=abcdefgh1 x"), (1, "token=abcdefgh1 x"), (2, None), (None, "some words of no account"), (3, ""),
            (5, item), (6, "a calm text about nothing at all"), (None, None)]
    docs = frame(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.where("false"), SF).count() == 0
    dedup = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in dedup) == ["1", "2", "5", "6", "None"]
    clean = dict(corpus_pipeline.STAGES)["secret_scan"](spark, docs, SF).collect()
    assert [r.text for r in clean if r.doc_id == 1] == ["[SECRET] x"] * 2 and len(clean) == len(rows)
    assert secrets.redact_documents(docs.where("false")).count() == 0


def test_one_row_per_class_whatever_its_id(spark):
    rows = [(None, "first text without any id at all"), (None, "another thing entirely, unlike the one before"),
            (None, "another thing entirely, unlike the one before"), (4, "the tide went out before noon that day"),
            (4, "machines of brass and copper hum below"), (None, "machines of brass and copper hum below"), (9, "x"),
            (3, "x")]
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, rows), SF)
    want = {rows[0], rows[1], rows[3], rows[4], rows[7]}
    assert sorted(map(repr, map(tuple, kept.select("doc_id", "text").collect()))) == sorted(map(repr, want))
