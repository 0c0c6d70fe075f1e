"""The operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolag.llm import codes, cws, decontaminate, fixity, packing, pii, secrets, shards, simhash, topk, toxicity, trie, urls
from aerolag.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op8_simhash_pivots")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


@query("op4_secret_ledger")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


@query("op5_jump_hash_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), 8)


@query("op9_pii_spans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


@query("op3_url_filter_cascade", urls.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op6_merkle_fixity", fixity.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the pages against a replica with known damage."""
    pages = table(spark, sf_dir, "pages")
    found = fixity.audit(fixity.records(pages), fixity.records(fixity.damaged(pages)))
    return found.withColumnRenamed("id", "page_id")


@query("op10_qgram_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark text in a document."""
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_cutting_stock_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op7_toxicity_gbt")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels of the held-out rows are not seen."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorer = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    out = toxicity.score_documents(docs, scorer)
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op1_weighted_sampling")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.compare_with_edits(table(spark, sf_dir, "documents"))


@query("op11_uniform_threshold_topk", topk.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), topk.every("vec_id", 20), k=20)


@query("op12_prefix_radix_trie", trie.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations rebuilt to share their first turns by groups of twenty."""
    return trie.build(trie.shared_heads(trie.turn_lists(table(spark, sf_dir, "conversations"))))


@query("op13_ball_kmeans_codes", codes.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))
