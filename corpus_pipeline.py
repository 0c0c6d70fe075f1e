"""A corpus pipeline of five stages, each one operator applied to what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.llm import decontaminate, packing, secrets, simhash, toxicity
from aerolag.llm.common import table
from aerolag.sources.stage import Stages

# The stages' decisions are a model's, a fixpoint's and an alignment's, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer does not reject. It learns from all labels."""
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, scorer)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class, the document of least id; of rows that share it, one."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark text occurs."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark, and n_chars as the text then is."""
    clean = secrets.redact_documents(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 1024."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each one's result is a stage table that the next reads."""
    docs = table(spark, sf_dir, "documents")
    stages = Stages(spark)
    for name, stage in STAGES[:-1]:
        docs = stages.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
