"""Small inputs with awkward rows, and plain counterparts."""

import hashlib

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("blob", T.StringType()), T.StructField("hits", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("size", T.StringType()),
])


def frame(spark, rows):
    """Documents from (doc_id, text) with clashing extra columns."""
    full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", "z", "w", "v", "u") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def joined(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], kinds.index(x[1]))))


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
