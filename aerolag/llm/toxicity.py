"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features of a text are densities: of a lexicon's terms, of such terms near
a second-person word, of capitals, punctuation and obfuscated words. The lexicon
is learned from labelled rows: words and word beginnings that are far more
frequent in toxic documents. Everything that is fitted comes from a bounded
sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.sources.stage import Stages

# At most about so many labelled rows are fitted on; beyond it, rows are taken by a hash of their id.
MAX_ROWS = 200_000
CALIBRATION_SHARE = 0.25
# A term of the lexicon: in so many toxic documents, so many times as often as in others, and by so many
# standard errors of the log-odds. None of them moves with the number of labels.
LEAST_DOCS, LEAST_LIFT, LEAST_ERRORS = 4, 8.0, 2.5
BEGINNINGS = (4, 5)
NEAR = 5  # words between a lexicon term and a second-person word
THRESHOLD = 0.7
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie "
    "usted ustedes tú ti tus su vosotros".split())
PLAIN = str.maketrans("013457@$", "oieastas")
WORD = re.compile(r"[^\W\d_]+")
# Signs inside a word, and letters parted by signs; both begin with a rare character.
MASK = re.compile(r"[0-9@$*#]+(?=[A-Za-z])")
PARTED = re.compile(r"(?:[.\-_*][A-Za-z]){2,}(?![A-Za-z])")
CAPITALS = re.compile(r"[A-ZÀ-Þ]+")
# Marks other than the question mark, which also stands for characters beyond Latin-1 here.
MARKS = np.frombuffer(b".,;:!#$%&*()[]{}<>/\\|@^~\"'", np.uint8)
FEATURES = ["lexicon", "weight", "kinds", "hits", "near_you", "you", "capitals", "shouted", "exclaimed", "asked",
            "punctuation", "obfuscated", "unmasked", "drawn"]


def terms_of(word: str) -> list[str]:
    """What of a lower-case word can stand in the lexicon: itself, and its marked beginnings."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) >= n]]


class Lexicon:
    """Terms with their weights, whole words and word beginnings apart."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.words = {t: x for t, x in terms.items() if not t.endswith("*")}
        self.beginnings = {n: {t[:-1]: x for t, x in terms.items() if t.endswith("*") and len(t) == n + 1}
                           for n in BEGINNINGS}

    def weight(self, word: str) -> float:
        return max(self.words.get(word, 0.0), *[b.get(word[:n], 0.0) for n, b in self.beginnings.items()])

    def found(self, words: Counter) -> dict[str, float]:
        hit = set(words.keys() & self.words.keys())
        for n, known in self.beginnings.items():
            hit.update([w for w in words if w[:n] in known])
        return {w: self.weight(w) for w in hit}


def _masked(text: str) -> list[str]:
    """Words with signs or digits inside, and single letters parted by signs."""
    out, last = [], 0
    for m in MASK.finditer(text):
        at = m.start()
        if at >= last and at and text[at - 1].isascii() and text[at - 1].isalpha():
            first, last = at - 1, m.end()
            while first and text[first - 1].isalnum():
                first -= 1
            while last < len(text) and (text[last].isalnum() or text[last] in "@$*#"):
                last += 1
            out.append(text[first:last])
    for m in PARTED.finditer(text):
        if m.start() and text[m.start() - 1].isalpha() and not text[max(0, m.start() - 2):m.start() - 1].isalpha():
            out.append(text[m.start() - 1:m.end()])
    return out


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The dense features of one text, in the order of FEATURES; all 0 for an empty or null one."""
    text = text or ""
    low = text.lower()
    words = WORD.findall(low)
    counts = Counter(words)
    n = max(1, len(words))
    toxic = lexicon.found(counts)
    hits = sum(counts[w] for w in toxic)
    second = sum(counts[w] for w in SECOND_PERSON if w in counts)
    near = 0
    if hits and second:
        last = -NEAR - 1
        waiting: list[int] = []
        for i, w in enumerate(words):
            if w in SECOND_PERSON:
                near += sum(i - j <= NEAR for j in waiting)
                waiting, last = [], i
            elif w in toxic:
                if i - last <= NEAR:
                    near += 1
                else:
                    waiting = [j for j in waiting if i - j <= NEAR] + [i]
    masked = _masked(text)
    plain = [re.sub("[^a-z]", "", m.translate(PLAIN).lower()) for m in masked]
    unmasked = sum(lexicon.weight(w) > 0 for w in plain)
    codes = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
    tally = np.bincount(codes, minlength=256)
    runs = CAPITALS.findall(text)
    same = (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2]) & (codes[2:] >= 65) & (codes[2:] != 95)
    return [
        hits / n, sum(counts[w] * x for w, x in toxic.items()) / n, len(toxic) / max(1, len(counts)), float(hits),
        near / n, second / n, sum(map(len, runs)) / max(1, sum(map(len, words))), sum(len(r) > 2 for r in runs) / n,
        float(tally[33]) / n, text.count("?") / n,
        float(tally[MARKS].sum()) / max(1, len(text)), len(masked) / n, unmasked / n, float(same.sum()) / n,
    ]


def feature_column(text: Column, terms: dict[str, float]) -> Column:
    lexicon = Lexicon(terms)

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(features(t, lexicon)) for t in texts])

    return run(text)


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, bad, good): documents of either label that hold each term, summed per batch before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[float, Counter] = {1.0: Counter(), 0.0: Counter()}
            for text, label in zip(batch.column(0), batch.column(1)):
                words = set(WORD.findall((text.as_py() or "").lower()))
                found[label.as_py()].update({t for w in words for t in terms_of(w)})
            terms = list(found[1.0] | found[0.0])
            counts = [pa.array([found[label][t] for t in terms], pa.int64()) for label in (1.0, 0.0)]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *counts], names=["term", "bad", "good"])

    counted = rows.select("text", "label").mapInArrow(run, "term string, bad long, good long")
    return counted.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms with their log-odds, from labelled rows (text, label).

    Copies of a text count once. A term must be in a few toxic documents, in a far
    larger share of them than of the others, and by more than chance would make it.
    All terms are judged, and all that pass are taken: a word as rare among many
    labels as among few is learned alike.
    """
    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n, other = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.ln(n / (sizes.get(1.0, 0) + 1)) - F.ln(other / (sizes.get(0.0, 0) + 1))
    found = _term_counts(rows).where(F.col("bad") >= LEAST_DOCS).withColumn("odds", odds)
    found = found.where((F.col("odds") >= float(np.log(LEAST_LIFT)))
                        & (F.col("odds") >= LEAST_ERRORS * F.sqrt(1 / n + 1 / other)))
    return {r["term"]: r["odds"] for r in found.select("term", "odds").orderBy("term").collect()}


@dataclass
class Scorer:
    """What was fitted. Without both labels to learn from, every score is ``base``."""

    lexicon: dict[str, float]
    base: float
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None

    def score(self, df: DataFrame, features_col: str, name: str) -> DataFrame:
        """Add the calibrated score, 0 to 1. The trees' own order breaks ties between equal steps."""
        if self.trees is None:
            return df.withColumn(name, F.lit(self.base))
        out = self.trees.transform(df.withColumn("__vector", array_to_vector(F.col(features_col))))
        out = out.withColumn("__raw", vector_to_array("__probability")[1])
        if self.steps is None:
            return out.withColumn(name, F.col("__raw")).drop(*_TEMPORARY)
        out = self.steps.transform(out)
        blend = F.lit(0.99) * F.least(F.greatest(F.col("__step"), F.lit(0.0)), F.lit(1.0)) + F.lit(0.01) * F.col("__raw")
        return out.withColumn(name, blend).drop(*_TEMPORARY)


_TEMPORARY = ["__vector", "__margin", "__probability", "__guess", "__raw", "__step"]


def sampled_labels(labels: DataFrame, id_col: str, label_col: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """(id, label), one row per labelled id, about ``max_rows`` at most, by a hash of the id.

    Rows with a null id or label do not count; an id with both labels is toxic.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("double").alias("label"))
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("id", F.lit("rows")), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    return known


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_rows: int = MAX_ROWS) -> Scorer:
    """Learn lexicon, trees and calibration from the labelled documents."""
    stages = Stages(docs.sparkSession)
    with stages:
        # bounded by max_rows, so it may be broadcast
        chosen = stages.put(sampled_labels(labels, id_col, label_col, max_rows), "labels")
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        rows = stages.put(texts.join(F.broadcast(chosen), "id"), "labelled")
        counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
        total = sum(counts.values())
        if len(counts) < 2:
            return Scorer({}, max(counts, default=0.0) if total else 0.0)
        lexicon = learn_lexicon(rows)
        ready = stages.put(rows.select(
            "id", "label", array_to_vector(feature_column(F.col("text"), lexicon)).alias("__vector")), "features")
        part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(1000)) < int(1000 * CALIBRATION_SHARE)
        trees = GBTClassifier(
            featuresCol="__vector", labelCol="label", predictionCol="__guess", maxIter=20, maxDepth=3, stepSize=0.3,
            subsamplingRate=0.8, minInstancesPerNode=4, minInfoGain=0.005, seed=7)
        trees = trees.setRawPredictionCol("__margin").setProbabilityCol("__probability")
        learned, held = ready.where(~part), ready.where(part)
        seen = {r["label"] for r in learned.select("label").distinct().collect()}
        model = trees.fit(learned if len(seen) == 2 else ready)
        scored = model.transform(held).select(vector_to_array("__probability")[1].alias("__raw"), "label")
        kinds = {r["label"] for r in scored.select("label").distinct().collect()}
        if len(kinds) < 2:
            return Scorer(lexicon, 0.0, model)
        steps = IsotonicRegression(featuresCol="__raw", labelCol="label", predictionCol="__step").fit(scored)
        return Scorer(lexicon, 0.0, model, steps)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row. Null text counts as empty; repeated rows are kept."""
    rows = docs.select(F.col(id_col).alias("__id"), feature_column(F.col(text_col), scorer.lexicon).alias("__features"))
    return scorer.score(rows, "__features", "score").select(
        F.col("__id").alias(id_col), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """Documents scored below the threshold, with all their columns; no shuffle."""
    rows = docs.withColumn("__features", feature_column(F.col(text_col), scorer.lexicon))
    return scorer.score(rows, "__features", "__score").where(F.col("__score") < THRESHOLD).select(*docs.columns)
