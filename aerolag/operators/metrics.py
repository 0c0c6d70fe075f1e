"""Classification metrics as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolag.functions.scalar import ratio
from aerolag.schema import LABEL
from aerolag.sources.stage import stage_table

METRICS = ("precision", "recall", "accuracy", "mean_pr", "f1", "fbeta")


def _counts(label: Column, positive: Column) -> list[Column]:
    return [
        F.count_if((label == 1) & positive).alias("tp"),
        F.count_if((label == 0) & positive).alias("fp"),
        F.count_if((label == 1) & ~positive).alias("fn"),
        F.count_if((label == 0) & ~positive).alias("tn"),
    ]


def confusion(df: DataFrame, label: str = LABEL, pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """True and false positives and negatives in one aggregate, per group.

    Rows without a label or a prediction do not count.
    """
    return df.groupBy(*by).agg(*_counts(F.col(label), F.col(pred) == 1))


def metrics(conf: DataFrame, beta: float = 0.5) -> DataFrame:
    """Metrics next to the four counts; 0 where a denominator is 0.

    ``mean_pr`` is the mean of precision and recall, ``f1`` their harmonic mean.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    weight = beta * beta
    return conf.withColumns({
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
    }).withColumns({
        "mean_pr": (F.col("precision") + F.col("recall")) / 2,
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "fbeta": ratio((1 + weight) * tp, (1 + weight) * tp + fp + weight * fn),
    })


def long_metrics(table: DataFrame, keys: Sequence[str], names: Sequence[str] = METRICS) -> DataFrame:
    """One row per key, metric name and value."""
    return table.unpivot(list(keys), list(names), "metric", "value")


def weighted_fold_mean(table: DataFrame, names: Sequence[str] = METRICS, by: Sequence[str] = ("split",)) -> DataFrame:
    """Mean over folds in which later folds weigh more: fold number plus one."""
    weight = F.col("foldCol") + 1
    return table.groupBy(*by).agg(*[(F.sum(F.col(m) * weight) / F.sum(weight)).alias(m) for m in names])


def fold_stability(table: DataFrame, names: Sequence[str] = METRICS, by: Sequence[str] = ("split",)) -> DataFrame:
    """Sample standard deviation of each metric over folds."""
    return table.groupBy(*by).agg(*[F.stddev_samp(m).alias(m) for m in names])


def positive_probability(df: DataFrame, probability: str = "probability", out: str = "p1") -> DataFrame:
    """Probability of class 1 as a number."""
    return df.withColumn(out, vector_to_array(probability)[1])


def at_threshold(df: DataFrame, threshold: float, p1: str = "p1") -> DataFrame:
    """Predict class 1 when its probability exceeds the threshold."""
    return df.withColumn("prediction", F.when(F.col(p1) > threshold, 1.0).otherwise(0.0))


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], label: str = LABEL, p1: str = "p1", beta: float = 0.5) -> DataFrame:
    """Metrics at several decision thresholds from one scan."""
    wide = df.agg(*[
        F.struct(*_counts(F.col(label), F.col(p1) > t)).alias(f"t{i}") for i, t in enumerate(thresholds)
    ])
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}").alias("c")) for i, t in enumerate(thresholds)])
    return metrics(wide.select(F.explode(rows).alias("r")).select("r.threshold", "r.c.*"), beta)


def ranking_table(df: DataFrame, score: str, label: str = LABEL, pred: str = "prediction") -> DataFrame:
    """(auc_roc, f1_macro, f1_weighted) in one row, from one pass over the rows.

    The area is exact: the share of pairs of a positive and a negative row in
    which the positive one scores higher, half for ties. Rows are counted per
    score before they move; the scores are range-sorted and written once, and
    negatives below a score are those of the partitions before it and those
    before it in its own. Null without both classes. Rows without a label, a
    score or a prediction do not count.
    """
    positive = F.col(pred) == 1
    by_score = (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & F.col(pred).isNotNull())
        .groupBy(F.col(score).alias("score")).agg(*_counts(F.col(label), positive))
        .withColumns({"pos": F.col("tp") + F.col("fn"), "neg": F.col("fp") + F.col("tn")})
    )
    placed = stage_table(by_score.orderBy("score").withColumn("__part", F.spark_partition_id()), "scores")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    below_part = placed.groupBy("__part").agg(F.sum("neg").alias("n")).select(
        "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__below"))
    inside = Window.partitionBy("__part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort, so always small.
    ranked = placed.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(F.broadcast(below_part), "__part")
    below = (F.col("below") + F.col("__below")) * 2 + F.col("neg")
    # Twice the number of pairs, which may pass 64 bits.
    pairs = F.sum(F.col("pos").cast("decimal(19,0)") * below.cast("decimal(19,0)"))
    total = ranked.agg(pairs.alias("pairs"), *[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp", "fn", "tn")])
    tp, fp, fn, tn, pos, neg = (F.col(c) for c in ("tp", "fp", "fn", "tn", "pos", "neg"))
    f1, f0 = ratio(2 * tp, 2 * tp + fp + fn), ratio(2 * tn, 2 * tn + fn + fp)
    area = F.col("pairs").cast("double") / (2.0 * pos.cast("double") * neg.cast("double"))
    return total.select(
        F.when((pos > 0) & (neg > 0), area).alias("auc_roc"),
        ((f1 + f0) / 2).alias("f1_macro"),
        ratio(f1 * pos + f0 * neg, pos + neg).alias("f1_weighted"),
    )


def ranking_scores(df: DataFrame, label: str = LABEL) -> dict[str, float]:
    """Exact area under the ROC curve of a model's raw scores, and F1 averaged over the two classes."""
    scored = df.withColumn("__score", vector_to_array("rawPrediction")[1])
    return ranking_table(scored, "__score", label).first().asDict()
