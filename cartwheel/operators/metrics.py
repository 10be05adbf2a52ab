"""Classifier evaluation as relational jobs.

ROC needs cumulative positive / negative counts in score order. A window
ordered over the whole table would run in one task, so the running sums are
computed in two levels: scores are cut into ``buckets`` ranges at approximate
quantiles (only the partitioning depends on them - results are exact for any
cut points), each range is summed and ordered in its own task, and the
per-range totals (``buckets`` rows) give each range its starting offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def confusion_matrix(pred: DataFrame, label: str = "label_index", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, cnt)."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("cnt"))


def multiclass_metrics(pred: DataFrame, label: str = "label_index", prediction: str = "prediction") -> DataFrame:
    """Accuracy, weightedPrecision, weightedRecall, f1 (weighted F-measure)
    with the MulticlassClassificationEvaluator definitions: per true label
    l, weight = share of rows with label l; precision is 0 when l is never
    predicted. The predictions are reduced once to the confusion matrix (at
    most classes^2 rows, written to the shared folder); every metric is
    derived from that small table, so the prediction job runs once."""
    cm = cut_lineage(confusion_matrix(pred, label, prediction), "confusion")
    n = cm.agg(F.sum("cnt")).scalar()
    tp = cm.filter(F.col("label") == F.col("prediction")).select("label", F.col("cnt").alias("tp"))
    actual = cm.groupBy("label").agg(F.sum("cnt").alias("actual"))
    predicted = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("cnt").alias("predicted"))
    per = (actual.join(tp, "label", "left").join(predicted, "label", "left").na.fill(0, ["tp", "predicted"])
           .select("label", "actual", "tp",
                   F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")),
                              F.lit(0.0)).alias("p"),
                   (F.col("tp") / F.col("actual")).alias("r")))
    per = per.withColumn("f", F.when(F.col("p") + F.col("r") == 0, F.lit(0.0))
                         .otherwise(2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))))
    w = F.col("actual") / n
    agg = per.agg((F.sum("tp") / n).alias("accuracy"), F.sum(w * F.col("p")).alias("weightedPrecision"),
                  F.sum(w * F.col("r")).alias("weightedRecall"), F.sum(w * F.col("f")).alias("f1"))
    return agg.unpivot([], ["accuracy", "weightedPrecision", "weightedRecall", "f1"], "metric", "value")


def misclassified(pred: DataFrame, label: str = "label_index", prediction: str = "prediction") -> DataFrame:
    """Rows whose prediction differs from the label."""
    return pred.filter(F.col(label) != F.col(prediction))


def running_totals(df: DataFrame, order: str, cols: list[str], buckets: int = 64) -> DataFrame:
    """Exact inclusive running sums of ``cols`` in descending ``order``,
    one input row per distinct ``order`` value. Distributed: see module doc."""
    if buckets <= 1:
        banded = df.withColumn("band", F.lit(0))
    else:
        cuts = df.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], max(1000, 10 * buckets))
                      .alias("cuts")).scalar()
        # band 0 holds the highest scores; the cut array is projected before the
        # lambda that reads it (a subquery may not sit inside a lambda). A NULL
        # cut array (no rows) puts everything in one band.
        below = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col(order))), F.lit(0))
        banded = (df.withColumn("cuts", cuts).withColumn("band", (F.lit(buckets - 1) - below).cast("int"))
                  .drop("cuts"))
    totals = banded.groupBy("band").agg(*[F.sum(c).alias(f"{c}_band") for c in cols])
    prev = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("band", *[F.coalesce(F.sum(f"{c}_band").over(prev), F.lit(0)).alias(f"{c}_off")
                                      for c in cols])                  # <= buckets rows
    inner = Window.partitionBy("band").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    out = banded.join(F.broadcast(offsets), "band")
    return out.select(order, *cols, *[(F.col(f"{c}_off") + F.sum(c).over(inner)).alias(f"cum_{c}") for c in cols])


BAND_ROWS = 250_000         # distinct scores that one task sums up, about


def roc_points(scored: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None):
    """Per distinct score: pos, neg and their running sums from the highest
    score down, plus the totals (P, N) as scalar columns. The per-score table
    is read by several passes, so it is checkpointed once."""
    per = cut_lineage(scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg")), "roc_points")
    p = per.agg(F.sum("pos")).scalar()
    n = per.agg(F.sum("neg")).scalar()
    buckets = buckets or max(64, per.count() // BAND_ROWS)      # bands follow the number of scores
    return running_totals(per, "threshold", ["pos", "neg"], buckets), p, n


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None) -> DataFrame:
    """One ROC point per distinct score, highest first: (threshold, fpr, tpr)."""
    cum, p, n = roc_points(scored, score, label, buckets)
    return cum.select("threshold", F.try_divide(F.col("cum_neg").cast("double"), n.cast("double")).alias("fpr"),
                      F.try_divide(F.col("cum_pos").cast("double"), p.cast("double")).alias("tpr"))


def auc(scored: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule from (0, 0). Between a
    point and its predecessor, fpr grows by neg_i / N and tpr_i + tpr_(i-1)
    = (2 cum_pos_i - pos_i) / P, so the area is
    sum(neg_i (2 cum_pos_i - pos_i)) / (2 N P) - one pass over the running
    sums, integer arithmetic until the final division."""
    cum, p, n = roc_points(scored, score, label, buckets)
    area = F.sum(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos")))
    return cum.agg(F.try_divide(area.cast("double"), (2 * n * p).cast("double")).alias("auc"))
