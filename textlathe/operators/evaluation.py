"""Classification evaluation as aggregations.

All metrics come from one pass over ``(label, prediction)``; ROC AUC is the
tie-aware rank statistic computed from per-score counts and a skew-safe
running sum (no global sort on one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .joins import segmented_running


def confusion_matrix(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    return pred.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction")) \
               .agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                           positive=1) -> DataFrame:
    """accuracy, precision, recall, f1 for the positive class (0 when a
    denominator is 0)."""
    y, p = F.col(label_col), F.col(pred_col)
    tp = F.count_if((y == positive) & (p == positive))
    fp = F.count_if((y != positive) & (p == positive))
    fn = F.count_if((y == positive) & (p != positive))
    m = pred.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == p).alias("ok"),
                 tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")), F.lit(0.0))
    return m.select((F.col("ok") / F.col("n")).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"))


def roc_auc(pred: DataFrame, label_col: str = "label", score_col: str = "score", positive=1) -> DataFrame:
    """Area under the ROC curve: sum over distinct scores of
    pos(s) * (neg below s + neg(s) / 2), over pos * neg."""
    y = F.col(label_col) == positive
    per = pred.groupBy(F.col(score_col).alias("s")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    run = segmented_running(per, [], [F.col("s")], sums={"neg_below": F.col("neg")}, inclusive=False)
    return run.agg((F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg")))
                    / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def threshold_gate(metrics: DataFrame, thresholds=K.THRESHOLDS) -> DataFrame:
    """(metric, value, threshold, passed) for each gated metric present."""
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                     F.lit(float(t)).alias("threshold"), (F.col(m) >= t).alias("passed"))
            for m, t in thresholds if m in metrics.columns]
    return metrics.select(F.inline(F.array(*rows)))


def predictions_from_docs(docs: DataFrame) -> DataFrame:
    """A deterministic scorer over the driver tables: score from the
    document length, label = quality."""
    score = (F.pmod(F.col("n_chars"), F.lit(997)) / 997.0)
    return docs.select("doc_id", F.col("quality").alias("label"), score.alias("score"),
                       (score >= 0.5).cast("int").alias("prediction"))
