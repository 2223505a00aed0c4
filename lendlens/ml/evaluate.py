"""Model evaluation as distributed aggregates.

* ROC: rows are first aggregated to one row per distinct score (positives,
  negatives); cumulative sums in descending score order use the two-level
  running sum (range partitions + broadcast per-partition offsets), never a
  single-task window.
* AUC needs no ordered pass at all: a score point with ``pos`` positives and
  ``neg`` negatives, cumulative true positives ``tps`` (inclusive), adds the
  trapezoid ``neg · (2·tps − pos) / (2·P·N)``; the area is a plain sum.
* Youden's J: ``max_by`` over the ROC rows (highest threshold among ties).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.operators.window import global_running_sum
from lendlens.sources.tables import q


def score_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score (map-side combined)."""
    return (scored.groupBy(q(score).alias("threshold"))
            .agg(F.sum(q(label).cast("long")).alias("pos"),
                 (F.count(F.lit(1)) - F.sum(q(label).cast("long"))).alias("neg")))


def roc_curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """M7: one row per distinct threshold, descending: cumulative true and
    false positives (``score >= threshold``) and their rates."""
    counts = score_counts(scored, label, score)
    cum = global_running_sum(counts, [F.col("threshold").desc()], ["pos", "neg"], prefix="cum_")
    # class totals: one aggregate, two numbers brought back as literals
    tot = cum.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = (tot["P"] or 0), (tot["N"] or 0)
    return cum.select("threshold", "pos", "neg",
                      F.col("cum_pos").alias("tps"), F.col("cum_neg").alias("fps"),
                      F.try_divide(F.col("cum_pos").cast("double"), F.lit(float(P))).alias("tpr"),
                      F.try_divide(F.col("cum_neg").cast("double"), F.lit(float(N))).alias("fpr"))


def auc_from_roc(roc: DataFrame) -> DataFrame:
    """M8: area under the ROC curve from the curve rows (one aggregate)."""
    neg, tps, pos = (F.col(c).cast("double") for c in ("neg", "tps", "pos"))
    part = neg * (2 * tps - pos)  # DOUBLE: the product of two counts outgrows BIGINT
    return roc.agg(F.try_divide(F.sum(part), 2.0 * F.sum(neg) * F.max(tps)).alias("auc"))  # one class: NULL


def youden_threshold(roc: DataFrame) -> DataFrame:
    """M7: threshold maximising TPR − FPR (the highest one among ties)."""
    j = F.col("tpr") - F.col("fpr")
    return roc.agg(F.max_by("threshold", F.struct(j, F.col("threshold"))).alias("threshold"),
                   F.max(j).alias("youden_j"))


def predictions(scored: DataFrame, score: str, threshold: float | Column,
                name: str = "prediction") -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scored.withColumn(name, (q(score) >= t).cast("int"))


def classification_report(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M9: precision, recall, F1 and support per class, accuracy, macro and
    weighted averages — from one confusion-matrix aggregate."""
    lab, pred = q(label).cast("int"), q(prediction).cast("int")
    cm = scored.agg(F.count_if((lab == 1) & (pred == 1)).alias("tp"),
                    F.count_if((lab == 0) & (pred == 1)).alias("fp"),
                    F.count_if((lab == 1) & (pred == 0)).alias("fn"),
                    F.count_if((lab == 0) & (pred == 0)).alias("tn"))
    d = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p1, r1 = d(tp, tp + fp), d(tp, tp + fn)
    p0, r0 = d(tn, tn + fn), d(tn, tn + fp)
    f = lambda p, r: F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"),
                 f(p0, r0).alias("f1_score"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"),
                 f(p1, r1).alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), d(tp + tn, n).alias("f1_score"),
                 n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f(p0, r0) + f(p1, r1)) / 2).alias("f1_score"),
                 n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), d(p0 * s0 + p1 * s1, n).alias("precision"),
                 d(r0 * s0 + r1 * s1, n).alias("recall"),
                 d(f(p0, r0) * s0 + f(p1, r1) * s1, n).alias("f1_score"), n.alias("support")))
    return cm.select(F.explode(rows).alias("r")).select("r.*")


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M8: share of rows where prediction equals label."""
    return scored.agg(F.avg((q(label).cast("int") == q(prediction).cast("int")).cast("double"))
                      .alias("accuracy"))
