"""Ranking metrics over (score, label) tables, equal to the step-wise
definitions of the usual Python metric library: average precision as
sum of recall steps times precision, ROC-AUC with ties counted one half,
F1 at ``p >= t``, the precision-recall curve over distinct scores.

The curve is built from a group-by on the distinct score (ties collapse
into one row) and running sums along descending score from
``ordering.prefix_sums`` (range-partitioned, no single-task window).
Every metric is then one aggregation over the curve: recall steps are the
positives of each score group divided by all positives, so no lag window
is needed.  Optional ``group_cols`` (model, split, ...) evaluate many
tables in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import null_safe_join
from .ordering import prefix_sums

# Default decision threshold and the recall target of the SLA metric.
DEFAULT_THRESHOLD = 0.5
RECALL_TARGET = 0.80
# Fixed value: added to precision + recall in the sweep table.
F1_EPS = 1e-8


def curve_table(df: DataFrame, score: str = "p", label: str = "isFraud",
                group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): pos, neg, tp, fp (scores >= this one),
    the group totals P and N, precision and recall."""
    g = list(group_cols)
    groups = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(*g, F.col(score).alias("threshold"))
              .agg(F.sum(F.col(label).cast("double")).alias("pos"),
                   F.sum((1 - F.col(label)).cast("double")).alias("neg")))
    # descending score as the ascending order of its negation; sums restart per group
    keyed = groups.withColumn("_neg_t", -F.col("threshold"))
    cum = prefix_sums(keyed, ["_neg_t"], ["pos", "neg"], partition_by=g)
    # group totals from the written running sums, so the scores are computed once
    totals = cum.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    out = null_safe_join(cum, totals, g)
    tp, fp = F.col("pos_cum"), F.col("neg_cum")
    res = out.select(*g, "threshold", "pos", "neg", tp.alias("tp"), fp.alias("fp"), "P", "N")
    return res.select("*", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(F.lit(1.0)).alias("recall"))


def confusion(df: DataFrame, score: str = "p", label: str = "isFraud", threshold: float = DEFAULT_THRESHOLD,
              group_cols: Sequence[str] = ()) -> DataFrame:
    pred = F.col(score) >= threshold
    y = F.col(label) == 1
    return df.groupBy(*group_cols).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & ~y).alias("tn"), F.count_if(~pred & y).alias("fn"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    d = 2 * tp + fp + fn
    return F.when(d > 0, 2 * tp / d).otherwise(F.lit(0.0))


def eval_metrics(df: DataFrame, score: str = "p", label: str = "isFraud", threshold: float = DEFAULT_THRESHOLD,
                 group_cols: Sequence[str] = (), round_digits: int | None = 4,
                 recall_target: float = RECALL_TARGET) -> DataFrame:
    """pr_auc (average precision), roc_auc, f1, precision_at_80_rec,
    threshold_at_80_rec per group.  ``threshold_at_80_rec`` is the smallest
    threshold whose recall reaches the target (1.0 when none does)."""
    g = list(group_cols)
    cv = curve_table(df, score, label, g)
    P, N = F.first("P"), F.first("N")
    hit, flagged = F.col("recall") >= recall_target, F.col("threshold") >= threshold
    curve = cv.groupBy(*g).agg(
        F.sum(F.try_divide(F.col("pos"), F.col("P")) * F.col("precision")).alias("pr_auc"),
        # undefined with a single class: null instead of a divide error
        F.try_divide(F.sum(F.col("pos") * (F.col("N") - F.col("fp") + F.col("neg") / 2)),
                     F.when(P * N > 0, P * N)).alias("roc_auc"),
        F.coalesce(F.max(F.when(hit, F.col("precision"))), F.lit(0.0)).alias("precision_at_80_rec"),
        F.coalesce(F.min(F.when(hit, F.col("threshold"))), F.lit(1.0)).alias("threshold_at_80_rec"),
        F.coalesce(F.sum(F.when(flagged, F.col("pos"))), F.lit(0.0)).alias("_tp"),
        F.coalesce(F.sum(F.when(flagged, F.col("neg"))), F.lit(0.0)).alias("_fp"), P.alias("_P"))
    names = ("pr_auc", "roc_auc", "f1", "precision_at_80_rec", "threshold_at_80_rec")
    # the confusion at the threshold is a part of the curve: no second pass over the scores
    out = curve.select(*g, *[F.col(c) if c != "f1" else _f1(F.col("_tp"), F.col("_fp"), F.col("_P") - F.col("_tp"))
                             .alias("f1") for c in names])
    if round_digits is not None:
        out = out.select(*g, *[F.bround(c, round_digits).alias(c) for c in names])
    return out


def optimal_threshold(df: DataFrame, score: str = "p", label: str = "isFraud",
                      target_recall: float = RECALL_TARGET, default: float = DEFAULT_THRESHOLD,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """Highest precision among thresholds with recall >= target (lowest threshold
    on ties); ``default`` when none qualifies.  Reports recall at that threshold."""
    g = list(group_cols)
    cv = curve_table(df, score, label, g).where(F.col("recall") >= target_recall)
    best = cv.groupBy(*g).agg(F.min_by(F.struct("threshold", "precision", "recall"),
                                       F.struct(-F.col("precision"), F.col("threshold"))).alias("b"))
    best = best.select(*g, F.col("b.threshold").alias("threshold"), F.col("b.precision").alias("precision"),
                       F.col("b.recall").alias("recall"))
    if g:
        return best
    # no qualifying threshold -> the default row (best has at most one row)
    dflt = df.sparkSession.createDataFrame([(float(default), None, None)],
                                           "threshold double, precision double, recall double")
    return best.unionByName(dflt).orderBy(F.col("precision").isNull()).limit(1)


def classification_report(df: DataFrame, score: str = "p", label: str = "isFraud",
                          threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and weighted averages."""
    c = confusion(df, score, label, threshold)
    tp, fp, tn, fn = F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")

    def prf(t, f_p, f_n):
        p = F.when(t + f_p > 0, t / (t + f_p)).otherwise(F.lit(0.0))
        r = F.when(t + f_n > 0, t / (t + f_n)).otherwise(F.lit(0.0))
        f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
        return p, r, f

    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    tot = s0 + s1
    acc = (tp + tn) / tot
    row = c.select(
        F.array(
            _report_row("Legitimate", p0, r0, f0, s0),
            _report_row("Fraud", p1, r1, f1, s1),
            _report_row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, tot),
            _report_row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot),
            _report_row("weighted avg", (p0 * s0 + p1 * s1) / tot, (r0 * s0 + r1 * s1) / tot,
                        (f0 * s0 + f1 * s1) / tot, tot),
        ).alias("rows"))
    return row.select(F.explode("rows").alias("r")).select("r.*")


def _report_row(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
    return F.struct(F.lit(name).alias("label"), p.cast("double").alias("precision"),
                    r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                    support.cast("double").alias("support"))


def threshold_sweep(df: DataFrame, score: str = "p", label: str = "isFraud") -> DataFrame:
    cv = curve_table(df, score, label)
    p, r = F.col("precision"), F.col("recall")
    return cv.select("threshold", p.alias("precision"), r.alias("recall"),
                     (2 * p * r / (p + r + F1_EPS)).alias("f1"))


def calibration_bins(df: DataFrame, score: str = "p", label: str = "isFraud", n_bins: int = 10) -> DataFrame:
    """Reliability table: equal-width bins on [0, 1]; a score on an inner edge
    falls in the lower bin.  Empty bins are absent."""
    inner = [float(e) for e in np.linspace(0.0, 1.0, n_bins + 1)[1:-1]]
    b = sum((F.col(score) > F.lit(e)).cast("int") for e in inner) if inner else F.lit(0)
    return (df.where(F.col(score).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"),
                 F.avg(F.col(label).cast("double")).alias("fraction_positive")))
