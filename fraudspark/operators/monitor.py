"""Monitoring tables over a prediction log
(fraud_probability, decision, isFraud, TransactionAmt, batch[, event time])."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .joins import null_safe_join
from .ordering import exact_quantiles, prefix_sums

# The drift rule compares the batch mean with baseline + 2 sd,
# the baseline being the mean of the first 3 batch means.
BASELINE_BATCHES = 3
SIGMAS = 2.0


def _metric_aggs(prob: str, decision: str, label: str) -> list[Column]:
    labelled = F.col(label).isNotNull()
    flagged = labelled & F.col(decision).isin("DECLINE", "REVIEW")
    n_lab = F.count_if(labelled)
    n_flag = F.count_if(flagged)
    return [
        F.count(F.lit(1)).alias("n_transactions"),
        F.avg((F.col(decision) == "APPROVE").cast("double")).alias("pct_approve"),
        F.avg((F.col(decision) == "REVIEW").cast("double")).alias("pct_review"),
        F.avg((F.col(decision) == "DECLINE").cast("double")).alias("pct_decline"),
        F.avg(prob).alias("score_mean"),
        F.avg(F.when(labelled, F.col(label).cast("double"))).alias("actual_fraud_rate"),
        F.when(n_lab == 0, F.lit(None).cast("double"))
         .when(n_flag == 0, F.lit(0.0))
         .otherwise(F.sum(F.when(flagged & (F.col(label) == 0), 1.0).otherwise(0.0)) / n_flag)
         .alias("false_positive_rate"),
    ]


def monitor_metrics(log: DataFrame, prob: str = "fraud_probability", decision: str = "decision",
                    label: str = "isFraud", group_cols: Sequence[str] = ()) -> DataFrame:
    """Decision shares, mean and exact p95 score, label rate on labelled rows and
    the legitimate share of flagged rows (``false_positive_rate``: 1 - precision).
    An empty log gives no row."""
    g = list(group_cols)
    m = log.groupBy(*g).agg(*_metric_aggs(prob, decision, label)).where(F.col("n_transactions") > 0)
    p95 = exact_quantiles(log, prob, [0.95], g).select(*g, F.col("quantile").alias("score_p95"))
    return null_safe_join(m, p95, g, "left")


def monitor_by_window(log: DataFrame, ts: str, duration: str = "1 hour", **kw) -> DataFrame:
    """The same metrics per tumbling event-time window."""
    w = log.withColumn("window_start", F.window(F.col(ts), duration).start)
    return monitor_metrics(w, group_cols=["window_start"], **kw)


def score_histogram(log: DataFrame, prob: str = "fraud_probability", bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equal bins on [0, 1]; a score of exactly 1 lands in the last bin."""
    b = F.least(F.floor(F.col(prob) * bins) + 1, F.lit(bins)).cast("int")
    return log.where(F.col(prob).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def value_histogram(df: DataFrame, value: str, bins: int = 100, group_cols: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the column's min and max (one extra aggregation pass)."""
    lo, hi = df.agg(F.min(value), F.max(value)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, n bigint")
    width = (hi - lo) or 1.0
    b = F.least(F.floor((F.col(value) - F.lit(lo)) / F.lit(width) * bins) + 1, F.lit(bins)).cast("int")
    return (df.where(F.col(value).isNotNull()).groupBy(*group_cols, b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def decisions_by_batch(log: DataFrame, decision: str = "decision", batch: str = "batch") -> DataFrame:
    return log.groupBy(batch, decision).agg(F.count(F.lit(1)).alias("count"))


def mean_score_by_batch(log: DataFrame, prob: str = "fraud_probability", batch: str = "batch") -> DataFrame:
    return log.groupBy(batch).agg(F.avg(prob).alias("mean_score"))


def drift_alarm(log: DataFrame, prob: str = "fraud_probability", batch: str = "batch") -> DataFrame:
    """Per batch: mean score, baseline (mean of the first three batch means),
    running sample sd of all batch means so far (current included), the
    2-sigma line and the alarm (needs more than 3 batches; a baseline of zero counts).

    Running moments come from ``prefix_sums`` over the batch-mean table, so
    the rule holds for any number of batches without a single-task window.
    """
    return drift_alarm_from_means(mean_score_by_batch(log, prob, batch), batch)


def drift_alarm_from_means(batch_means: DataFrame, batch: str = "batch") -> DataFrame:
    """The drift rule over a (batch, mean_score) table (a stream's running table, say)."""
    means = materialize(batch_means.select(batch, "mean_score"), "batch_means")
    first = [r["mean_score"] for r in means.orderBy(batch).limit(BASELINE_BATCHES).collect()]
    known = [m for m in first if m is not None]
    baseline = sum(known) / len(known) if len(first) == BASELINE_BATCHES and known else None
    # sums of deviations from the baseline: no digits are lost to a large mean
    dev = F.col("mean_score") - F.lit(baseline if baseline is not None else 0.0)
    seen = F.col("mean_score").isNotNull().cast("double")
    cum = prefix_sums(means.select("*", F.lit(1.0).alias("_one"), seen.alias("_k"), dev.alias("_d"),
                                   (dev * dev).alias("_d2")), [batch], ["_one", "_k", "_d", "_d2"])
    k, s, ss = F.col("_k_cum"), F.col("_d_cum"), F.col("_d2_cum")
    sd = F.when(k > 1, F.sqrt(F.greatest((ss - s * s / k) / (k - 1), F.lit(0.0))))
    bl = F.lit(baseline).cast("double")
    line = bl + SIGMAS * sd
    alarm = F.coalesce((F.col("_one_cum") > BASELINE_BATCHES) & (F.col("mean_score") > line), F.lit(False))
    return cum.select(batch, "mean_score", bl.alias("baseline"), sd.alias("running_sd"),
                      line.alias("alert_line"), alarm.alias("alarm"))
