"""Evaluation, decision, monitoring and exploration queries.

The score is the fixture's formula score ``p`` (deterministic, with ties), so
every metric has a DuckDB twin without training a model.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.scalar import portable_hash_sql
from ..operators import evaluate as ev
from ..operators import explore as ex
from ..operators import monitor as mo
from ..operators import ordering as od
from ..operators import quality as dq
from ..operators import score as sc
from ..operators import split as sp
from ..sources import tables as tb
from .catalog import r6, register, rounded, s6
from .queries_encode import _SPLIT_CTE

_CURVE = """
cg AS (SELECT p AS threshold, sum(isFraud) AS pos, count(*) - sum(isFraud) AS neg FROM scored GROUP BY p),
cv AS (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
              sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM cg),
cr AS (SELECT *, tp / (tp + fp) AS precision, CASE WHEN P > 0 THEN tp / P ELSE 1.0 END AS recall FROM cv)
"""


def _scored(spark, sf):
    return tb.scored(spark, sf)


@register("pr_curve", tb.with_views(f"""
WITH {_CURVE}
SELECT threshold, cast(tp AS bigint) AS tp, cast(fp AS bigint) AS fp, {s6('precision')} AS precision,
       {s6('recall')} AS recall FROM cr
""", "scored"))
def q_pr_curve(spark, sf):
    cv = ev.curve_table(_scored(spark, sf))
    return cv.select("threshold", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                     r6("precision").alias("precision"), r6("recall").alias("recall"))


_CONF = """
cf AS (SELECT count(*) FILTER (WHERE p >= 0.5 AND isFraud = 1) AS tp, count(*) FILTER (WHERE p >= 0.5 AND isFraud = 0) AS fp,
              count(*) FILTER (WHERE p < 0.5 AND isFraud = 0) AS tn, count(*) FILTER (WHERE p < 0.5 AND isFraud = 1) AS fn
       FROM scored)
"""


@register("confusion", tb.with_views(f"WITH {_CONF} SELECT tp, fp, tn, fn FROM cf", "scored"))
def q_confusion(spark, sf):
    return ev.confusion(_scored(spark, sf))


@register("eval_metrics", tb.with_views(f"""
WITH {_CURVE}, {_CONF}
SELECT {s6('sum(pos / P * precision)')} AS pr_auc,
       {s6('sum(pos * (N - fp + neg / 2.0)) / (max(P) * max(N))')} AS roc_auc,
       {s6('(SELECT CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END FROM cf)')} AS f1,
       {s6('coalesce(max(CASE WHEN recall >= 0.8 THEN precision END), 0.0)')} AS precision_at_80_rec,
       {s6('coalesce(min(CASE WHEN recall >= 0.8 THEN threshold END), 1.0)')} AS threshold_at_80_rec
FROM cr
""", "scored"))
def q_eval_metrics(spark, sf):
    return rounded(ev.eval_metrics(_scored(spark, sf), round_digits=None))


@register("eval_by_split", tb.with_views(f"""
WITH {_SPLIT_CTE},
s AS (SELECT p, isFraud, CASE WHEN rn <= floor(n * 0.85::double) THEN 'val' ELSE 'test' END AS split
      FROM sp WHERE rn > floor(n * 0.7::double)),
cg AS (SELECT split, p AS threshold, sum(isFraud) AS pos, count(*) - sum(isFraud) AS neg FROM s GROUP BY split, p),
cv AS (SELECT *, sum(pos) OVER (PARTITION BY split ORDER BY threshold DESC) AS tp,
              sum(neg) OVER (PARTITION BY split ORDER BY threshold DESC) AS fp,
              sum(pos) OVER (PARTITION BY split) AS P, sum(neg) OVER (PARTITION BY split) AS N FROM cg),
cr AS (SELECT *, tp / (tp + fp) AS precision, CASE WHEN P > 0 THEN tp / P ELSE 1.0 END AS recall FROM cv),
cf AS (SELECT split, count(*) FILTER (WHERE p >= 0.5 AND isFraud = 1) AS tp,
              count(*) FILTER (WHERE p >= 0.5 AND isFraud = 0) AS fp,
              count(*) FILTER (WHERE p < 0.5 AND isFraud = 1) AS fn FROM s GROUP BY split)
SELECT cr.split, {s6('sum(pos / P * precision)')} AS pr_auc,
       {s6('sum(pos * (N - cr.fp + neg / 2.0)) / (max(P) * max(N))')} AS roc_auc,
       {s6('max(CASE WHEN 2 * cf.tp + cf.fp + cf.fn > 0 THEN 2 * cf.tp / (2 * cf.tp + cf.fp + cf.fn) ELSE 0.0 END)')} AS f1,
       {s6('coalesce(max(CASE WHEN recall >= 0.8 THEN precision END), 0.0)')} AS precision_at_80_rec,
       {s6('coalesce(min(CASE WHEN recall >= 0.8 THEN threshold END), 1.0)')} AS threshold_at_80_rec
FROM cr JOIN cf ON cr.split = cf.split GROUP BY cr.split
""", "txn"))
def q_eval_by_split(spark, sf):
    """Validation and test metrics of the time split in one grouped evaluation."""
    s, _ = sp.time_split(_scored(spark, sf))
    s = s.where(F.col("split") != "train")
    return rounded(ev.eval_metrics(s, group_cols=["split"], round_digits=None))


@register("optimal_threshold", tb.with_views(f"""
WITH {_CURVE}
SELECT threshold, {s6('precision')} AS precision, {s6('recall')} AS recall FROM cr WHERE recall >= 0.8
ORDER BY precision DESC, threshold ASC LIMIT 1
""", "scored"))
def q_optimal(spark, sf):
    o = ev.optimal_threshold(_scored(spark, sf))
    return o.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@register("classification_report", tb.with_views(f"""
WITH {_CONF},
m AS (SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
             CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
             cast(tp + fn AS double) AS s1, cast(tn + fp AS double) AS s0, tp, tn FROM cf),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
             CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0 FROM m)
SELECT 'Legitimate' AS label, {s6('p0')} AS precision, {s6('r0')} AS recall, {s6('f0')} AS f1, {s6('s0')} AS support FROM f
UNION ALL SELECT 'Fraud', {s6('p1')}, {s6('r1')}, {s6('f1')}, {s6('s1')} FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, {s6('(tp + tn) / (s0 + s1)')}, {s6('s0 + s1')} FROM f
UNION ALL SELECT 'macro avg', {s6('(p0 + p1) / 2')}, {s6('(r0 + r1) / 2')}, {s6('(f0 + f1) / 2')}, {s6('s0 + s1')} FROM f
UNION ALL SELECT 'weighted avg', {s6('(p0 * s0 + p1 * s1) / (s0 + s1)')}, {s6('(r0 * s0 + r1 * s1) / (s0 + s1)')},
                 {s6('(f0 * s0 + f1 * s1) / (s0 + s1)')}, {s6('s0 + s1')} FROM f
""", "scored"))
def q_report(spark, sf):
    return rounded(ev.classification_report(_scored(spark, sf)))


@register("threshold_sweep", tb.with_views(f"""
WITH {_CURVE}
SELECT threshold, {s6('precision')} AS precision, {s6('recall')} AS recall,
       {s6('2 * precision * recall / (precision + recall + 1e-8)')} AS f1 FROM cr
""", "scored"))
def q_sweep(spark, sf):
    return rounded(ev.threshold_sweep(_scored(spark, sf)))


_EDGES = [float(e) for e in np.linspace(0.0, 1.0, 11)[1:-1]]


@register("calibration_bins", tb.with_views(f"""
SELECT bin, count(*) AS n, {s6('avg(p)')} AS mean_predicted, {s6('avg(cast(isFraud AS double))')} AS fraction_positive
FROM (SELECT p, isFraud, {' + '.join(f'cast(p > {e!r} AS int)' for e in _EDGES)} AS bin FROM scored)
GROUP BY bin
""", "scored"))
def q_calibration(spark, sf):
    return rounded(ev.calibration_bins(_scored(spark, sf)))


# --------------------------------------------------------------- decisions
_RUN_ID = "fixture0run0001"


@register("score_decide", tb.with_views(f"""
SELECT TransactionID, round(p, 4) AS fraud_probability,
       CASE WHEN p < 0.3 THEN 'APPROVE' WHEN p > 0.7 THEN 'DECLINE' ELSE 'REVIEW' END AS decision,
       substr('{_RUN_ID}', 1, 8) AS model_version, 0.3 AS threshold_approve, 0.7 AS threshold_decline
FROM scored
""", "scored"))
def q_score_decide(spark, sf):
    """Decision records for every scored transaction (formula score as the model)."""
    return sc.decision_records(_scored(spark, sf), prob="p", run_id=_RUN_ID, keep=("TransactionID",))


@register("dq_decisions", tb.with_views("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT (coalesce(p BETWEEN 0 AND 1, false)
       AND CASE WHEN p < 0.3 THEN 'APPROVE' WHEN p > 0.7 THEN 'DECLINE' ELSE 'REVIEW' END IN ('APPROVE', 'REVIEW', 'DECLINE'))) AS violations
FROM scored
""", "scored"))
def q_dq_decisions(spark, sf):
    recs = sc.decision_records(_scored(spark, sf), prob="p", run_id=_RUN_ID)
    return dq.decision_contract_violations(recs)


# ------------------------------------------------------------ prediction log
# The log holds every scored transaction, in batches of 500 along the time order.
_LOG_CTE = """
lg AS (SELECT TransactionID, TransactionDT, TransactionAmt, isFraud, p AS fraud_probability,
              CASE WHEN p < 0.3 THEN 'APPROVE' WHEN p > 0.7 THEN 'DECLINE' ELSE 'REVIEW' END AS decision,
              cast(floor((rn - 1) / 500) AS bigint) AS batch
       FROM sp)
"""


def _log(spark, sf):
    pos, _ = od.with_row_index(tb.txn(spark, sf).select("TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "p"),
                               ["TransactionDT", "TransactionID"])
    return pos.select("TransactionID", "TransactionDT", "TransactionAmt", "isFraud",
                      F.bround("p", 4).alias("fraud_probability"),
                      sc.decide(F.col("p")).alias("decision"),
                      od.batch_index(F.col("rn"), 500).alias("batch"))


def _log_sql(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes.strip()}" if ctes else ""
    return tb.with_views(f"WITH {_SPLIT_CTE}, {_LOG_CTE}{extra}\n{body}", "txn")


_METRICS_SQL = f"""count(*) AS n_transactions,
       {s6("avg(cast(decision = 'APPROVE' AS double))")} AS pct_approve,
       {s6("avg(cast(decision = 'REVIEW' AS double))")} AS pct_review,
       {s6("avg(cast(decision = 'DECLINE' AS double))")} AS pct_decline,
       {s6('avg(fraud_probability)')} AS score_mean,
       {s6('quantile_cont(fraud_probability, 0.95)')} AS score_p95,
       {s6('avg(cast(isFraud AS double))')} AS actual_fraud_rate,
       {s6("CASE WHEN count(isFraud) = 0 THEN NULL WHEN count(*) FILTER (WHERE isFraud IS NOT NULL AND decision IN ('DECLINE', 'REVIEW')) = 0 THEN 0.0 ELSE count(*) FILTER (WHERE isFraud = 0 AND decision IN ('DECLINE', 'REVIEW')) / count(*) FILTER (WHERE isFraud IS NOT NULL AND decision IN ('DECLINE', 'REVIEW')) END")} AS false_positive_rate"""
_METRIC_NAMES = ["n_transactions", "pct_approve", "pct_review", "pct_decline", "score_mean", "score_p95",
                 "actual_fraud_rate", "false_positive_rate"]


@register("monitor_metrics", _log_sql(f"SELECT {_METRICS_SQL} FROM lg"))
def q_monitor(spark, sf):
    return rounded(mo.monitor_metrics(_log(spark, sf)).select(*_METRIC_NAMES))


@register("monitor_hourly", tb.with_views(f"""
SELECT strftime(timestamp '2017-11-30 00:00:00' + to_seconds(cast(floor(TransactionDT / 3600) * 3600 AS bigint)),
                '%Y-%m-%d %H:%M:%S') AS window_start, {_METRICS_SQL}
FROM (SELECT TransactionDT, isFraud, p AS fraud_probability,
             CASE WHEN p < 0.3 THEN 'APPROVE' WHEN p > 0.7 THEN 'DECLINE' ELSE 'REVIEW' END AS decision FROM scored)
GROUP BY 1
""", "scored"))
def q_monitor_hourly(spark, sf):
    """Monitoring metrics per event-time hour over all scored transactions."""
    from ..functions.time import event_time
    s = _scored(spark, sf)
    log = s.select(event_time(F.col("TransactionDT")).alias("event_time"), "isFraud",
                   F.col("p").alias("fraud_probability"), sc.decide(F.col("p")).alias("decision"))
    m = mo.monitor_by_window(log, "event_time", "1 hour")
    return rounded(m.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                            *_METRIC_NAMES))


@register("score_histogram", _log_sql("""
SELECT cast(least(floor(fraud_probability * 50) + 1, 50) AS int) AS bin, count(*) AS n FROM lg GROUP BY 1
"""))
def q_score_hist(spark, sf):
    return mo.score_histogram(_log(spark, sf))


@register("amount_histogram", tb.with_views("""
SELECT isFraud, cast(least(floor((TransactionAmt - lo) / (CASE WHEN hi - lo = 0 THEN 1.0 ELSE hi - lo END) * 100) + 1, 100) AS int) AS bin,
       count(*) AS n
FROM txn, (SELECT min(TransactionAmt) AS lo, max(TransactionAmt) AS hi FROM txn) b
GROUP BY 1, 2
""", "txn"))
def q_amount_hist(spark, sf):
    return mo.value_histogram(tb.txn(spark, sf), "TransactionAmt", 100, ["isFraud"])


@register("decisions_by_batch", _log_sql("SELECT batch, decision, count(*) AS count FROM lg GROUP BY 1, 2"))
def q_decisions_by_batch(spark, sf):
    return mo.decisions_by_batch(_log(spark, sf))


@register("mean_score_by_batch", _log_sql(f"SELECT batch, {s6('avg(fraud_probability)')} AS mean_score FROM lg GROUP BY 1"))
def q_mean_by_batch(spark, sf):
    return rounded(mo.mean_score_by_batch(_log(spark, sf)))


@register("drift_alarm", _log_sql(f"""
SELECT batch, {s6('mean_score')} AS mean_score, {s6('baseline')} AS baseline, {s6('sd')} AS running_sd,
       {s6('baseline + 2 * sd')} AS alert_line,
       CASE WHEN baseline IS NULL OR k <= 3 THEN false
            ELSE coalesce(mean_score > baseline + 2 * sd, false) END AS alarm
FROM rs, bl
""", """
bm AS (SELECT batch, avg(fraud_probability) AS mean_score FROM lg GROUP BY batch),
bl AS (SELECT CASE WHEN count(*) >= 3 THEN avg(mean_score) END AS baseline
       FROM (SELECT mean_score FROM bm ORDER BY batch LIMIT 3)),
rs AS (SELECT batch, mean_score, row_number() OVER (ORDER BY batch) AS k,
              stddev_samp(mean_score) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sd
       FROM bm)
"""))
def q_drift(spark, sf):
    return rounded(mo.drift_alarm(_log(spark, sf)))


# ------------------------------------------------- conditional update of a sample

@register("perturb_sample", tb.with_views(f"""
WITH lg AS (SELECT TransactionID, TransactionAmt, row_number() OVER (ORDER BY {portable_hash_sql('TransactionID', 42)}, TransactionID) AS r,
                   count(*) OVER () AS n FROM txn WHERE isFraud = 0)
SELECT TransactionID, {s6('CASE WHEN r <= floor(n * 0.1::double) THEN TransactionAmt * 5 ELSE TransactionAmt END')} AS TransactionAmt,
       r <= floor(n * 0.1::double) AS drifted FROM lg
UNION ALL
SELECT TransactionID, {s6('TransactionAmt')}, false FROM txn WHERE isFraud <> 0
""", "txn"))
def q_perturb(spark, sf):
    """Amounts of an exact tenth of the legitimate rows multiplied by five, the rest unchanged."""
    t = tb.txn(spark, sf).select("TransactionID", "TransactionAmt", "isFraud")
    d = sc.update_sample(t, "TransactionAmt", F.col("TransactionAmt") * 5, F.col("isFraud") == 0, flag="drifted")
    return d.select("TransactionID", r6("TransactionAmt").alias("TransactionAmt"), "drifted")


@register("sample_n", tb.with_views(f"""
SELECT TransactionID, isFraud FROM txn ORDER BY {portable_hash_sql('TransactionID', 42)}, TransactionID LIMIT 500
""", "txn"))
def q_sample_n(spark, sf):
    """Exactly 500 rows, repeatable for the seed (a sampling operator: the limit is the feature)."""
    t = tb.txn(spark, sf).select("TransactionID", "isFraud")
    return od.sample_n(t, 500, 42, "TransactionID")


@register("log_union", tb.with_views(f"""
WITH {_SPLIT_CTE}
SELECT TransactionID, CASE WHEN p < 0.3 THEN 'APPROVE' WHEN p > 0.7 THEN 'DECLINE' ELSE 'REVIEW' END AS decision,
       CASE WHEN rn <= floor(n * 0.7::double) THEN 'train' WHEN rn <= floor(n * 0.85::double) THEN 'val' ELSE 'test' END AS part
FROM sp
""", "txn"))
def q_log_union(spark, sf):
    """Three separately scored slices appended into one log (bag union by name)."""
    s, _ = sp.time_split(_scored(spark, sf))
    parts = [sc.decision_records(s.where(F.col("split") == name), prob="p",
                                 keep=("TransactionID",)).select("TransactionID", "decision",
                                                                 F.lit(name).alias("part"))
             for name in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- exploration

@register("class_counts", tb.with_views(f"""
SELECT isFraud, count(*) AS n, {s6('count(*) / sum(count(*)) OVER ()')} AS share FROM txn GROUP BY isFraud
""", "txn"))
def q_class_counts(spark, sf):
    return rounded(ex.class_counts(tb.txn(spark, sf)))


@register("describe_by_class", tb.with_views(f"""
SELECT isFraud, count(TransactionAmt) AS count, {s6('avg(TransactionAmt)')} AS mean,
       {s6('stddev_samp(TransactionAmt)')} AS std, {s6('min(TransactionAmt)')} AS min,
       {s6('quantile_cont(TransactionAmt, 0.25)')} AS p25, {s6('quantile_cont(TransactionAmt, 0.5)')} AS p50,
       {s6('quantile_cont(TransactionAmt, 0.75)')} AS p75, {s6('max(TransactionAmt)')} AS max
FROM txn GROUP BY isFraud
""", "txn"))
def q_describe(spark, sf):
    return rounded(ex.describe_by_class(tb.txn(spark, sf)))


@register("hourly_rate", tb.with_views(f"""
SELECT cast((floor(TransactionDT / 3600) % 24 + 24) % 24 AS int) AS hour, {s6('avg(cast(isFraud AS double))')} AS fraud_rate,
       count(*) AS n FROM txn GROUP BY 1
""", "txn"))
def q_hourly(spark, sf):
    return rounded(ex.hourly_rate(tb.txn(spark, sf)))


@register("class_weights", tb.with_views(f"""
SELECT isFraud, count(*) AS n, {s6('sum(count(*)) OVER () / (2.0 * count(*))')} AS balanced_weight,
       CASE WHEN isFraud = 1 THEN 30.0 ELSE 1.0 END AS fixed_weight
FROM txn GROUP BY isFraud
""", "txn"))
def q_class_weights(spark, sf):
    from ..operators.resample import class_weight_table
    return rounded(class_weight_table(tb.txn(spark, sf)))
