"""Streaming queries: each stream runs to completion (availableNow) over files
written from the fixture tables, and its final table is compared with the
batch twin in DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import split as sp
from ..operators.encoders import materialize
from ..operators.score import decide
from ..session import scratch_path
from ..sources import tables as tb
from ..functions.time import event_time
from ..streaming import jobs as sj
from ..streaming import velocity as sv
from .catalog import r6, register, rounded, s6
from .queries_encode import _SPLIT_CTE
from .queries_eval import _LOG_CTE, _METRIC_NAMES, _METRICS_SQL, _log
from .queries_quality import _requests


#: Greatest number of rows of one file of a replay.
FILE_ROWS = 1_000_000


def _write_source(df, order_col: str, n_files: int, name: str, spark) -> str:
    """Fixture prep: files that land one after the other along ``order_col``, as a
    live feed writes them; the file source reads them in the order of arrival on
    any file system.  The frame is cut once; each cut is one file of bounded size."""
    cuts = max(n_files, -(-df.count() // FILE_ROWS))
    parts = scratch_path(spark, f"{name}_parts")
    (df.repartitionByRange(cuts, order_col).withColumn("_part", F.spark_partition_id())
     .write.partitionBy("_part").parquet(parts))
    path = scratch_path(spark, name)
    for i in range(cuts):
        spark.read.parquet(parts).where(F.col("_part") == i).select(*df.columns).coalesce(1) \
            .write.mode("append").parquet(path)
    return path


def _stream_frame(spark, sf):
    t = tb.txn(spark, sf).select("TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "card1", "p")
    return t.withColumn("event_time", sj.event_timestamp(F.col("TransactionDT")))


def _run_stream(spark, sf, name, build, n_files=8, max_files=2, read=None):
    src_df = _stream_frame(spark, sf)
    src = _write_source(src_df, "TransactionDT", n_files, f"{name}_src", spark)
    stream = sj.transaction_stream(spark, src, src_df.schema, max_files)
    out, ck = scratch_path(spark, f"{name}_out"), scratch_path(spark, f"{name}_ck")
    build(stream, out, ck)
    return read(spark, out) if read else spark.read.parquet(out)


@register("stream_source", tb.with_views(
    "SELECT TransactionID, TransactionDT, TransactionAmt, isFraud FROM txn", "txn"))
def q_stream_source(spark, sf):
    """Micro-batches of at most two files each, appended to a Parquet sink."""
    out = _run_stream(spark, sf, "stream_source", lambda s, o, c: sj.run_to_parquet(s, o, c))
    return out.select("TransactionID", "TransactionDT", "TransactionAmt", "isFraud")


@register("stream_validate", tb.with_views("""
SELECT TransactionID, amt AS TransactionAmt,
       concat_ws(';', CASE WHEN amt IS NULL THEN 'TransactionAmt: field required' END,
                      CASE WHEN amt <= 0 THEN 'TransactionAmt must be positive' END,
                      CASE WHEN bad2 THEN 'card2: invalid value' END) AS reasons,
       cast(amt IS NOT NULL AND amt > 0 AND NOT bad2 AS int) AS accepted
FROM (SELECT TransactionID, cast(V3 AS int) % 17 = 0 AS bad2,
             CASE WHEN cast(V3 AS int) % 13 = 0 THEN NULL WHEN cast(V3 AS int) % 11 = 0 THEN -TransactionAmt
                  ELSE TransactionAmt END AS amt FROM txn)
""", "txn"))
def q_stream_validate(spark, sf):
    """JSON request lines checked per micro-batch into accepted and quarantine tables."""
    src = scratch_path(spark, "requests_src")
    _requests(spark, sf).select("value").repartition(6).write.mode("overwrite").text(src)
    out, ck = scratch_path(spark, "requests_out"), scratch_path(spark, "requests_ck")
    sj.run_validation(spark, src, out, ck, max_files_per_trigger=2)
    both = spark.read.parquet(f"{out}/accepted").unionByName(spark.read.parquet(f"{out}/quarantine"))
    return both.select("TransactionID", "TransactionAmt", "reasons", "accepted")


@register("stream_score", tb.with_views(f"""
WITH {_SPLIT_CTE},
cs AS (SELECT card1, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS sd FROM tr
       WHERE card1 IS NOT NULL GROUP BY card1)
SELECT t.TransactionID, CASE WHEN p < 0.3 THEN 'APPROVE' WHEN p > 0.7 THEN 'DECLINE' ELSE 'REVIEW' END AS decision,
       {s6('(t.TransactionAmt - cs.m) / (cs.sd + 1e-8)')} AS amount_zscore
FROM txn t LEFT JOIN cs ON t.card1 = cs.card1
""", "txn"))
def q_stream_score(spark, sf):
    """Stream scoring with the card profile fitted on the training rows (a static,
    broadcast state; whole-partition windows are not allowed on streams)."""
    s, _ = sp.time_split(tb.txn(spark, sf).select("TransactionID", "TransactionDT", "TransactionAmt", "card1"))
    profile = materialize(fe.card_profile(s.where(F.col("split") == "train")))
    rows = profile.count()

    def score(stream):
        x = fe.add_card_features(stream, profile=profile, profile_rows=rows)
        return x.select("TransactionID", decide(F.col("p")).alias("decision"), "amount_zscore")

    out = _run_stream(spark, sf, "stream_score", lambda st, o, c: sj.run_scoring(st, score, o, c))
    return out.select("TransactionID", "decision", r6("amount_zscore").alias("amount_zscore"))


def _window_sql(size: int, slide: int) -> str:
    k = size // slide
    starts = " UNION ALL ".join(f"SELECT {i} AS j" for i in range(k))
    return tb.with_views(f"""
WITH b AS (SELECT TransactionDT, isFraud, p AS fraud_probability,
                  CASE WHEN p < 0.3 THEN 'APPROVE' WHEN p > 0.7 THEN 'DECLINE' ELSE 'REVIEW' END AS decision FROM txn),
w AS (SELECT b.*, (floor(TransactionDT / {slide}) - j) * {slide} AS ws FROM b, ({starts}) js)
SELECT strftime(timestamp '2017-11-30 00:00:00' + to_seconds(cast(ws AS bigint)), '%Y-%m-%d %H:%M:%S') AS window_start,
       {_METRICS_SQL}
FROM w GROUP BY ws
""", "txn")


def _window_stream(spark, sf, name, duration, slide):
    def build(stream, out, ck):
        s = stream.withColumnRenamed("p", "fraud_probability")
        sj.run_window_metrics(s, out, ck, "event_time", duration, slide, "1 hour")
    out = _run_stream(spark, sf, name, build, read=sj.read_window_metrics)
    # format the window start in UTC whatever the session time zone is
    start = event_time(F.unix_seconds(F.col("window_start")) - F.lit(sj.REFERENCE_EPOCH))
    return rounded(out.select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                              *_METRIC_NAMES))


@register("stream_hourly", _window_sql(3600, 3600))
def q_stream_hourly(spark, sf):
    """Tumbling 1 h event-time windows, 1 h lateness bound, the last windows included."""
    return _window_stream(spark, sf, "stream_hourly", "1 hour", None)


@register("stream_sliding", _window_sql(3600, 900))
def q_stream_sliding(spark, sf):
    """Sliding 1 h windows every 15 minutes."""
    return _window_stream(spark, sf, "stream_sliding", "1 hour", "15 minutes")


@register("stream_sketch", tb.with_views(f"""
SELECT strftime(timestamp '2017-11-30 00:00:00' + to_seconds(cast(ws AS bigint)), '%Y-%m-%d %H:%M:%S') AS window_start, max(n) AS n_transactions,
       {s6('count(*) FILTER (WHERE p > 0.7) / max(n)')} AS pct_decline, {s6('avg(p)')} AS score_mean, {s6('avg(isFraud)')} AS actual_fraud_rate,
       {s6('max(CASE WHEN k = ceil(0.5 * n) THEN p END)')} AS score_p50, {s6('max(CASE WHEN k = ceil(0.95 * n) THEN p END)')} AS score_p95
FROM (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY p) AS k, count(*) OVER (PARTITION BY ws) AS n
      FROM (SELECT *, floor(TransactionDT / 3600) * 3600 AS ws FROM txn)) GROUP BY ws
""", "txn"))
def q_stream_sketch(spark, sf):
    """Tumbling 1 h windows with quantile sketches as state (exact while a window has fewer rows than the sketch
    keeps, as here)."""
    def build(stream, out, ck):
        sj.run_window_sketches(stream.withColumnRenamed("p", "fraud_probability"), out, ck)
    out = _run_stream(spark, sf, "stream_sketch", build, read=sj.read_window_sketches)
    start = event_time(F.unix_seconds(F.col("window_start")) - F.lit(sj.REFERENCE_EPOCH))
    return rounded(out.select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n_transactions", "pct_decline", "score_mean",
                              "actual_fraud_rate", "score_p50", "score_p95"))


@register("stream_alarm", tb.with_views(f"""
WITH {_SPLIT_CTE}, {_LOG_CTE},
bm AS (SELECT batch, avg(fraud_probability) AS mean_score FROM lg GROUP BY batch),
bl AS (SELECT CASE WHEN count(*) >= 3 THEN avg(mean_score) END AS baseline
       FROM (SELECT mean_score FROM bm ORDER BY batch LIMIT 3)),
rs AS (SELECT batch, mean_score, row_number() OVER (ORDER BY batch) AS k,
              stddev_samp(mean_score) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sd
       FROM bm)
SELECT batch, {s6('mean_score')} AS mean_score, {s6('baseline')} AS baseline, {s6('sd')} AS running_sd,
       {s6('baseline + 2 * sd')} AS alert_line,
       CASE WHEN baseline IS NULL OR k <= 3 THEN false
            ELSE coalesce(mean_score > baseline + 2 * sd, false) END AS alarm
FROM rs, bl
""", "txn"))
def q_stream_alarm(spark, sf):
    """Replay of the whole log: the drift rule while the stream runs; the rows are those that the
    micro-batches wrote."""
    log = _log(spark, sf)
    src = _write_source(log, "batch", 6, "alarm_src", spark)
    stream = sj.transaction_stream(spark, src, log.schema, 1)
    out, ck = scratch_path(spark, "alarm_out"), scratch_path(spark, "alarm_ck")
    sj.run_drift_alarm(stream, out, ck)
    return rounded(sj.read_drift_alarm(spark, out).drop("closed"))


# every third transaction belongs to one card
_HOT_CARD = "CASE WHEN TransactionID % 3 = 0 THEN 1 ELSE card1 END"


@register("stream_velocity", tb.with_views(f"""
SELECT TransactionID, card1, """ + ", ".join(f"count(*) OVER w{n} AS card_count_{n}, {s6(f'coalesce(sum(TransactionAmt) OVER w{n}, 0.0)')} AS card_spend_{n}" for n in ("1h", "24h")) + f""", false AS out_of_order
FROM (SELECT TransactionID, TransactionDT, TransactionAmt, {_HOT_CARD} AS card1 FROM txn)
WINDOW w1h AS (PARTITION BY card1 ORDER BY TransactionDT RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING),
       w24h AS (PARTITION BY card1 ORDER BY TransactionDT RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)
""", "txn"))
def q_stream_velocity(spark, sf):
    """Velocity of both windows from keyed state, with a card that a third of the rows belong to."""
    def build(stream, out, ck):
        hot = stream.withColumn("card1", F.expr(_HOT_CARD))
        sj.run_to_parquet(sv.add_velocity(hot, {"1h": 3600, "24h": 86400}), out, ck)
    out = _run_stream(spark, sf, "stream_velocity", build)
    return rounded(out.select("TransactionID", "card1", *[f"card_{v}_{n}" for n in ("1h", "24h") for v in ("count", "spend")], "out_of_order"))


@register("stream_glob_source", tb.with_views(
    "SELECT TransactionID, TransactionAmt, isFraud FROM txn", "txn"))
def q_stream_glob_source(spark, sf):
    """A shared landing folder holding two tables in two formats; the stream
    reads only the transaction files, selected by a file-name glob."""
    land = scratch_path(spark, "landing")
    tb.identity(spark, sf).write.mode("overwrite").json(land)
    src_df = tb.txn(spark, sf).select("TransactionID", "TransactionAmt", "isFraud")
    src_df.repartition(4).write.mode("append").parquet(land)
    stream = sj.transaction_stream(spark, land, src_df.schema, 2, glob="*.parquet")
    out, ck = scratch_path(spark, "landing_out"), scratch_path(spark, "landing_ck")
    sj.run_to_parquet(stream, out, ck)
    return spark.read.parquet(out)
