"""Structured Streaming jobs.

* ``transaction_stream``: file source with a fixed schema and a bounded
  number of files per micro-batch.
* ``run_validation``: contract check per micro-batch into an accepted and a
  quarantine table (``foreachBatch``, idempotent per batch id).
* ``run_scoring``: stateless scoring with fitted state joined as static
  tables, appended through the exactly-once file sink.
* ``run_window_metrics``: tumbling or sliding event-time windows with a
  watermark; the state of a window is counts and sums for each score rounded
  to four places, at most 10,001 rows whatever the traffic, and holds the
  exact 95th percentile of these scores.  Every micro-batch writes the counts
  it changed, so the last windows appear too; ``read_window_metrics`` takes the
  newest ones.
* ``run_drift_alarm``: the drift rule evaluated while the stream runs, over
  versioned running moments; alarm rows come with the micro-batch.
* ``velocity.add_velocity``: point-in-time velocity from state keyed by card.

Every job runs with ``trigger(availableNow=True)`` here (process what is
there, then stop); the same code runs continuously with a processing-time
trigger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as dq
from ..operators.monitor import BASELINE_BATCHES, SIGMAS
from ..operators.ordering import exact_quantiles
from ..operators.score import decide
from ..sources import io

# Fixed value: epoch seconds of the reference date 2017-11-30 00:00:00 UTC.
REFERENCE_EPOCH = 1512000000


def event_timestamp(dt: Column) -> Column:
    """Elapsed seconds -> TIMESTAMP (watermarks need a zoned timestamp, not NTZ)."""
    return F.timestamp_seconds(dt + F.lit(REFERENCE_EPOCH))


def transaction_stream(spark: SparkSession, path: str, schema: T.StructType,
                       max_files_per_trigger: int = 1, fmt: str = "parquet",
                       glob: str | None = None) -> DataFrame:
    """File source with a fixed schema; ``glob`` reads only matching file names
    (one table out of a shared landing folder)."""
    r = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def _run(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append sink with a checkpoint: replays after a failure do not duplicate rows."""
    _run(stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append"))


def run_validation(spark: SparkSession, text_path: str, out: str, checkpoint: str,
                   max_files_per_trigger: int = 1) -> None:
    """JSON request lines -> parsed, checked -> ``out/accepted`` and ``out/quarantine``."""
    raw = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
           .load(text_path))

    def per_batch(batch: DataFrame, epoch: int) -> None:
        checked = dq.validate_requests(io.parse_requests(batch))
        checked = checked.persist()
        # one folder per epoch, overwritten on replay: idempotent
        checked.where("accepted = 1").write.mode("overwrite").parquet(f"{out}/accepted/epoch={epoch}")
        checked.where("accepted = 0").write.mode("overwrite").parquet(f"{out}/quarantine/epoch={epoch}")
        checked.unpersist()

    _run(raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def run_scoring(stream: DataFrame, score_fn: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Stateless scoring: ``score_fn`` may join static fitted state (stream-static joins)."""
    run_to_parquet(score_fn(stream), out, checkpoint)


def window_counts(stream: DataFrame, ts: str, duration: str, slide: str | None = None,
                  watermark: str = "1 hour", prob: str = "fraud_probability", label: str = "isFraud") -> DataFrame:
    """Counts and sums per (window, score rounded to four places)."""
    w = F.window(F.col(ts), duration, slide) if slide else F.window(F.col(ts), duration)
    d, y = decide(F.col(prob)), F.col(label)
    flagged = y.isNotNull() & d.isin("DECLINE", "REVIEW")
    return (stream.withWatermark(ts, watermark).groupBy(w.alias("w"), F.bround(F.col(prob), 4).alias("score"))
            .agg(F.count(F.lit(1)).alias("n"), F.count(d).alias("n_decided"),
                 *[F.count_if(d == name).alias(f"n_{name.lower()}") for name in ("APPROVE", "REVIEW", "DECLINE")],
                 F.sum(F.col(prob)).alias("s"), F.count(F.col(prob)).alias("n_score"),
                 F.sum(y.cast("double")).alias("y"), F.count(y).alias("n_label"),
                 F.count_if(flagged).alias("n_flagged"), F.count_if(flagged & (y == 0)).alias("n_flagged_legit"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w"))


def run_window_metrics(stream: DataFrame, out: str, checkpoint: str, ts: str = "event_time",
                       duration: str = "1 hour", slide: str | None = None, watermark: str = "1 hour") -> None:
    """Update mode: each micro-batch writes the counts it changed to its own folder
    (overwritten on replay); rows later than the watermark are dropped."""
    def per_batch(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    _run(window_counts(stream, ts, duration, slide, watermark).writeStream.outputMode("update")
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def read_window_metrics(spark: SparkSession, out: str) -> DataFrame:
    """The eight monitoring metrics of every window from the newest counts of the stream."""
    window = ["window_start", "window_end"]
    changed = spark.read.parquet(out)
    values = [c for c in changed.columns if c not in (*window, "score", "epoch")]
    newest = (changed.groupBy(*window, "score").agg(F.max_by(F.struct(*values), "epoch").alias("v"))
              .select(*window, "score", "v.*"))
    total = newest.groupBy(*window).agg(*[F.sum(c).alias(c) for c in values])
    share = lambda c, n: F.try_divide(F.col(c), F.col(n))
    metrics = total.select(
        *window, F.col("n").alias("n_transactions"),
        *[share(f"n_{c}", "n_decided").alias(f"pct_{c}") for c in ("approve", "review", "decline")],
        share("s", "n_score").alias("score_mean"), share("y", "n_label").alias("actual_fraud_rate"),
        F.when(F.col("n_label") > 0, F.coalesce(share("n_flagged_legit", "n_flagged"), F.lit(0.0)))
        .alias("false_positive_rate"))
    p95 = exact_quantiles(newest, "score", [0.95], window, weight="n")
    return metrics.join(p95.select(*window, F.col("quantile").alias("score_p95")), window, "left")


#: Size parameter of the quantile sketches: at most 1.4 % of the ranks off for a quantile (99 % of the time),
#: exact for windows of fewer rows, some 3 k bytes of state for a window of any size.
SKETCH_K = 200


def window_sketches(stream: DataFrame, ts: str, duration: str, slide: str | None = None, watermark: str = "1 hour",
                    prob: str = "fraud_probability", label: str = "isFraud", k: int = SKETCH_K) -> DataFrame:
    """Counts and sums per window, and a mergeable sketch of its scores, whatever their type and number."""
    w = F.window(F.col(ts), duration, slide) if slide else F.window(F.col(ts), duration)
    score, d, y = F.col(prob).cast("double"), decide(F.col(prob)), F.col(label)
    return (stream.withWatermark(ts, watermark).groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(d == "DECLINE").alias("n_decline"), F.sum(score).alias("s"), F.count(score).alias("n_score"),
                 F.sum(y.cast("double")).alias("y"), F.count(y).alias("n_label"), F.kll_sketch_agg_double(score, F.lit(k)).alias("sketch"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w"))


def run_window_sketches(stream: DataFrame, out: str, checkpoint: str, ts: str = "event_time", duration: str = "1 hour", slide: str | None = None,
                        watermark: str = "1 hour", k: int = SKETCH_K) -> None:
    """Update mode with one row of state a window, beside ``run_window_metrics``, which is exact for scores of
    four places and holds a row for each of them."""
    def per_batch(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    _run(window_sketches(stream, ts, duration, slide, watermark, k=k).writeStream.outputMode("update")
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def read_window_sketches(spark: SparkSession, out: str, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Counts, means and quantiles (a score of the window at least that share of its scores lie at or below) of
    every window, from its newest sketch; null where a window has no score."""
    window = ["window_start", "window_end"]
    changed = spark.read.parquet(out)
    values = [c for c in changed.columns if c not in (*window, "epoch")]
    newest = changed.groupBy(*window).agg(F.max_by(F.struct(*values), "epoch").alias("v")).select(*window, "v.*")
    share = lambda c, n: F.try_divide(F.col(c), F.col(n))
    points = [F.when(F.col("n_score") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(f"score_p{round(100 * q)}") for q in quantiles]
    return newest.select(*window, F.col("n").alias("n_transactions"), share("n_decline", "n").alias("pct_decline"), share("s", "n_score").alias("score_mean"),
                         share("y", "n_label").alias("actual_fraud_rate"), *points, F.length("sketch").alias("sketch_bytes"))


_ALARM = "batch long, mean_score double, baseline double, running_sd double, alert_line double, alarm boolean, closed boolean"
_ALARM_STATE = "n_batches long, k long, mean double, m2 double, first array<double>, early array<struct<batch:long,mean:double,sd:double>>, open_batch long, open_sum double, open_n long"


def _with_mean(state: dict, mean: float | None) -> dict:
    """The running moments with one more batch mean (a null mean counts as a batch without a value).

    Two sets of moments merge by their sizes, means and squared deviations; here one set is the new mean.
    """
    out = dict(state, n_batches=state["n_batches"] + 1)
    if len(out["first"]) < BASELINE_BATCHES:
        out["first"] = [*out["first"], mean]
    if mean is not None:
        k, d = state["k"] + 1, mean - state["mean"]
        out |= {"k": k, "mean": state["mean"] + d / k, "m2": state["m2"] + d * d * state["k"] / k}
    return out


def _alarm_row(batch: int, mean: float | None, state: dict, closed: bool) -> tuple:
    """The drift rule for a batch whose mean is the last one in ``state``."""
    known = [m for m in state["first"] if m is not None]
    baseline = sum(known) / len(known) if len(state["first"]) == BASELINE_BATCHES and known else None
    sd = max(state["m2"] / (state["k"] - 1), 0.0) ** 0.5 if state["k"] > 1 else None
    line = baseline + SIGMAS * sd if baseline is not None and sd is not None else None
    alarm = bool(state["n_batches"] > BASELINE_BATCHES and line is not None and mean is not None and mean > line)
    return batch, mean, baseline, sd, line, alarm, closed


def run_drift_alarm(stream: DataFrame, out: str, checkpoint: str, prob: str = "fraud_probability", batch: str = "batch") -> None:
    """The drift rule inside the stream: every micro-batch writes the alarm rows of the replay batches it holds.

    The running moments are a one-row table written anew by each micro-batch from its predecessor's, so a
    replayed micro-batch starts from the same row and overwrites what it wrote.  The last replay batch stays
    open, since the next micro-batch may bring more of it: its row is written with the moments so far and
    written again when it grows or closes.  Rows of a batch that has closed are late; their sums go
    to ``out/late`` and leave alarms as they are.  Until the baseline is known, rows have none, and the
    micro-batch that brings it writes them again.  One row a replay batch comes to the driver.
    """
    spark = stream.sparkSession

    def per_batch(df: DataFrame, epoch: int) -> None:
        state = dict(n_batches=0, k=0, mean=0.0, m2=0.0, first=[], early=[], open_batch=None, open_sum=0.0, open_n=0)
        if epoch > 0:
            state = spark.read.schema(_ALARM_STATE).parquet(f"{out}/state/epoch={epoch - 1}").first().asDict()
        rows, late, settled = [], [], state["n_batches"] >= BASELINE_BATCHES
        sums = df.groupBy(batch).agg(F.sum(prob).alias("s"), F.count(prob).alias("n")).orderBy(batch)
        for r in sums.where(F.col(batch).isNotNull()).collect():
            if state["open_batch"] is not None and r[batch] < state["open_batch"]:
                late.append((r[batch], r["s"], r["n"]))
                continue
            if state["open_batch"] is not None and r[batch] > state["open_batch"]:
                mean = state["open_sum"] / state["open_n"] if state["open_n"] else None
                state = _with_mean(state, mean)
                rows.append(_alarm_row(state["open_batch"], mean, state, True))
                if state["n_batches"] < BASELINE_BATCHES:
                    state["early"] = [*state["early"], (state["open_batch"], mean, rows[-1][3])]
                state |= {"open_batch": None, "open_sum": 0.0, "open_n": 0}
            state |= {"open_batch": r[batch], "open_sum": state["open_sum"] + (r["s"] or 0.0), "open_n": state["open_n"] + r["n"]}
        if state["open_batch"] is not None:
            mean = state["open_sum"] / state["open_n"] if state["open_n"] else None
            rows.append(_alarm_row(state["open_batch"], mean, _with_mean(state, mean), False))
        if not settled:  # the batches before the baseline was known get it now; none of them can raise an alarm
            baseline = rows[-1][2] if rows else None
            early = [(b, m, baseline, sd, baseline + SIGMAS * sd if baseline is not None and sd is not None else None, False, True) for b, m, sd in state["early"]]
            rows = list({r[0]: r for r in [*rows, *early]}.values())
        one = lambda data, schema, name: spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").parquet(f"{out}/{name}/epoch={epoch}")
        one(rows, _ALARM, "alarms")
        one(late, "batch long, s double, n long", "late")
        names = [c.split()[0] for c in _ALARM_STATE.split(", ")]
        one([tuple(state[c] for c in names)], _ALARM_STATE, "state")

    _run(stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint))


def read_drift_alarm(spark: SparkSession, out: str) -> DataFrame:
    """The newest alarm row of every replay batch, as the micro-batches wrote them."""
    rows = spark.read.parquet(f"{out}/alarms")
    values = [c for c in rows.columns if c not in ("batch", "epoch")]
    return rows.groupBy("batch").agg(F.max_by(F.struct(*values), "epoch").alias("v")).select("batch", "v.*")
