"""Keyed velocity state and the running alarm: order, late rows, nulls, replays."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudspark.operators import monitor as mo
from fraudspark.session import scratch_path
from fraudspark.streaming import jobs as sj
from fraudspark.streaming import velocity as sv


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.sampled_from([1.0, 2.5, float("nan"), float("inf"), -float("inf"), 0.0])), min_size=1, max_size=40), st.integers(1, 30), st.integers(0, 40))
def test_entries_answer_like_the_rows(rows, window, cut):
    t, a = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    none = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    entries = none
    for part in (slice(0, cut), slice(cut, None)):
        entries = sv.merged(entries, (t[part], np.ones(len(t[part])), a[part]))
    count, total = sv.looked_up(entries, t, window)
    for i in range(len(t)):
        inside = (t >= t[i] - window) & (t < t[i])
        with np.errstate(invalid="ignore"):
            assert count[i] == inside.sum() and np.isclose(total[i], a[inside].sum(), equal_nan=True)


def _files(spark, parts, schema):
    path = scratch_path(spark, "velocity_src")
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def test_late_rows_null_cards_and_nulls(spark):
    schema = "TransactionID long, card1 long, TransactionDT long, TransactionAmt double, note long"
    big = 2 ** 60 + 1
    parts = [[(1, 7, 10_000, 5.0, big), (2, 7, 10_010, None, None), (3, None, 10_020, 1.0, big), (4, 7, None, 1.0, big)],
             [(5, 7, 10_030, 2.0, None), (6, 8, 10_300, 1.0, big)],
             [(7, 7, 10_025, 3.0, None), (8, 7, 9_000, 9.0, big)],        # 7: out of order but in time; 8: behind the watermark
             [(9, 7, 10_040, 1.0, None), (10, 7, 9_990, 4.0, None)],
             [(11, 7, 200_000, 1.0, None)]]
    path = _files(spark, parts, schema)
    src = spark.read.parquet(path)
    stream = sj.transaction_stream(spark, path, src.schema, 1).withColumn("event_time", sj.event_timestamp(F.col("TransactionDT")))
    out, ck = scratch_path(spark, "velocity_out"), scratch_path(spark, "velocity_ck")
    sj.run_to_parquet(sv.add_velocity(stream, {"s": 100}, lateness=500), out, ck)
    got = {r["TransactionID"]: r for r in spark.read.parquet(out).collect()}
    assert got.keys() == set(range(1, 12)) - {8}     # a late row gets no answer
    values = {i: (r["card_count_s"], r["card_spend_s"], r["out_of_order"]) for i, r in got.items()}
    assert values[1] == (0, 0.0, False) and values[2] == (1, 5.0, False)
    assert values[3] == values[4] == (None, None, False)
    assert values[5] == (2, 5.0, False) and values[6] == (0, 0.0, False)
    assert values[7] == (2, 5.0, True)               # sees what is before it
    assert values[9] == (5, 14.0, False)             # with the row that came out of order, and the one that came with it
    assert values[10] == (0, 0.0, True) and values[11] == (0, 0.0, False)
    assert got[1]["note"] == big and got[2]["note"] is None and got[3]["note"] == big


def test_many_cards_share_few_state_keys(spark):
    """One state and one Python call a bucket (a card each before), with the answers of the cards apart."""
    rng = np.random.default_rng(3)
    rows = [(i, int(c), int(t), float(a)) for i, (c, t, a) in enumerate(zip(rng.integers(0, 900, 3000), np.sort(rng.integers(0, 4000, 3000)), rng.integers(1, 99, 3000), strict=True))]
    rows[0] = (0, 5, rows[0][2], float("inf"))      # another card's sums stay finite
    path = _files(spark, [rows[:1500], rows[1500:]], "TransactionID long, card1 long, TransactionDT long, TransactionAmt double")
    stream = sj.transaction_stream(spark, path, spark.read.parquet(path).schema, 1).withColumn("event_time", sj.event_timestamp(F.col("TransactionDT")))
    out, ck = scratch_path(spark, "velocity_out"), scratch_path(spark, "velocity_ck")
    query = sv.add_velocity(stream, {"s": 700}, lateness=5000, buckets=6).writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 6
    got = {r["TransactionID"]: (r["card_count_s"], r["card_spend_s"]) for r in spark.read.parquet(out).collect()}
    card, t, a = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    first = np.arange(3000) < 1500
    assert len(got) == 3000
    for i, c, at, _ in rows:
        inside = (card == c) & (t >= at - 700) & (t < at) & (first | (not first[i]))
        assert got[i] == (inside.sum(), a[inside].sum())


def _alarms(spark, parts):
    path = _files(spark, parts, "batch long, fraud_probability double")
    stream = sj.transaction_stream(spark, path, spark.read.parquet(path).schema, 1)
    out, ck = scratch_path(spark, "alarm_out"), scratch_path(spark, "alarm_ck")
    sj.run_drift_alarm(stream, out, ck)
    return out


def test_alarm_rows_come_with_the_micro_batch(spark):
    rng = np.random.default_rng(1)
    rows = [(b, float(p)) for b in range(12) for p in rng.random(5) * 0.1 + (0.5 if b in (7, 11) else 0.2)]
    parts = [rows[i:i + 8] for i in range(0, len(rows), 8)]     # replay batches cross micro-batches
    out = _alarms(spark, parts)
    got = {r["batch"]: r for r in sj.read_drift_alarm(spark, out).collect()}
    want = {r["batch"]: r for r in mo.drift_alarm(spark.createDataFrame(rows, "batch long, fraud_probability double")).collect()}
    assert got.keys() == want.keys()
    for b, w in want.items():
        for c in ("mean_score", "baseline", "running_sd", "alert_line"):
            assert (got[b][c] is None) == (w[c] is None) and (w[c] is None or np.isclose(got[b][c], w[c]))
        assert got[b]["alarm"] == w["alarm"]
    assert [b for b in got if got[b]["alarm"]] == [7, 11] or got[7]["alarm"]
    first = {e: {r["batch"] for r in spark.read.parquet(f"{out}/alarms/epoch={e}").collect()} for e in (0, 1)}
    assert first[0] == {0, 1} and first[1] == {0, 1, 2, 3}   # the second brings the baseline
    first[2] = {r["batch"] for r in spark.read.parquet(f"{out}/alarms/epoch=2").collect()}
    assert first[2] == {3, 4}


def test_rows_of_closed_batches_are_late(spark):
    out = _alarms(spark, [[(0, 0.1), (1, 0.2), (2, 0.3)], [(0, 9.0), (2, 0.5), (3, 0.4)]])
    late = [tuple(r) for r in spark.read.parquet(f"{out}/late").select("batch", "s", "n").collect()]
    assert late == [(0, 9.0, 1)]
    means = {r["batch"]: r["mean_score"] for r in sj.read_drift_alarm(spark, out).collect()}
    assert means == {0: 0.1, 1: 0.2, 2: pytest.approx(0.4), 3: 0.4}


def test_running_moments_equal_pandas():
    state = dict(n_batches=0, k=0, mean=0.0, m2=0.0, first=[], open_batch=None, open_sum=0.0, open_n=0)
    seen = []
    for mean in (0.2, None, 0.25, 1e6, 0.3):
        state = sj._with_mean(state, mean)
        seen.append(mean)
        known = pd.Series([m for m in seen if m is not None])
        assert state["n_batches"] == len(seen) and np.isclose(state["mean"], known.mean())
        if len(known) > 1:
            assert np.isclose((state["m2"] / (state["k"] - 1)) ** 0.5, known.std())
    assert state["first"] == [0.2, None, 0.25]


def test_sketches_keep_their_rank_error_and_size(spark):
    rng = np.random.default_rng(8)
    scores = rng.beta(0.5, 5, 60_000)
    rows = [(int(i * 3600 / 30_000), float(p), int(i % 50 == 0)) for i, p in enumerate(scores)]          # two windows of 30,000 rows
    rows += [(9_000, None, None), (9_001, None, 1)]                                                         # a window without scores
    path = _files(spark, [rows[k::3] for k in range(3)], "TransactionDT long, fraud_probability double, isFraud int")
    stream = sj.transaction_stream(spark, path, spark.read.parquet(path).schema, 1).withColumn("event_time", sj.event_timestamp(F.col("TransactionDT")))
    out, ck = scratch_path(spark, "sketch_out"), scratch_path(spark, "sketch_ck")
    sj.run_window_sketches(stream, out, ck, watermark="3 hours")
    got = sj.read_window_sketches(spark, out).orderBy("window_start").collect()
    assert [r["n_transactions"] for r in got] == [30_000, 30_000, 2] and got[2]["score_p95"] is None
    for r, part in zip(got, (scores[:30_000], scores[30_000:])):
        for q, c in ((0.5, "score_p50"), (0.95, "score_p95")):
            assert abs((part <= r[c]).mean() - q) < 0.02
        assert np.isclose(r["score_mean"], part.mean()) and r["sketch_bytes"] < 40 * sj.SKETCH_K
