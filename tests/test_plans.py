"""Physical-plan shape of the hot operators (what would matter at scale)."""

from pyspark.sql import functions as F

from fraudspark.operators import encoders as enc
from fraudspark.operators import features as fe
from fraudspark.sources import tables as tb

from .conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _initial(df) -> str:
    # the plan AQE starts from (before runtime re-optimisation)
    return df._jdf.queryExecution().sparkPlan().toString()


def test_scan_is_pruned_and_filtered(spark):
    t = tb.txn(spark, SMALL).select("TransactionID", "card1", "TransactionAmt").where(F.col("card1") == 7)
    plan = _initial(t)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan


def test_card_statistics_use_aggregate_not_window(spark):
    t = tb.txn(spark, SMALL).select("TransactionID", "card1", "TransactionAmt")
    prof_plan = _initial(fe.card_profile(t))
    assert "partial_avg" in prof_plan                        # map-side partial aggregation
    plan = _plan(fe.add_card_features(t))
    assert "Window" not in plan
    # the counted profile is broadcast: the full-width frame is never shuffled
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_point_in_time_velocity_sums_seconds_before_the_window(spark):
    t = tb.txn(spark, SMALL).select("TransactionID", "card1", "TransactionDT", "TransactionAmt")
    plan = _initial(fe.add_point_in_time_velocity(t, 3600, "1h"))
    # map-side partial sums per (card, second); windows only over (card, bucket) groups of bounded size
    assert "partial_count" in plan and "partial_sum" in plan
    window = plan[plan.index("Window"):]
    assert "_k" in window and "_b" in window and "TransactionID" not in window[:window.index("\n")]


def test_split_and_sample_leave_wide_rows_where_they_are(spark):
    from fraudspark.operators import ordering as od
    from fraudspark.operators import split as sp
    t = tb.txn(spark, SMALL)
    for out in (sp.time_split(t, folds=5)[0], sp.test_tail(t)[0], sp.add_folds(t),
                od.seeded_fraction(t, 0.1, 42, "TransactionID")):
        assert "Exchange" not in _initial(out)


def test_encoder_state_is_broadcast_when_small(spark):
    t = tb.txn(spark, SMALL)
    e = enc.fit_target_encoding(t, ["P_emaildomain", "R_emaildomain"], "isFraud")
    plan = _initial(e.transform(t.select("TransactionID", "P_emaildomain", "R_emaildomain")))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan


def test_large_state_gets_no_broadcast_hint(spark):
    t = tb.txn(spark, SMALL)
    e = enc.fit_target_encoding(t, ["P_emaildomain"], "isFraud")
    small = e.transform(t.select("TransactionID", "P_emaildomain"))
    big = enc.TargetEncoding(e.cols, e.global_mean, e.smoothing, e.state, state_rows=10**9) \
        .transform(t.select("TransactionID", "P_emaildomain"))
    assert "strategy=broadcast" in small._jdf.queryExecution().analyzed().toString()
    # above the limit the choice is left to AQE's run-time size check
    assert "strategy=broadcast" not in big._jdf.queryExecution().analyzed().toString()


def test_large_states_shuffle_the_rows_once(spark):
    from dataclasses import replace
    t = tb.txn(spark, SMALL).select("TransactionID", "P_emaildomain", "R_emaildomain", "card4", "isFraud")
    e = enc.fit_target_encoding(t, ["P_emaildomain", "R_emaildomain", "card4"], "isFraud")
    assert e.state_bytes and e.state_bytes < 10_000
    large = replace(e, state_bytes=1 << 60)
    a, b = e.transform(t), large.transform(t)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0
    plan = _initial(b.hint("merge"))
    wide = [line for line in plan.split("\n") if "TransactionID" in line and "Scan" in line]
    assert len(wide) == 1      # the rows are read, and shuffled, once, however many columns


def test_wanted_quantiles_are_broadcast(spark):
    from fraudspark.operators import ordering as od
    t = tb.txn(spark, SMALL).select("isFraud", "TransactionAmt")
    plan = _initial(od.exact_quantiles(t, "TransactionAmt", [0.5, 0.95], ["isFraud"]))
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan
    assert "SortMergeJoin" not in plan
