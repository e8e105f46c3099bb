
import math

from pyspark.sql import functions as F

from fraudspark.operators import evaluate as ev
from fraudspark.operators import features as fe
from fraudspark.operators import monitor as mo


def test_literal_case_option_reproduces_minus_one(spark):
    df = spark.createDataFrame([("W",), (" visa",), (None,)], "ProductCD string")
    folded = [r[0] for r in fe.encode_ordinals(df).collect()]
    literal = [r[0] for r in fe.encode_ordinals(df, fold_case=False).collect()]
    assert folded == [4, -1, -1] and literal == [-1, -1, -1]


def test_null_time_gives_null_cycles_and_zero_flags(spark):
    df = spark.createDataFrame([(None,), (0,)], "TransactionDT long")
    rows = fe.add_time_features(df).collect()
    assert rows[0]["hour_sin"] is None and rows[0]["is_weekend"] == 0 and rows[0]["is_night"] == 0
    assert rows[1]["is_night"] == 1 and rows[1]["is_weekend"] == 0        # Thursday 00:00


def test_null_card_and_single_row_statistics(spark):
    df = spark.createDataFrame([(1, None, 10.0), (2, 5, 20.0), (3, 6, None), (4, 6, None)],
                               "TransactionID long, card1 long, TransactionAmt double")
    out = {r["TransactionID"]: r for r in fe.add_card_features(df).collect()}
    assert out[1]["card_txn_count"] is None and out[1]["card_mean_spend"] is None     # null key: no group
    assert out[2]["amount_zscore"] is None                                          # one row: null std
    assert out[3]["card_total_spend"] == 0.0 and out[3]["card_txn_count"] == 2      # all-null group sums to 0


def test_sla_threshold_is_the_smallest_score(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.4, 1), (0.1, 0), (0.05, 1)], "p double, isFraud int")
    m = ev.eval_metrics(df, round_digits=None).first()
    assert m["threshold_at_80_rec"] == 0.05
    assert math.isclose(m["precision_at_80_rec"], 3 / 5)


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 1)], "p double, isFraud int")
    assert ev.eval_metrics(df, round_digits=None).first()["roc_auc"] is None


def test_ties_count_half_in_auc(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0)], "p double, isFraud int")
    assert ev.eval_metrics(df, round_digits=None).first()["roc_auc"] == 0.5


def test_monitor_false_positive_rate_and_empty_log(spark):
    log = spark.createDataFrame([(0.9, "DECLINE", 0), (0.5, "REVIEW", 1), (0.1, "APPROVE", 0), (0.2, "APPROVE", None)],
                                "fraud_probability double, decision string, isFraud int")
    m = mo.monitor_metrics(log).first()
    assert m["false_positive_rate"] == 0.5 and math.isclose(m["actual_fraud_rate"], 1 / 3)
    assert mo.monitor_metrics(log.where("false")).count() == 0
    unlabelled = mo.monitor_metrics(log.withColumn("isFraud", F.lit(None).cast("int"))).first()
    assert unlabelled["false_positive_rate"] is None and unlabelled["actual_fraud_rate"] is None


def test_zero_baseline_is_a_baseline(spark):
    rows = [(b, 0.0) for b in range(8)] + [(8, 0.9)]
    log = spark.createDataFrame(rows, "batch long, fraud_probability double")
    alarms = [r["alarm"] for r in mo.drift_alarm(log).orderBy("batch").collect()]
    assert alarms == [False] * 8 + [True]
    rows = [(b, 0.1) for b in range(3)] + [(3, 0.1), (4, 0.9)]
    alarms = [r["alarm"] for r in mo.drift_alarm(spark.createDataFrame(rows, "batch long, fraud_probability double"))
              .orderBy("batch").collect()]
    assert alarms == [False, False, False, False, True]


def test_decision_uses_unrounded_score(spark):
    from fraudspark.operators.score import decision_records
    df = spark.createDataFrame([(0.29996,), (0.70004,)], "p double")
    rows = decision_records(df, prob="p").collect()
    assert [r["decision"] for r in rows] == ["APPROVE", "DECLINE"]
    assert [r["fraud_probability"] for r in rows] == [0.3, 0.7]


def test_no_positives_gives_null_average_precision(spark):
    df = spark.createDataFrame([(0.9, 0), (0.2, 0)], "p double, isFraud int")
    m = ev.eval_metrics(df, round_digits=None).first()
    assert m["pr_auc"] is None and m["roc_auc"] is None
