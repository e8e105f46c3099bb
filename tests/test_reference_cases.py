"""The original project's unit cases, on Spark DataFrames."""

import math

import pytest
from pyspark.sql import functions as F

from fraudspark.operators import encoders as enc
from fraudspark.operators import quality as dq
from fraudspark.operators import score as sc
from fraudspark.sources import io
from fraudspark.sources import tables as tb

from .conftest import SMALL


def _transactions(spark):
    """The transactions view of the smallest test tables."""
    return tb.transactions(spark, SMALL)


def _on_one_row(df, column, value):
    """``df`` with ``column`` set to ``value`` in the row of the smallest id."""
    first = df.agg(F.min("TransactionID")).first()[0]
    return df.withColumn(column, F.when(F.col("TransactionID") == first, F.lit(value)).otherwise(F.col(column)))


def test_valid_transactions_pass(spark):
    rep = dq.transaction_report(spark, _transactions(spark))
    dq.enforce(rep)
    assert rep.where("severity = 'hard' AND NOT passed").count() == 0


def test_missing_label_column_raises(spark):
    with pytest.raises(dq.DataQualityError, match="Missing required columns"):
        dq.enforce(dq.transaction_report(spark, _transactions(spark).drop("isFraud")))


def test_duplicate_id_raises(spark):
    df = _transactions(spark)
    df = _on_one_row(df, "TransactionID", df.agg(F.max("TransactionID")).first()[0])
    with pytest.raises(dq.DataQualityError, match="duplicate"):
        dq.enforce(dq.transaction_report(spark, df))


def test_bad_label_raises(spark):
    df = _on_one_row(_transactions(spark), "isFraud", 2)
    with pytest.raises(dq.DataQualityError, match="label_domain"):
        dq.enforce(dq.transaction_report(spark, df))


def test_zero_rate_only_warns(spark):
    df = _transactions(spark).withColumn("isFraud", F.lit(0))
    rep = dq.transaction_report(spark, df)
    dq.enforce(rep)  # soft rule: no exception
    assert rep.where("rule = 'label_rate'").first()["passed"] is False


def test_negative_amount_only_warns(spark):
    df = _on_one_row(_transactions(spark).where("TransactionAmt >= 0"), "TransactionAmt", -1.0)
    rep = dq.transaction_report(spark, df)
    dq.enforce(rep)
    assert rep.where("rule = 'negative_amount'").first()["violations"] == 1


def test_identity_rules(spark):
    side = tb.identity(spark, SMALL)
    dq.enforce(dq.identity_report(spark, side))
    with pytest.raises(dq.DataQualityError, match="Missing required columns"):
        dq.enforce(dq.identity_report(spark, side.drop("TransactionID")))


# The frames and expected encodings of the published cases.
def _email(spark):
    rows = [("gmail", 0), ("gmail", 1), ("yahoo", 1), ("yahoo", 1), ("yahoo", 0), ("rare", 0)]
    return spark.createDataFrame([(i, e, y) for i, (e, y) in enumerate(rows)], "id long, email string, y int")


def test_target_encoder_hand_values(spark):
    e = enc.fit_target_encoding(_email(spark), ["email"], "y", smoothing=1.0)
    assert math.isclose(e.global_mean, 0.5)
    vals = {r["category"]: r["value"] for r in e.state.collect()}
    assert math.isclose(vals["gmail"], 0.5) and math.isclose(vals["yahoo"], 0.625)
    assert math.isclose(vals["rare"], 0.25)
    new = spark.createDataFrame([(1, "unseen"), (2, None)], "id long, email string")
    out = {r["id"]: r["email"] for r in e.transform(new).collect()}
    assert out == {1: 0.5, 2: 0.5}
    # a fitted column missing at apply time gets the global mean
    assert e.transform(new.drop("email")).first()["email"] == 0.5


def test_target_encoder_needs_label(spark):
    with pytest.raises(ValueError):
        enc.fit_target_encoding(_email(spark).drop("y"), ["email"], "y")


def test_frequency_encoder(spark):
    df = spark.createDataFrame([(c,) for c in "AAABBC"], "card string")
    f = enc.fit_frequency_encoding(df, ["card"])
    vals = {r["category"]: r["value"] for r in f.state.collect()}
    assert math.isclose(vals["A"], 1 / 2) and math.isclose(vals["B"], 1 / 3) and math.isclose(vals["C"], 1 / 6)
    raw = enc.fit_frequency_encoding(df, ["card"], normalize=False)
    assert {r["category"]: r["value"] for r in raw.state.collect()} == {"A": 3.0, "B": 2.0, "C": 1.0}
    unseen = spark.createDataFrame([("Z",)], "card string")
    assert f.transform(unseen).first()["card"] == 0.0


def test_decisions(spark):
    df = spark.createDataFrame([(0.05,), (0.50,), (0.92,), (0.3,), (0.7,)], "p double")
    got = [r["d"] for r in df.select(sc.decide(F.col("p")).alias("d")).collect()]
    assert got == ["APPROVE", "REVIEW", "DECLINE", "REVIEW", "REVIEW"]


def test_request_contract(spark):
    texts = ['{"TransactionAmt":149.50,"ProductCD":"W","card1":9500,"card4":"visa","card6":"debit",'
             '"P_emaildomain":"gmail.com","DeviceType":"desktop"}',
             '{"TransactionAmt":-50,"ProductCD":"W"}', '{"ProductCD":"W"}', '{"TransactionAmt":"12.5"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "TransactionID long, value string")
    v = {r["TransactionID"]: r for r in dq.validate_requests(io.parse_requests(df)).collect()}
    assert v[0]["accepted"] == 1 and v[0]["TransactionAmt"] == 149.5
    assert v[1]["accepted"] == 0 and "positive" in v[1]["reasons"]
    assert v[2]["accepted"] == 0 and "required" in v[2]["reasons"]
    assert v[3]["accepted"] == 1 and v[3]["TransactionAmt"] == 12.5   # numbers sent as text are coerced
