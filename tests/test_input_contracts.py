"""Input contracts and refusals: ids out of range, fractional ids, NaN amounts, too few rows to oversample."""

import pytest
from pyspark.sql import functions as F

from fraudspark.operators import ordering, quality, resample
from fraudspark.sources import io


def test_bad_requests_are_rejected_and_do_not_end_the_batch(spark):
    texts = ['{"TransactionID": 1, "TransactionAmt": 5, "card1": 1e30}', '{"TransactionID": 2, "TransactionAmt": 5, "card1": "9500.7"}',
             '{"TransactionID": 3, "TransactionAmt": "NaN", "card1": 9500}', '{"TransactionID": 4, "TransactionAmt": 5, "card1": "9500"}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r["TransactionID"]: r for r in quality.validate_requests(io.parse_requests(df)).collect()}
    assert [got[i]["accepted"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert got[1]["card1"] is None and got[2]["card1"] is None and got[4]["card1"] == 9500


def test_oversampling_refuses_too_few_rows(spark):
    one = spark.range(20).select(F.col("id").alias("TransactionID"), F.col("id").cast("double").alias("a"), F.lit(0).alias("isFraud"))
    with pytest.raises(ValueError, match="two classes"):
        resample.smote(one, ["a"], k=3)
    few = one.withColumn("isFraud", (F.col("TransactionID") < 3).cast("int"))
    with pytest.raises(ValueError, match="more than 3"):
        resample.smote(few, ["a"], k=3)


def test_prefix_sums_carry_a_key_over_many_tasks(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 3).alias("g"), F.col("id").alias("o"), F.lit(1.0).alias("x"))
    got = ordering.prefix_sums(df, ["o"], ["x"], partitions=8, partition_by=["g"]).toPandas().sort_values(["g", "o"])
    name = [c for c in got.columns if c not in ("g", "o", "x")][0]
    assert (got.groupby("g").x.cumsum() == got[name]).all()


def test_csv_findings_count_unreadable_texts(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    spark.createDataFrame([("1", "abc", "3.5"), ("2", "1", "xx"), ("3", None, "4"), ("1e3x", "0", None)],
                          "TransactionID string, isFraud string, TransactionAmt string") \
        .coalesce(1).write.option("header", True).csv(path)
    got = {r["column_name"]: (r["n_values"], r["n_bad"], r["passed"]) for r in io.csv_type_findings(spark, path).collect()}
    assert got == {"TransactionID": (4, 1, False), "isFraud": (3, 1, False), "TransactionAmt": (3, 1, False)}


def test_categories_meet_across_numeric_types(spark):
    from fraudspark.operators import encoders as enc
    fit = spark.createDataFrame([(9500,), (9500,), (7,)], "card1 long")
    state = enc.fit_frequency_encoding(fit, ["card1"], normalize=False)
    new = spark.createDataFrame([(1, 9500.0), (2, 7.5), (3, None)], "id long, card1 double")
    assert {r["id"]: r["card1"] for r in state.transform(new).collect()} == {1: 2.0, 2: 0.0, 3: 0.0}
    # without a broadcast null categories are spread and still read as unseen
    state.state_rows = None
    assert {r["id"]: r["card1"] for r in state.transform(new).collect()} == {1: 2.0, 2: 0.0, 3: 0.0}
