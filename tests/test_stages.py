"""Feature stages as Spark ML estimators and models."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from fraudspark.operators import encoders as enc
from fraudspark.operators import stages as st
from fraudspark.session import scratch_path
from fraudspark.sources import tables as tb

from .conftest import SMALL


def test_stages_equal_the_operators_and_survive_saving(spark):
    t = tb.txn(spark, SMALL).drop("p")
    train, rest = t.where("TransactionID % 3 > 0"), t.where("TransactionID % 3 = 0")
    pipe = Pipeline(stages=[st.CardProfiler(), st.NullIndicator(), st.OrdinalEncoder(), st.TargetEncoder(inputCols=["P_emaildomain", "absent"], smoothing=2.0),
                            st.FrequencyEncoder(inputCols=["card1"], normalize=False), st.CorrelationPruner(minCols=5)])
    path = scratch_path(spark, "stages")
    pipe.write().overwrite().save(path + "/unfitted")
    fitted = Pipeline.load(path + "/unfitted").fit(train)
    fitted.write().overwrite().save(path + "/fitted")
    loaded = PipelineModel.load(path + "/fitted")
    a, b = fitted.transform(rest), loaded.transform(rest)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0
    target = loaded.stages[3]
    e = enc.fit_target_encoding(train, ["P_emaildomain"], smoothing=2.0)
    assert target.getOrDefault("inputCols") == ["P_emaildomain"] and target.getOrDefault("globalMean") == e.global_mean
    assert target.encoding().transform(rest).select("TransactionID", "P_emaildomain").exceptAll(e.transform(rest).select("TransactionID", "P_emaildomain")).count() == 0
    assert {"V2", "V5"}.isdisjoint(b.columns) and loaded.stages[5].getOrDefault("droppedCols") == ["V2", "V5"]
    assert b.where("DeviceType not in (-1, 0, 1)").count() == 0 and "DeviceType_was_null" in b.columns
    folds = train.withColumn("fold", F.col("TransactionID") % 5)
    again = target.out_of_fold(folds, "fold").select("TransactionID", "P_emaildomain")
    assert again.exceptAll(enc.target_encode_out_of_fold(folds, e, "isFraud", "fold").select("TransactionID", "P_emaildomain")).count() == 0


def test_stage_params_can_be_overridden(spark):
    t = tb.txn(spark, SMALL)
    est = st.FrequencyEncoder(inputCols=["card1"])
    shares = est.fit(t).transform(t).agg(F.max("card1")).first()[0]
    counts = est.fit(t, {est.normalize: False}).transform(t).agg(F.max("card1")).first()[0]
    assert shares < 1 <= counts
