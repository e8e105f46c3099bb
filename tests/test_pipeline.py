"""Feature pipeline integration and train/apply parity on the fixture tables."""

from pyspark.sql import types as T

from fraudspark.plans.feature_model import FeatureModel, FeaturePipeline
from fraudspark.session import scratch_path
from fraudspark.sources import tables as tb

from .conftest import SMALL


def test_feature_matrix_numeric_and_parity(spark):
    t = tb.txn(spark, SMALL).drop("p")
    train = t.where("TransactionDT < 1800000")
    rest = t.where("TransactionDT >= 1800000")
    fm, x = FeaturePipeline(min_v_cols=5).fit_transform(train)
    feats = fm.feature_columns
    assert "TransactionID" not in feats and "TransactionDT" not in feats and "isFraud" not in feats
    assert all(isinstance(x.schema[c].dataType, T.NumericType) for c in feats)
    assert fm.dropped_v == ["V2", "V5"]
    applied = fm.transform(rest)
    assert set(feats) <= set(applied.columns)
    # saved state gives the same values as the in-memory state
    path = scratch_path(spark, "fm")
    fm.save(path)
    again = FeatureModel.load(spark, path).transform(rest)
    a = applied.select("TransactionID", *feats).orderBy("TransactionID").collect()
    b = again.select("TransactionID", *feats).orderBy("TransactionID").collect()
    assert a == b


def test_frozen_profile_scoring_single_row(spark):
    t = tb.txn(spark, SMALL).drop("p")
    fm, _ = FeaturePipeline(min_v_cols=5).fit_transform(t)
    one = t.limit(1).drop("TransactionID", "isFraud")
    out = fm.transform(one, frozen_profile=True).first()
    assert out["card_txn_count"] >= 1       # profile from training, not the single row
    assert out["amount_zscore"] is not None


def test_ingest_refuses_before_writing(spark):
    import os

    import pytest

    from fraudspark.operators.quality import DataQualityError
    from fraudspark.plans.ingest import ingest
    out = scratch_path(spark, "ingest_fail")
    bad = tb.transactions(spark, SMALL).drop("isFraud")
    with pytest.raises(DataQualityError, match="Missing required columns"):
        ingest(spark, bad, tb.identity(spark, SMALL), out)
    assert not os.path.exists(out.replace("file:", ""))


def test_ingest_join_keeps_every_transaction(spark):
    from fraudspark.plans.ingest import ingest
    t = tb.transactions(spark, SMALL)
    res = ingest(spark, t, tb.identity(spark, SMALL), scratch_path(spark, "ingest_ok"))
    merged = spark.read.parquet(res.merged_path)
    assert merged.count() == t.count()
    assert merged.where("DeviceInfo IS NOT NULL").count() > 0


def test_ingest_reads_each_input_once_and_leaves_nothing_after_a_failure(spark, tmp_path):
    import os

    import pytest
    from pyspark.sql import functions as F

    from fraudspark.operators import quality as dq
    from fraudspark.operators.quality import DataQualityError
    from fraudspark.plans.ingest import ingest
    tx, ident = tb.transactions(spark, SMALL), tb.identity(spark, SMALL)
    reads = {"tx": spark.sparkContext.accumulator(0), "ident": spark.sparkContext.accumulator(0)}

    def counting(df, name):
        def run(batches):
            for b in batches:
                reads[name].add(b.num_rows)
                yield b
        return df.mapInArrow(run, df.schema)

    res = ingest(spark, counting(tx, "tx"), counting(ident, "ident"), str(tmp_path / "ok"))
    assert reads["tx"].value == tx.count() and reads["ident"].value == ident.count()
    assert sorted(os.listdir(tmp_path)) == ["ok"] and sorted(os.listdir(tmp_path / "ok")) == ["identity", "merged", "transactions"]
    want = {(r["table"], r["rule"]): (r["violations"], r["passed"]) for r in dq.transaction_report(spark, tx).unionByName(dq.identity_report(spark, ident)).collect()}
    assert {(r["table"], r["rule"]): (r["violations"], r["passed"]) for r in res.report.collect()} == want
    assert {r["column_name"]: r["null_rate"] for r in res.null_rates.collect()} == {r["column_name"]: r["null_rate"] for r in dq.null_rates(tx).collect()}
    assert res.class_rate.first() == dq.class_rate(tx).first()
    twice = tx.unionByName(tx.limit(3))
    with pytest.raises(DataQualityError, match="duplicate_keys"):
        ingest(spark, twice, ident, str(tmp_path / "bad"))
    with pytest.raises(DataQualityError, match="label_domain"):
        ingest(spark, tx.withColumn("isFraud", F.lit(7)), ident, str(tmp_path / "bad"))
    assert sorted(os.listdir(tmp_path)) == ["ok"]
    ingest(spark, tx, ident, str(tmp_path / "ok"))                      # a second run replaces the first
    assert spark.read.parquet(str(tmp_path / "ok" / "merged")).count() == tx.count()


def test_csv_lines(spark, tmp_path):
    from fraudspark.sources import io
    d = tmp_path / "csv"
    d.mkdir()
    head = 'TransactionID,note,isFraud\n'
    (d / "a.csv").write_text(head + '1,"x, ""y""",0\n2,plain,1\n3,"open,1\n4,short\n5,a,0,extra\n\n')
    (d / "b.csv").write_text(head + '6,,\n7,"",x\n8,mid"dle,1\n9,"a"",0\n')
    rows, bad = io.csv_lines(spark, str(d))
    assert {tuple(r) for r in rows.collect()} == {(1, 'x, "y"', 0), (2, "plain", 1), (6, None, None), (7, "", None)} or \
        {tuple(r) for r in rows.collect()} == {(1, 'x, "y"', 0), (2, "plain", 1), (6, None, None), (7, None, None)}
    assert {(r["line"][:1], r["reason"]) for r in bad.collect()} == {
        ("3", "unclosed quote"), ("4", "too few fields: 2"), ("5", "too many fields: 4"), ("8", "unclosed quote"), ("9", "unclosed quote")}
    assert {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv", "b.csv"}
    counts = {r["reason"]: r["n"] for r in io.quarantine_csv(spark, str(d), str(tmp_path / "rows"), str(tmp_path / "bad")).collect()}
    assert counts == {None: 4, "unclosed quote": 3, "too few fields": 1, "too many fields": 1}
