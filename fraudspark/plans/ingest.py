"""Ingest job: validate both tables, profile them, write them, join them, in one pass over each input.

Columns are checked before anything is read.  Each input is then read once: it is written to a staging
folder.  Row rules, null counts and class counts are one aggregation over the written copy (compact
columns instead of the source), keys are counted in one narrow column of it, and the join reads the
copies too.  (Metrics observed during the write would save that aggregation, but once a session has an
observation Spark cannot ship a freshly fitted logistic model to its tasks any more.)  Only when every hard rule holds are the staged folders renamed to their places; else they are removed, so
a failure leaves nothing behind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as dq
from ..sources import io


@dataclass
class IngestResult:
    transactions_path: str
    identity_path: str
    merged_path: str
    report: DataFrame
    null_rates: DataFrame
    class_rate: DataFrame


def left_join_identity(transactions: DataFrame, identity: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Every transaction kept; identity columns null where no row exists.

    The identity key is checked for duplicates first (see ``ingest``), so the
    join cannot fan out.  Both sides may be large: the plan is a sort-merge
    join on the key unless AQE finds the identity side small at run time.
    """
    return transactions.join(identity, key, "left")


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in its place; an earlier one goes."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(_file_system(spark, staged)[1], target):
        raise OSError(f"cannot rename {staged} to {path}")


def _measured(df: DataFrame, label: str | None, amount: str) -> dict:
    """Rows, nulls of every column and broken rules of a written copy, in one aggregation."""
    metrics = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(df.schema.fields):
        miss = F.col(f.name).isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(f.name)
        metrics.append(F.count_if(miss).alias(f"null_{i}"))
    if label in df.columns and amount in df.columns:
        lab, amt = F.col(label), F.col(amount)
        metrics += [F.count_if(lab.isNotNull() & ~lab.isin(0, 1)).alias("bad_labels"), F.sum(lab.cast("double")).alias("positives"), F.count(lab).alias("labelled"),
                    F.count_if(amt < dq.AMOUNT_MIN).alias("negative"), F.count_if(amt > dq.AMOUNT_MAX).alias("extreme")]
    return df.agg(*metrics).first().asDict()


def _row_rules(m: dict, table: str) -> list[tuple]:
    """The row rules' report rows from the metrics."""
    if "bad_labels" not in m:
        return []
    rate = m["positives"] / m["labelled"] if m["labelled"] else None
    out_of_band = int(rate is None or rate < dq.LABEL_RATE_MIN or rate > dq.LABEL_RATE_MAX)
    return [dq._row(table, "label_domain", "hard", m["bad_labels"], ""),
            dq._row(table, "label_rate", "soft", out_of_band, "" if rate is None else str(round(rate, 6))),
            dq._row(table, "negative_amount", "soft", m["negative"], ""), dq._row(table, "extreme_amount", "soft", m["extreme"], "")]


def ingest(spark: SparkSession, transactions: DataFrame, identity: DataFrame, out_dir: str,
           key: str = "TransactionID", label: str = "isFraud", amount: str = "TransactionAmt") -> IngestResult:
    """Write ``transactions``, ``identity`` and ``merged`` under ``out_dir``; a broken hard rule raises and
    leaves nothing there."""
    tables = {"transactions": transactions, "identity": identity}
    required = {"transactions": dq.TRANSACTION_REQUIRED, "identity": dq.IDENTITY_REQUIRED}
    schema = dq._schema_rows(spark, transactions, "transactions", required["transactions"]).unionByName(
        dq._schema_rows(spark, identity, "identity", required["identity"]))
    dq.enforce(schema)
    staging = f"{out_dir.rstrip('/')}__staging"
    path = lambda name: f"{staging}/{name}"
    try:
        for name, df in tables.items():
            io.write_parquet(df, path(name))
        m = _measured(spark.read.parquet(path("transactions")), label, amount)
        rows = _row_rules(m, "transactions")
        for name in tables:  # one narrow column of the written copy
            twice = dq.duplicate_key_count(spark.read.parquet(path(name)).select(key), key).first()["n_duplicates"]
            rows.append(dq._row(name, "duplicate_keys", "hard", twice, ""))
        report = schema.unionByName(spark.createDataFrame(rows, dq.REPORT_SCHEMA))
        dq.enforce(report)
        # the join reads compact Parquet instead of the inputs
        merged = left_join_identity(spark.read.parquet(path("transactions")), spark.read.parquet(path("identity")), key)
        io.write_parquet(merged, path("merged"))
        for name in ("transactions", "identity", "merged"):
            _publish(spark, path(name), f"{out_dir}/{name}")
    finally:
        _remove(spark, staging)
    nulls = [(f.name, m[f"null_{i}"] / m["n"] if m["n"] else None) for i, f in enumerate(transactions.schema.fields)]
    rate = m["positives"] / m["labelled"] if m.get("labelled") else None
    return IngestResult(f"{out_dir}/transactions", f"{out_dir}/identity", f"{out_dir}/merged", report,
                        spark.createDataFrame(nulls, "column_name string, null_rate double"),
                        spark.createDataFrame([(rate, None if rate is None else 1 - rate, m.get("labelled"))], "positive_rate double, negative_rate double, n_labelled long"))
