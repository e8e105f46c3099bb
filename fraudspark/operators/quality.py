"""Table-level data-quality rules.

Every rule produces report rows ``(table, rule, severity, violations, passed,
detail)``.  Row-level rules of one table share a single aggregation pass;
the duplicate-key rule needs its own group-by on the key.  ``enforce`` raises
on failed hard rules, soft rules only warn.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Required columns of the two input tables.
TRANSACTION_REQUIRED = [
    "TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD",
    "card1", "card2", "card3", "card4", "card5", "card6",
    "addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain",
    "C1", "C2", "C3", "C4", "M1", "M2", "M3",
]
IDENTITY_REQUIRED = ["TransactionID", "DeviceType", "DeviceInfo"]
# Declared type families (integer / floating) of four columns.
EXPECTED_TYPES = {"TransactionID": "int", "isFraud": "int", "TransactionDT": "int", "TransactionAmt": "float"}
# Amount bounds and the plausible label-rate band.
AMOUNT_MIN, AMOUNT_MAX = 0.0, 20_000.0
LABEL_RATE_MIN, LABEL_RATE_MAX = 0.01, 0.20

REPORT_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("violations", T.LongType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("detail", T.StringType()),
])


class DataQualityError(ValueError):
    pass


def _row(table, rule, severity, violations, detail=""):
    return (table, rule, severity, int(violations), int(violations) == 0, detail)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def with_value_counts(rows: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``n_values`` (non-null values, one pass over ``df``; 0 when absent) to
    report rows keyed by ``column_name``."""
    held = [F.struct(F.lit(c).alias("column_name"), F.count(F.col(c)).alias("n_values")) for c in cols]
    if not held:
        return rows.withColumn("n_values", F.lit(0).cast("bigint"))
    counts = df.agg(F.array(*held).alias("v")).select(F.explode("v").alias("v")).select("v.*")
    # one row per listed column: a bounded broadcast
    return rows.join(F.broadcast(counts), "column_name", "left").withColumn("n_values", F.coalesce("n_values", F.lit(0)))


def required_columns_report(spark: SparkSession, df: DataFrame, required: Sequence[str],
                            table: str) -> DataFrame:
    """One row per required column with its presence and number of values."""
    present = set(df.columns)
    rows = spark.createDataFrame([(table, c, c in present) for c in required],
                                 "table string, column_name string, present boolean")
    return with_value_counts(rows, df, [c for c in required if c in present])


def check_required_columns(df: DataFrame, required: Sequence[str], table: str) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise DataQualityError(f"[{table}] Missing required columns: {missing}")


def type_family(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    return dt.simpleString()


def dtype_report(df: DataFrame, table: str, expected: dict[str, str] = EXPECTED_TYPES) -> list[tuple]:
    """Soft rule: declared type family per column; absent columns are skipped."""
    out = []
    for c, fam in expected.items():
        if c in df.columns:
            actual = type_family(df.schema[c].dataType)
            out.append((table, c, fam, actual, actual == fam))
    return out


def duplicate_key_count(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows beyond the first per key value (a null key is a value too)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
                 F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("n_rows")))


def label_domain_violations(df: DataFrame, label: str = "isFraud", allowed=(0, 1)) -> DataFrame:
    """Distinct non-null label values outside the allowed set, with their row counts."""
    return (df.select(F.col(label).alias("value"))
            .where(F.col("value").isNotNull() & ~F.col("value").isin(*allowed))
            .groupBy("value").agg(F.count(F.lit(1)).alias("n_rows")))


def row_rules(df: DataFrame, label: str = "isFraud", amount: str = "TransactionAmt") -> DataFrame:
    """Label and amount rules of the transaction table in ONE aggregation pass."""
    lab, amt = F.col(label), F.col(amount)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(lab.isNotNull() & ~lab.isin(0, 1)).alias("bad_label_rows"),
        F.avg(lab).alias("label_rate"),
        F.count_if(amt < AMOUNT_MIN).alias("negative_amounts"),
        F.count_if(amt > AMOUNT_MAX).alias("extreme_amounts"),
    )


def _schema_rows(spark: SparkSession, df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    rows = []
    missing = missing_columns(df, required)
    rows.append(_row(table, "required_columns", "hard", len(missing), ",".join(missing)))
    for _, c, fam, actual, ok in dtype_report(df, table):
        rows.append(_row(table, f"dtype:{c}", "soft", 0 if ok else 1, f"expected {fam}, got {actual}"))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def _rule(table: str, rule: str, severity: str, violations, detail=None):
    detail = F.lit("") if detail is None else detail
    v = F.coalesce(violations.cast("bigint"), F.lit(0).cast("bigint"))
    return F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                    v.alias("violations"), (v == 0).alias("passed"), detail.cast("string").alias("detail"))


def _duplicate_rows(df: DataFrame, table: str, key: str) -> DataFrame:
    d = duplicate_key_count(df, key)
    return d.select(_rule(table, "duplicate_keys", "hard", F.col("n_duplicates")).alias("r")).select("r.*")


def transaction_report(spark: SparkSession, df: DataFrame, table: str = "transactions",
                       key: str = "TransactionID", label: str = "isFraud",
                       amount: str = "TransactionAmt",
                       required: Sequence[str] = TRANSACTION_REQUIRED) -> DataFrame:
    """All transaction rules as report rows, built lazily: schema rules from
    the schema, one aggregation pass for the row rules, one group-by for keys."""
    parts = [_schema_rows(spark, df, table, required)]
    if key in df.columns:
        parts.append(_duplicate_rows(df, table, key))
    if label in df.columns and amount in df.columns:
        r = row_rules(df, label, amount)
        rate = F.col("label_rate")
        out_of_band = F.when(rate.isNull() | (rate < LABEL_RATE_MIN) | (rate > LABEL_RATE_MAX), 1).otherwise(0)
        parts.append(r.select(F.explode(F.array(
            _rule(table, "label_domain", "hard", F.col("bad_label_rows")),
            _rule(table, "label_rate", "soft", out_of_band, F.round(rate, 6)),
            _rule(table, "negative_amount", "soft", F.col("negative_amounts")),
            _rule(table, "extreme_amount", "soft", F.col("extreme_amounts")),
        )).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def identity_report(spark: SparkSession, df: DataFrame, table: str = "identity",
                    key: str = "TransactionID", required: Sequence[str] = IDENTITY_REQUIRED) -> DataFrame:
    """Identity rules: columns, types, and duplicate keys (a fan-out guard for the join)."""
    out = _schema_rows(spark, df, table, required)
    if key in df.columns:
        out = out.unionByName(_duplicate_rows(df, table, key))
    return out


def enforce(report: DataFrame) -> None:
    """Raise on failed hard rules; log failed soft rules."""
    failed = report.where(~F.col("passed")).collect()
    for r in failed:
        if r["severity"] == "soft":
            log.warning("[%s] %s: %s violations %s", r["table"], r["rule"], r["violations"], r["detail"])
    hard = [r for r in failed if r["severity"] == "hard"]
    if hard:
        msgs = []
        for r in hard:
            if r["rule"] == "required_columns":
                msgs.append(f"[{r['table']}] Missing required columns: {r['detail']}")
            else:
                msgs.append(f"[{r['table']}] {r['rule']}: {r['violations']} violations {r['detail']}")
        raise DataQualityError("; ".join(msgs))


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null share of every column in one pass, long form ``(column_name, null_rate)``.

    NaN counts as missing for floating columns, as in pandas.
    """
    cols = list(columns or df.columns)
    aggs = []
    for c in cols:
        miss = F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(c)
        aggs.append(F.avg(miss.cast("double")).alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_rate)")


def class_rate(df: DataFrame, label: str = "isFraud") -> DataFrame:
    return df.agg(F.avg(label).alias("positive_rate"), (1 - F.avg(label)).alias("negative_rate"),
                  F.count(label).alias("n_labelled"))


def validate_requests(df: DataFrame, amount: str = "TransactionAmt") -> DataFrame:
    """Per-record input contract: the amount is required and must be positive;
    typed optional fields that were sent but do not parse are rejected too.

    Adds ``reasons`` (``;``-joined, empty when valid) and ``accepted`` (0/1).
    Columns ``_bad_<field>`` left by ``sources.io.parse_requests`` are folded in.
    """
    checks = [
        F.when(F.col(amount).isNull(), F.lit(f"{amount}: field required")),
        F.when((F.col(amount) <= 0) | F.isnan(F.col(amount).cast("double")), F.lit(f"{amount} must be positive")),
    ]
    bad_cols = [c for c in df.columns if c.startswith("_bad_")]
    checks += [F.when(F.col(c), F.lit(f"{c[5:]}: invalid value")) for c in bad_cols]
    reasons = F.concat_ws(";", *checks)
    keep = [c for c in df.columns if c not in bad_cols]
    return df.select(*keep, reasons.alias("reasons")).withColumn(
        "accepted", (F.col("reasons") == "").cast("int"))


def decision_contract_violations(df: DataFrame, prob: str = "fraud_probability",
                                 decision: str = "decision") -> DataFrame:
    """Output contract: probability in [0, 1], decision in the three labels."""
    ok = F.col(prob).between(0.0, 1.0) & F.col(decision).isin("APPROVE", "REVIEW", "DECLINE")
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(~F.coalesce(ok, F.lit(False))).alias("violations"))
