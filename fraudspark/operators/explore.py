"""Exploration tables: class counts, per-class amount description, hourly rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.time import hour_expr
from .joins import null_safe_join
from .ordering import exact_quantiles


def class_counts(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Value counts of the label with each value's share of all rows."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per label value: an unpartitioned window over the counts is bounded
    return c.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def describe_by_class(df: DataFrame, value: str = "TransactionAmt", label: str = "isFraud") -> DataFrame:
    """count, mean, std, min, 25 / 50 / 75 % (exact, linear), max per class."""
    base = df.groupBy(label).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                                 F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
                                 F.max(value).alias("max"))
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], [label])
    wide = q.groupBy(label).pivot("q", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    wide = wide.select(label, *[F.col(f"`{c}`").alias(n) for c, n in
                                zip(("0.25", "0.5", "0.75"), ("p25", "p50", "p75"))])
    return null_safe_join(base, wide, [label], "left")


def hourly_rate(df: DataFrame, dt: str = "TransactionDT", label: str = "isFraud") -> DataFrame:
    return df.groupBy(hour_expr(F.col(dt)).cast("int").alias("hour")).agg(
        F.avg(F.col(label).cast("double")).alias("fraud_rate"), F.count(F.lit(1)).alias("n"))
