"""Decisions, scoring records and the drift stress set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import seeded_fraction

# Default decision thresholds (run-time parameters of every job).
THRESHOLD_APPROVE = 0.3
THRESHOLD_DECLINE = 0.7
DECISIONS = ("APPROVE", "REVIEW", "DECLINE")


def decide(p: Column, approve_below: float = THRESHOLD_APPROVE, decline_above: float = THRESHOLD_DECLINE) -> Column:
    """APPROVE below the lower bound, DECLINE above the upper, REVIEW between (bounds inclusive)."""
    return (F.when(p < approve_below, F.lit("APPROVE")).when(p > decline_above, F.lit("DECLINE"))
            .otherwise(F.lit("REVIEW")))


def decision_records(df: DataFrame, prob: str = "fraud_probability", run_id: str | Column = "unknown",
                     approve_below: float = THRESHOLD_APPROVE, decline_above: float = THRESHOLD_DECLINE,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Output records: the decision uses the unrounded score, the record shows it
    rounded to four places; model version is the first eight characters of the run id."""
    rid = F.lit(run_id) if isinstance(run_id, str) else run_id
    p = F.col(prob)
    return df.select(*keep,
                     F.bround(p, 4).alias("fraud_probability"),
                     decide(p, approve_below, decline_above).alias("decision"),
                     F.substring(rid, 1, 8).alias("model_version"),
                     F.lit(float(approve_below)).alias("threshold_approve"),
                     F.lit(float(decline_above)).alias("threshold_decline"))


def update_sample(df: DataFrame, column: str, value: Column, eligible: Column, fraction: float = 0.10,
                  seed: int = 42, key: str = "TransactionID", flag: str = "updated") -> DataFrame:
    """Conditional update of an exact sample: ``column`` becomes ``value`` in
    floor(n * fraction) of the n eligible rows, chosen by a portable hash of the
    key and marked by ``flag``; a null condition is not eligible."""
    yes = F.coalesce(eligible, F.lit(False))
    chosen = seeded_fraction(df.where(yes), fraction, seed, key, flag=flag)
    chosen = chosen.withColumn(column, F.when(F.col(flag), value).otherwise(F.col(column)))
    return chosen.unionByName(df.where(~yes).withColumn(flag, F.lit(False)))
