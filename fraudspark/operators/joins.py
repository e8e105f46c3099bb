"""Join helpers with an explicit broadcast rule.

A side is broadcast only when its size is known (it was measured when the
state was fitted, or it is bounded by construction) and below
``MAX_BROADCAST_BYTES``, or, where only rows were counted, ``MAX_BROADCAST_ROWS``.  Otherwise the plan is left to AQE, which measures
the shuffled side at run time, broadcasts it when it is small and splits
skewed partitions of a sort-merge join when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow state table (a key and a few numbers) that may be shipped to
# every executor; ~2M rows x ~40 bytes stays well under 100 MB.
MAX_BROADCAST_ROWS = 2_000_000


# Bytes of keys and values of a state that may be shipped to every executor (its hash table there takes
# about three times as much).
MAX_BROADCAST_BYTES = 64 << 20


def can_broadcast(known_rows: int | None, limit: int = MAX_BROADCAST_ROWS, known_bytes: int | None = None) -> bool:
    if known_bytes is not None:
        return known_bytes <= MAX_BROADCAST_BYTES
    return known_rows is not None and known_rows <= limit


def attach(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
           known_rows: int | None = None) -> DataFrame:
    """Left-join a state table onto ``big``; broadcast only with a checked size."""
    side = F.broadcast(small) if can_broadcast(known_rows) else small
    return big.join(side, on, how)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equality join in which null keys match each other, keeping the left key columns.

    Without keys the right side must be an aggregate of a few rows; every left
    row then meets each of them.
    """
    if not on:
        return left.withColumn("_one", F.lit(1)).join(F.broadcast(right.withColumn("_one", F.lit(1))), "_one", how) \
            .drop("_one")
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(other, cond, how).drop(*[f"_r_{c}" for c in on])
