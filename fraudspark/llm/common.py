"""Helpers shared by the corpus operators."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

#: ASCII white space of the contracts, ``[\x20\x09-\x0D]``.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Text handed to a Python worker at a time; documents differ in length by four orders of magnitude,
#: so batches are bounded by bytes and rows, never by rows alone.
BATCH_BYTES, BATCH_ROWS = "16m", 2000


def prepared(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session and make sure the shared folder is known."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ensure_checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names clash without regard to case)."""
    taken = {c.lower() for c in df.columns}
    return next(n for i in itertools.count() if (n := f"{name}_{i}" if i else name).lower() not in taken)


def held_out(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, divisible by ``folds``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds == 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lookup(big: DataFrame, small: DataFrame, key: str | list[str], hot: DataFrame) -> DataFrame:
    """Left join of ``big`` with ``small`` (one row per ``key``) that survives hot keys.

    ``hot`` holds the keys of ``small`` that own so many rows of ``big`` that they are few by
    counting (callers keep those above a fixed share of all rows, so at most 1/share of them); these
    are broadcast, every other key goes through an ordinary shuffled join.
    """
    head = F.broadcast(small.join(F.broadcast(hot), key, "left_semi").withColumn("__hot", F.lit(True)))
    tagged = big.join(F.broadcast(hot.withColumn("__is_hot", F.lit(True))), key, "left")
    few = tagged.filter("__is_hot").drop("__is_hot").join(head, key, "left").drop("__hot")
    rest = tagged.filter("__is_hot is null").drop("__is_hot").join(small, key, "left")
    return few.unionByName(rest)


__all__ = ["ASCII_SPACE", "fresh", "held_out", "lookup", "materialize", "partitions", "prepared", "table"]
