"""Corpus pipeline: toxicity, exact dedup, near dedup, decontamination, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs.  All but the last return the columns
of documents; the last adds each document's rate and number of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudspark.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from fraudspark.llm.common import materialize, prepared, table

#: Contract of the SimHash operator: words of a shingle, greatest bit distance.
SHINGLE_WORDS, MAX_BITS = 4, 4
#: Target shares of the tokens; documents labelled toxic have gone before, so there is no such domain.
TARGETS = {"high": 0.75, "low": 0.25}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects (score 0.5 or more) go."""
    prepared(spark)
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the most code points, then the smallest id, stays."""
    prepared(spark)
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    prepared(spark)
    return simhash.dedup(docs, SHINGLE_WORDS, MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepared(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its rate towards the target domain shares, and its number of copies."""
    prepared(spark)
    labels = table(spark, sf_dir, "labels").filter("toxic is null or toxic = 0")
    return mixing.mix(docs, labels, TARGETS)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_targets),
]

#: Learnt classifiers and iterated links are not SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
