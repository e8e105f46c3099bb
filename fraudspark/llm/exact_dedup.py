"""Exact dedup by 128-bit content hash, native DataFrame functions only.

Texts are equal when they agree after ASCII white space is deleted.  The hash of the normalised text
groups the rows with map-side partial aggregation, so a group that holds a third of the table
travels as one row per task.  Bytes are compared inside groups: for every hash that has more than
one row the smallest and the largest normalised text are computed (again partially aggregated).  A
hash under which they differ is a collision, and its rows are then grouped by the text itself.

Defined results
    null text        counts as the empty text; empty texts are equal to each other
    null doc_id      sorts after every other id, so it stays only if its whole group has none
    ties             most code points of the original text, then smallest doc_id
    repeated rows    rows that repeat an id and text are members of the group; all carry ``kept``
                     true when theirs is the id that stays (``dedup`` then keeps one of them)
    empty table      empty result
    extra columns    ignored by ``groups``, kept by ``dedup`` whatever their names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, fresh, lookup, materialize

#: A group that owns more than this share of the rows is joined by broadcast; there are at most 1/share of them.
HOT_SHARE = 1 / 2000


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def _collided(docs: DataFrame, repeated: DataFrame, limit: float) -> DataFrame:
    """Hashes under which different normalised texts meet (none, unless the hash collides).

    Groups of more than ``limit`` rows are few; their rows are found by broadcast where they lie and
    reach the shuffle as one smallest and one largest text a task.  The texts of all other repeated
    hashes meet in a merge join, at every size: whether they fit a broadcast must not decide the plan.
    """
    large = repeated.filter(F.col("n") > limit).select("h")
    small = repeated.filter(F.col("n") <= limit).select("h")
    parts = [docs.join(F.broadcast(large), "h", "left_semi"),
             docs.join(F.broadcast(large), "h", "left_anti").join(small.hint("merge"), "h", "left_semi")]
    ends = [p.groupBy("h").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")) for p in parts]
    return ends[0].unionByName(ends[1]).filter("lo <> hi").select("h", F.lit(True).alias("collided"))


def groups(documents: DataFrame, hash_fn=None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    ``hash_fn`` maps the normalised text to the grouping hash (md5 by default; tests pass a weak one
    to force collisions).
    """
    hash_fn = hash_fn or (lambda norm: F.md5(norm.cast("binary")))
    docs = documents.select("doc_id", "text").select("doc_id", normalised(F.col("text")).alias("norm"),
                                                     F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    docs = docs.select("doc_id", "norm", "chars", hash_fn(F.col("norm")).alias("h"))
    narrow = materialize(docs.select("doc_id", "chars", "h", F.sha2(F.col("norm").cast("binary"), 256).alias("sha")), "exact")
    per_hash = narrow.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(per_hash.filter("n > 1"), "exact_repeated")
    limit = max(1.0, narrow.count() * HOT_SHARE)
    collided = materialize(_collided(docs, repeated, limit), "exact_collided")
    # the text of a row whose hash collides is part of its key; collisions apart, the hash is the key
    if collided.isEmpty():
        keyed = narrow.withColumn("k", F.col("h"))
    else:
        keyed = (docs.join(collided, "h", "left")
                 .select("doc_id", "chars", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"),
                         F.when(F.col("collided"), F.concat_ws(":", "h", "norm")).otherwise(F.col("h")).alias("k")))
    order = F.struct("chars", F.col("doc_id").isNotNull().alias("has_id"), (-F.col("doc_id")).alias("neg_id"))
    best = (keyed.groupBy("k").agg(F.count(F.lit(1)).alias("group_size"), F.max(order).alias("best"))
            .select("k", "group_size", (-F.col("best.neg_id")).alias("keep_id")))
    hot = best.filter(F.col("group_size") > limit).select("k")
    return (lookup(keyed, best, "k", hot)
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def dedup(documents: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat an id and text, one."""
    sha, keep = fresh(documents, "sha"), fresh(documents, "keep")
    # the groups join back by id and content, so a document id used for two texts stays apart
    stay = (groups(documents).filter("kept")
            .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct().withColumn(keep, F.lit(True)))
    tagged = documents.withColumn(sha, F.sha2(normalised(documents["text"]).cast("binary"), 256))
    kept = tagged.join(stay, tagged["doc_id"].eqNullSafe(stay["__id"]) & (tagged[sha] == stay["__sha"]), "left_semi")
    return kept.dropDuplicates(["doc_id", sha]).select(*[kept[c] for c in documents.columns])
