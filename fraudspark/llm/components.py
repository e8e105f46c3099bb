"""Connected components of an edge table, by alternating star contraction.

Every round relinks each vertex to the smallest vertex it knows (large star, then small star) with
partially aggregated minima and shuffled joins, so a vertex with a third of all edges is split by
map-side aggregation and by the skew-join rule.  Each round is written to the shared folder, which
cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges(a, b)`` that is not its own root.

    The root is the smallest vertex of its component.  An empty table gives an empty table.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = _signature(edges)
        if tuple(now) == tuple(before):
            break
        before = now
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
