"""Class weights, exact k-nearest minority neighbours and SMOTE-style oversampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .neighbours import CHUNK_BYTES, node_neighbours
from .ordering import with_row_index

# Fixed value: the fixed positive-class weight of the second booster preset.
FIXED_POSITIVE_WEIGHT = 30.0


def class_weight_table(df: DataFrame, label: str = "isFraud",
                       positive_weight: float = FIXED_POSITIVE_WEIGHT) -> DataFrame:
    """Per class: n, balanced weight n_total / (2 * n_class), fixed weight."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # the class table has one row per label value: an unpartitioned window over it is bounded
    total = F.sum("n").over(Window.partitionBy())
    return c.select(label, "n", (total / (2.0 * F.col("n"))).alias("balanced_weight"),
                    F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
                    .alias("fixed_weight"))


def add_class_weight(df: DataFrame, label: str = "isFraud", mode: str = "balanced",
                     weight_col: str = "weight", positive_weight: float = FIXED_POSITIVE_WEIGHT) -> DataFrame:
    """Attach a per-row weight column (the class table has one row per label value)."""
    t = class_weight_table(df, label, positive_weight)
    col = "balanced_weight" if mode == "balanced" else "fixed_weight"
    return df.join(F.broadcast(t.select(label, F.col(col).alias(weight_col))), label, "left")


# ---------------------------------------------------------------- exact k-NN
# Fixed value: neighbours per minority row.
K_NEIGHBOURS = 5


def knn(points: DataFrame, key: str, vec: str, k: int = K_NEIGHBOURS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Exact k nearest neighbours (Euclidean) of every point among the others:
    ``(key, neighbour, rank, distance)``, ties broken by neighbour key; fewer
    than k where there are not that many other points, none for a null vector.

    Equal vectors are one node holding its k + 1 smallest keys (row_number with
    a limit, which Spark applies before the shuffle as well), so a hot vector
    is not paired with itself.  The k nearest other nodes and the node's own
    keys hold the k nearest points of each of its members: a node further off
    has k better keys before it.  Members read the node's list by a join on the
    vector.
    """
    x = F.col(vec).cast("array<double>")
    base = materialize(points.where(F.col(vec).isNotNull()).select(F.col(key).alias("_id"), x.alias("_x")), "knn_points")
    copy = Window.partitionBy("_x").orderBy("_id")
    # at most k + 1 keys of a node are collected
    nodes = materialize(base.withColumn("_c", F.row_number().over(copy)).where(F.col("_c") <= k + 1)
                        .groupBy("_x").agg(F.min("_id").alias("_node"), F.sort_array(F.collect_list("_id")).alias("_ids")),
                        "knn_nodes")
    found = node_neighbours(nodes.select("_node", "_x"), k, chunk_bytes)
    members = nodes.select("_node", "_ids")
    near = found.join(members.select(F.col("_node").alias("_other"), "_ids"), "_other").select("_node", "_dd", "_ids") \
        .unionByName(members.select("_node", F.lit(0.0).alias("_dd"), "_ids"))
    # at most k + 1 nodes of k + 1 keys each
    best = near.groupBy("_node").agg(F.slice(F.sort_array(F.flatten(F.collect_list(
        F.transform("_ids", lambda i: F.struct(F.col("_dd"), i.alias("_n")))))), 1, k + 1).alias("_best"))
    by_vector = nodes.select("_node", "_x").join(best, "_node").select("_x", "_best")
    lists = base.join(by_vector, "_x").select(
        "_id", F.slice(F.filter("_best", lambda e: e["_n"] != F.col("_id")), 1, k).alias("_best"))
    return lists.select("_id", F.posexplode("_best").alias("_r", "_e")).select(
        F.col("_id").alias(key), F.col("_e._n").alias("neighbour"), (F.col("_r") + 1).cast("int").alias("rank"),
        F.col("_e._dd").alias("distance"))


def smote(train: DataFrame, feature_columns: Sequence[str], label: str = "isFraud", key: str = "TransactionID",
          k: int = K_NEIGHBOURS, seed: int = 42, marker: str | None = None) -> DataFrame:
    """Add synthetic minority rows until both classes have the same count.

    Each synthetic row j picks (base row, neighbour rank) and a step in [0, 1)
    from two independent 64-bit hashes of j, and lies on the segment base -> neighbour:
    ``x + step * (x_nn - x)``.  Synthetic keys are negative; ``marker`` adds a
    boolean column that is true for synthetic rows.  A table with one class, or with no more than ``k`` minority rows, is refused.
    """
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        raise ValueError("oversampling needs two classes")
    minority = min(counts, key=lambda c: (counts[c], c))
    n_min, n_maj = counts[minority], max(counts.values())
    n_new = n_maj - n_min
    marked = (lambda rows, made: rows.withColumn(marker, F.lit(made))) if marker else (lambda rows, made: rows)
    if n_new == 0:
        return marked(train, False)
    if n_min <= k:
        raise ValueError(f"oversampling with {k} neighbours needs more than {k} minority rows, found {n_min}")
    cols = list(feature_columns)
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    mino = train.where(F.col(label) == minority).select(F.col(key), vec.alias("_x"))
    ranked, _ = with_row_index(mino, [key], name="_r")
    nn = knn(ranked.select(key, "_x"), key, "_x", k)
    kk = k
    pairs = (nn.join(ranked.select(F.col(key), F.col("_r"), F.col("_x")), key)
             .join(ranked.select(F.col(key).alias("neighbour"), F.col("_x").alias("_y")), "neighbour")
             .select((F.col("_r") - 1).alias("_base"), (F.col("rank") - 1).alias("_j"), "_x", "_y"))
    spark = train.sparkSession
    syn = spark.range(n_new).select(
        F.col("id").alias("_sid"),
        F.pmod(F.xxhash64("id", F.lit(seed), F.lit("pick")), F.lit(n_min * kk)).alias("_pick"),
        (F.pmod(F.xxhash64("id", F.lit(seed), F.lit("step")), F.lit(1 << 53)) / F.lit(float(1 << 53))).alias("_step"))
    syn = syn.select("_sid", "_step", F.floor(F.col("_pick") / kk).alias("_base"),
                     F.pmod(F.col("_pick"), F.lit(kk)).alias("_j"))
    made = syn.join(pairs, ["_base", "_j"]).select(
        (-(F.col("_sid") + 1)).alias(key),
        F.zip_with("_x", "_y", lambda a, b: a + F.col("_step") * (b - a)).alias("_v"))
    new_rows = made.select(F.col(key).cast(train.schema[key].dataType),
                           F.lit(minority).cast(train.schema[label].dataType).alias(label),
                           *[F.col("_v")[i].cast(train.schema[c].dataType).alias(c) for i, c in enumerate(cols)])
    new_rows = new_rows.select(*[F.col(c) if c in new_rows.columns else F.lit(None).cast(train.schema[c].dataType)
                                 .alias(c) for c in train.columns])
    return marked(train, False).unionByName(marked(new_rows, True))
