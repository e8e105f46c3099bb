"""Positional operators without a single-task sort.

``with_row_index`` gives every row its 1-based position in a total order in
two distributed passes: range-partition + sort within partitions, tag each
row with (partition, local position) via ``monotonically_increasing_id``,
count rows per partition (one tiny row per partition), and add the prefix
of earlier partitions through a broadcast of that bounded table.  The order
columns must include a unique tie-break so positions are deterministic.

``prefix_sums`` uses the same layout with per-partition running sums
computed by vectorised numpy in ``mapInPandas`` (no extra shuffle).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scalar import portable_hash
from ..session import materialize
from .joins import null_safe_join

#: Wanted quantiles (groups x quantiles, a few numbers each) that are broadcast.
MAX_WANTED = 100_000
_LOCAL_BITS = 33
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def _partitions(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _as_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "rn",
                   partitions: int | None = None) -> tuple[DataFrame, int]:
    """Return ``(df + name, total_rows)``; ``name`` is the 1-based position.

    The range-partitioned, tagged frame is written once as Parquet under the
    shared ``spark.checkpoint.dir`` before it is used twice: range bounds are
    sampled per execution, so the counting pass and the indexing pass must
    read the same materialised rows.  The written table also makes positions
    survive executor loss and keeps downstream plans shallow.
    """
    cols = _as_cols(order)
    tagged = materialize(df.repartitionByRange(_partitions(df, partitions), *cols)
                         .sortWithinPartitions(*cols)
                         .withColumn("_mid", F.monotonically_increasing_id()), "row_index")
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    # One row per partition: collecting and broadcasting the offsets is bounded
    # by the partition count, never by the data.
    counts = sorted((r["_pid"], r["_n"]) for r in
                    tagged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).collect())
    rows, acc = [], 0
    for p, c in counts:
        rows.append((int(p), int(acc)))
        acc += c
    offsets = df.sparkSession.createDataFrame(rows or [(0, 0)], "_pid bigint, _off bigint")
    total = acc
    out = (tagged.join(F.broadcast(offsets), pid == F.col("_pid"))
           .withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)) + 1)
           .drop("_mid", "_pid", "_off"))
    return out, int(total)


def prefix_sums(df: DataFrame, order: Sequence[str], values: Sequence[str], ascending: bool = True,
                suffix: str = "_cum", partitions: int | None = None,
                partition_by: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``values`` along a total order, restarting for
    every value of ``partition_by`` (like ``sum() OVER (PARTITION BY ... ORDER BY ...)``).

    ``partition_by + order`` must be unique per row.  Range partitioning on it
    splits even a key that holds a third of all rows over many tasks: each
    task runs vectorised per-key cumulative sums, and the sums a key carries
    in from earlier tasks are added from a per-task summary (one row per
    task, collected and broadcast).  Sums restart per key, so their magnitude
    is bounded by the key's own total.
    """
    keys = list(partition_by)
    kcols = keys or ["_k0"]
    base = df if keys else df.withColumn("_k0", F.lit(0))
    ocols = [F.col(k) for k in kcols] + [F.col(c) if ascending else F.col(c).desc() for c in order]
    ranged = (base.repartitionByRange(_partitions(df, partitions), *ocols).sortWithinPartitions(*ocols)
              .withColumn("_pid", F.spark_partition_id()))
    cum_names = [v + suffix for v in values]
    schema = T.StructType(ranged.schema.fields + [T.StructField(c, T.DoubleType()) for c in cum_names]
                          + [T.StructField("_lp", T.LongType()), T.StructField("_first", T.BooleanType())])

    def key_of(pdf, i):
        return tuple(None if pd.isna(v) else v for v in pdf[kcols].iloc[i].tolist())

    def local_cumsum(batches):
        carry, last_key, first_key, pos, only_first = None, None, None, 0, True
        for pdf in batches:
            if pdf.empty:
                continue
            n = len(pdf)
            run = pdf.groupby(kcols, sort=False, dropna=False).ngroup().to_numpy()
            vals = pdf[list(values)].astype("float64").fillna(0.0)
            cums = vals.groupby(run).cumsum().to_numpy()
            head = key_of(pdf, 0)
            if first_key is None:
                first_key = head
            in_first_run = run == run[0]
            if carry is not None and head == last_key:
                cums[in_first_run] += carry
            first_flag = np.zeros(n, dtype=bool)
            if only_first and head == first_key:
                first_flag[in_first_run] = True
            if run[-1] != run[0]:
                only_first = False
            for j, c in enumerate(cum_names):
                pdf[c] = cums[:, j]
            pdf["_lp"] = np.arange(pos, pos + n, dtype="int64")
            pdf["_first"] = first_flag
            pos += n
            last_key, carry = key_of(pdf, n - 1), cums[-1].copy()
            yield pdf

    local = materialize(ranged.mapInPandas(local_cumsum, schema), "prefix_sums")
    # one summary row per task: first key, last key and the sums of the last key's run
    summary = local.groupBy("_pid").agg(
        F.min_by(F.struct(*kcols), "_lp").alias("fk"),
        F.max_by(F.struct(*kcols, *cum_names), "_lp").alias("lk")).collect()
    summary.sort(key=lambda r: r["_pid"])
    nk = len(kcols)
    rows, carry_key, carry = [], None, np.zeros(len(values))
    for r in summary:                          # one forward pass over one row per task
        fk, lk = tuple(r["fk"]), tuple(r["lk"])
        off = carry if carry_key == fk else np.zeros(len(values))
        rows.append((int(r["_pid"]), *map(float, off)))
        own = np.asarray(lk[nk:], dtype="float64")
        carry_key, carry = lk[:nk], (off + own if fk == lk[:nk] else own)
    offs = df.sparkSession.createDataFrame(
        rows or [(0, *([0.0] * len(values)))],
        T.StructType([T.StructField("_pid", T.IntegerType())]
                     + [T.StructField(f"_o_{v}", T.DoubleType()) for v in values]))
    res = local.join(F.broadcast(offs), "_pid", "left")
    return res.select(*df.columns, *[
        (F.col(c) + F.when(F.col("_first"), F.coalesce(F.col(f"_o_{v}"), F.lit(0.0))).otherwise(F.lit(0.0)))
        .alias(c) for v, c in zip(values, cum_names)])


def cut_keys(df: DataFrame, order: Sequence[str],
             positions: Callable[[int], Sequence[int]]) -> tuple[list[Row | None], int]:
    """The order keys at chosen positions, and the number of rows.

    ``positions(n)`` names 1-based positions; a position outside the table has
    the key None.  Only the order columns are indexed, and one row per position
    comes to the driver; wide rows are then labelled by ``segment`` without a
    shuffle.
    """
    idx, n = with_row_index(df.select(*order), order, name="_cut_rn")
    at = [int(p) for p in positions(n)]
    found = {r["_cut_rn"]: r for r in idx.where(F.col("_cut_rn").isin(sorted(set(at)))).collect()} if at else {}
    return [found.get(p) for p in at], n


def segment(df: DataFrame, order: Sequence[str], cuts: Sequence[Row | None]) -> Column:
    """How many of the ascending cut keys lie before the row: 0 up to and with
    the first cut, 1 up to the second, and so on (a cut of None lies before
    every row).  Null order values come first, as in a sort; rows with equal
    order keys fall into one segment."""
    here = F.struct(*[F.col(c) for c in order])
    out = F.lit(0)
    for cut in cuts:
        if cut is None:
            out = out + F.lit(1)
        else:
            there = F.struct(*[F.lit(cut[c]).cast(df.schema[c].dataType).alias(c) for c in order])
            out = out + (here > there).cast("int")
    return out


def fold_ends(n: int, k: int) -> list[int]:
    """Last 1-based positions of all but the last of ``k`` contiguous folds of ``n`` rows."""
    base, rem = divmod(n, k)
    return [i * base + min(i, rem) for i in range(1, k)]


def batch_index(rn: Column, size: int) -> Column:
    """Fixed-size batch number of 1-based position ``rn``."""
    return F.floor((rn - 1) / size).cast("bigint")


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), repeatable for a seed."""
    return df.orderBy(portable_hash(F.col(key), seed), F.col(key)).limit(n)


def seeded_fraction(df: DataFrame, fraction: float, seed: int, key: str,
                    flag: str = "_selected") -> DataFrame:
    """Mark exactly ``floor(n * fraction)`` rows, chosen by a portable hash of the key.

    The rows up to the key at position ``floor(n*fraction)`` of the order
    ``(hash(key, seed), key)`` are flagged; only that pair is indexed.  All rows
    are returned; rows of a repeated key are flagged together.
    """
    order = ["_sample_h", key]
    hashed = df.withColumn("_sample_h", portable_hash(F.col(key), seed))
    cuts, _ = cut_keys(hashed, order, lambda n: [int(n * fraction)])
    return hashed.withColumn(flag, segment(hashed, order, cuts) == 0).drop("_sample_h")


def exact_quantiles(df: DataFrame, value: str, quantiles: Sequence[float],
                    group_cols: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, ``(group..., q, quantile)``.

    Rows are first counted per (group, value) with partial aggregation, so a
    value held by most rows is one row afterwards; ``weight`` names a column of
    counts when the table is counted already.  Running counts along the values
    (``prefix_sums``, split over many tasks even for a hot group) give the two
    values around ``(n - 1) * q``.  Group sizes stay in Spark, null is a group
    like any other; a group without values gives no row.
    """
    g = list(group_cols)
    one = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*g, F.col(value).cast("double").alias("_v")).agg(one.cast("double").alias("_c"))
              .where(F.col("_c") > 0))
    cum = prefix_sums(counts, ["_v"], ["_c"], partition_by=g)
    total = materialize(cum.groupBy(*g).agg(F.max("_c_cum").alias("_n")), "quantile_groups")
    small = total.count() * len(quantiles) <= MAX_WANTED
    h = (F.col("_n") - 1) * F.col("q")
    want = (total.select(*g, "_n", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("q"))
            .select(*g, "q", F.floor(h).alias("_lo"), F.least(F.floor(h) + 1, F.col("_n") - 1).alias("_hi"),
                    (h - F.floor(h)).alias("_frac")))
    first, end = F.col("_c_cum") - F.col("_c"), F.col("_c_cum")
    at_lo = (F.col("_lo") >= first) & (F.col("_lo") < end)
    at_hi = (F.col("_hi") >= first) & (F.col("_hi") < end)
    # few wanted positions go to the values, so that a group of most rows is no join key
    picked = null_safe_join(cum, F.broadcast(want) if small else want, g).where(at_lo | at_hi)
    agg = picked.groupBy(*g, "q", "_frac").agg(F.max(F.when(at_lo, F.col("_v"))).alias("_a"),
                                               F.max(F.when(at_hi, F.col("_v"))).alias("_b"))
    # no interpolation between equal values: infinities stay what they are
    return agg.select(*g, "q", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(
        F.col("_a") + F.col("_frac") * (F.col("_b") - F.col("_a"))).alias("quantile"))
