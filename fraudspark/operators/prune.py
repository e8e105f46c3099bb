"""Pairwise-complete Pearson correlation and correlation pruning.

One plan for any number of columns: per-partition Gram partials in
``mapInPandas`` (n, sums, sums of squares and cross products over rows where
both values exist, as masked matrix products on data centred by the column
means), summed by a group-by on the pair.  Shuffle volume is p^2 x 6 doubles
per task, independent of the row count.  A column that is constant on the
rows of a pair gives a null correlation.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values: |r| above which a later column is dropped, and the number of
# V columns needed before pruning runs.
PRUNE_THRESHOLD = 0.95
MIN_V_COLS = 50


def _pair_corr(x: Column, y: Column) -> Column:
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    xs, ys = F.when(both, x), F.when(both, y)
    denom = F.stddev_samp(xs) * F.stddev_samp(ys)
    return F.try_divide(F.covar_samp(xs, ys), F.when(denom > 0, denom))


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form (i, j, col_i, col_j, r) for i < j."""
    cols = list(cols)
    p = len(cols)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centre = np.array([0.0 if means[f"m{i}"] is None else float(means[f"m{i}"]) for i in range(p)])
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("i", T.IntegerType()), ("j", T.IntegerType()), ("n", T.DoubleType()), ("sx", T.DoubleType()),
        ("sy", T.DoubleType()), ("sxx", T.DoubleType()), ("syy", T.DoubleType()), ("sxy", T.DoubleType())]])
    iu, ju = np.triu_indices(p, k=1)

    def partials(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64") - centre
            m = (~np.isnan(x)).astype("float64")
            x0 = np.where(m > 0, x, 0.0)
            parts = (m.T @ m, x0.T @ m, m.T @ x0, (x0 * x0).T @ m, m.T @ (x0 * x0), x0.T @ x0)
            acc = parts if acc is None else tuple(a + b for a, b in zip(acc, parts))
        if acc is None:
            return
        n, sx, sy, sxx, syy, sxy = acc
        yield pd.DataFrame({"i": iu.astype("int32"), "j": ju.astype("int32"), "n": n[iu, ju],
                            "sx": sx[iu, ju], "sy": sy[iu, ju], "sxx": sxx[iu, ju], "syy": syy[iu, ju],
                            "sxy": sxy[iu, ju]})

    sums = (df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
            .mapInPandas(partials, schema)
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
    n = F.col("n")
    cxy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    cxx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    cyy = F.col("syy") - F.col("sy") * F.col("sy") / n
    denom = F.sqrt(cxx * cyy)
    names = F.array(*[F.lit(c) for c in cols])
    # tiny relative noise on an exactly zero variance must not pass as a correlation
    ok = (n > 1) & (cxx > 1e-12 * F.abs(F.col("sxx"))) & (cyy > 1e-12 * F.abs(F.col("syy")))
    return sums.select("i", "j", F.element_at(names, F.col("i") + 1).alias("col_i"),
                       F.element_at(names, F.col("j") + 1).alias("col_j"),
                       F.when(ok, F.try_divide(cxy, denom)).alias("r"))


def columns_to_prune(pairs: DataFrame, threshold: float = PRUNE_THRESHOLD) -> DataFrame:
    """Column j is dropped when ANY earlier column i < j has |r| > threshold
    (even one that is itself dropped).  Null r never triggers."""
    return (pairs.where(F.abs(F.col("r")) > threshold)
            .groupBy("j", "col_j").agg(F.min("i").alias("first_partner"))
            .select(F.col("col_j").alias("column_name"), "j", "first_partner"))


def v_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("V")]


def prune_list(df: DataFrame, threshold: float = PRUNE_THRESHOLD,
               min_cols: int = MIN_V_COLS) -> list[str]:
    """Names of V columns to drop (empty when there are ``min_cols`` or fewer)."""
    vc = v_columns(df)
    if len(vc) <= min_cols:
        return []
    rows = columns_to_prune(corr_pairs(df, vc), threshold).orderBy("j").collect()
    return [r["column_name"] for r in rows]


def label_correlation(df: DataFrame, label: str, cols: Sequence[str] | None = None) -> DataFrame:
    """|corr(c, label)| for every numeric column except the label, long form.

    The columns are unpivoted to (column_name, x, y) inside each task and
    grouped by column name: three small aggregates whatever the column count
    (partial aggregation before the shuffle, so the shuffle carries one row
    per column per task), instead of one very wide aggregate.
    """
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name != label] if cols is None else list(cols)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols])
    long = df.select(F.col(label).cast("double").alias("y"), F.explode(pairs).alias("p")) \
        .select("p.column_name", "p.x", "y")
    return long.groupBy("column_name").agg(F.abs(_pair_corr(F.col("x"), F.col("y"))).alias("abs_corr"))
