"""Categorical encoders with fitted state kept as small tidy tables.

State layout ``(col, category, n, s, value)``: one row per (column, category),
categories compared as strings (the same cast at fit and apply).  Fitting is
ONE aggregation over the unpivoted columns, so a hot category is combined
map-side before the shuffle.  Applying looks every column up: a state whose bytes
(measured at fit time) are below the broadcast limit is broadcast to the rows;
a larger one meets narrow (row, column, category) entries of all columns in
one skew-aware join, and the rows themselves are shuffled once, to get their
values back, however many columns there are.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize as _write_back
from .joins import can_broadcast


def materialize(df: DataFrame) -> DataFrame:
    """Write a small fitted state to the shared checkpoint folder and cut its lineage."""
    return _write_back(df, "state")

# Columns encoded by label mean and by frequency.
TARGET_ENCODE_COLS = ["P_emaildomain", "R_emaildomain", "DeviceInfo", "id_30", "id_31"]
FREQ_ENCODE_COLS = ["card1", "card2", "card3", "id_20"]


# Join keys that rows without a category are spread over.
NULL_KEYS = 65_536


def _cat(df: DataFrame, c: str) -> Column:
    """The category as text; a whole number reads the same from an integer and a
    floating column (9500 and 9500.0), so a state fits data of either type."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        whole = (col == F.floor(col)) & (F.abs(col) < F.lit(2.0 ** 53))
        return F.when(whole, col.cast("bigint").cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def _unpivot(df: DataFrame, cols: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """Long form (col, category, *extra) with null categories dropped."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), _cat(df, c).alias("category")) for c in cols])
    return (df.select(*extra, F.explode(pairs).alias("_p"))
            .select(F.col("_p.col").alias("col"), F.col("_p.category").alias("category"), *extra)
            .where(F.col("category").isNotNull()))


def _apply_state(df: DataFrame, state: DataFrame, cols: Sequence[str], default: float,
                 state_rows: int | None, value_col: str = "value",
                 key_cols: Sequence[str] = (), state_bytes: int | None = None) -> DataFrame:
    """Replace each column by its state value; unseen / null -> default; absent -> default."""
    bc = can_broadcast(state_rows, known_bytes=state_bytes)
    there = [c for c in cols if c in df.columns]
    if not bc and len(there) > 1 and not df.isStreaming:
        return _apply_large_state(df, state, cols, default, value_col, key_cols)
    out = df
    ids = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name not in cols] or list(cols)
    for c in cols:
        if c not in df.columns:
            out = out.withColumn(c, F.lit(float(default)))
            continue
        s = state.where(F.col("col") == c).select(
            F.col("category").alias("_cat"), *[F.col(k).alias(f"_k_{k}") for k in key_cols],
            F.col(value_col).alias("_val"))
        s = F.broadcast(s) if bc else s
        own = _cat(out, c)
        if not bc:      # null categories match nothing: spread them instead of one join key for all
            spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[F.col(x) for x in ids]), F.lit(NULL_KEYS)))
            own = F.coalesce(own, spread)
        cond = own == F.col("_cat")
        for k in key_cols:
            cond = cond & (F.col(k) == F.col(f"_k_{k}"))
        out = (out.join(s, cond, "left")
               .withColumn(c, F.coalesce(F.col("_val"), F.lit(float(default))))
               .drop("_cat", "_val", *[f"_k_{k}" for k in key_cols]))
    return out


def _apply_large_state(df: DataFrame, state: DataFrame, cols: Sequence[str], default: float, value_col: str,
                       key_cols: Sequence[str]) -> DataFrame:
    """All columns at once: the rows are written with a number, their (number, column, category) entries meet
    the state in one join, and each row gets its values back by its number."""
    there = [c for c in cols if c in df.columns]
    rows = _write_back(df.withColumn("_rid", F.monotonically_increasing_id()), "numbered")
    long = _unpivot(rows, there, ["_rid", *key_cols])
    keys = ["col", "category", *key_cols]
    met = long.join(state.select(*keys, F.col(value_col).alias("_val")), keys)
    values = met.groupBy("_rid").agg(*[F.max(F.when(F.col("col") == c, F.col("_val"))).alias(f"_v{i}") for i, c in enumerate(there)])
    out = rows.join(values, "_rid", "left")
    found = {c: F.col(f"_v{there.index(c)}") if c in there else F.lit(None).cast("double") for c in cols}
    names = [*df.columns, *[c for c in cols if c not in df.columns]]
    return out.select(*[F.coalesce(found[c], F.lit(float(default))).alias(c) if c in found else F.col(c) for c in names])


@dataclass
class TargetEncoding:
    """Fitted label-mean encoding: smoothed per-category means + global mean."""
    cols: list[str]
    global_mean: float
    smoothing: float
    state: DataFrame          # col, category, n, s, value
    state_rows: int
    state_bytes: int | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return _apply_state(df, self.state, self.cols, self.global_mean, self.state_rows, state_bytes=self.state_bytes)

    def save(self, path: str) -> None:
        self.state.write.mode("overwrite").parquet(f"{path}/state")
        meta = dict(cols=self.cols, global_mean=self.global_mean, smoothing=self.smoothing,
                    state_rows=self.state_rows, state_bytes=self.state_bytes)
        _write_meta(self.state.sparkSession, meta, f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TargetEncoding":
        meta = _read_meta(spark, f"{path}/meta")
        return cls(meta["cols"], meta["global_mean"], meta["smoothing"],
                   spark.read.parquet(f"{path}/state"), meta["state_rows"], meta.get("state_bytes"))


def _write_meta(spark: SparkSession, meta: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").parquet(path)


def _read_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()["meta"])


def category_label_stats(df: DataFrame, cols: Sequence[str], label: str,
                         fold: str | None = None) -> DataFrame:
    """(col, category[, fold], n, s): label count and sum per category (one shuffle)."""
    extra = [label] + ([fold] if fold else [])
    keys = ["col", "category"] + ([fold] if fold else [])
    return (_unpivot(df, cols, extra).groupBy(*keys)
            .agg(F.count(label).alias("n"), F.sum(F.col(label).cast("double")).alias("s")))


_ALL = "__all_rows__"


def _state_size(state: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a fitted state."""
    r = state.agg(F.count(F.lit(1)), F.sum(F.octet_length("col") + F.octet_length("category") + 24)).first()
    return int(r[0]), int(r[1] or 0)


def fit_target_encoding(df: DataFrame, cols: Sequence[str], label: str = "isFraud",
                        smoothing: float = 1.0) -> TargetEncoding:
    """Smoothed mean: (n * mean + smoothing * g) / (n + smoothing), g = label mean.

    One pass over the data: the global label mean rides along in the same
    aggregation as one extra pseudo-category; the smoothing is then applied to
    the small per-category table.
    """
    if label not in df.columns:
        raise ValueError("target encoding needs the label column")
    cols = [c for c in cols if c in df.columns]
    pairs = F.array(F.struct(F.lit(_ALL).alias("col"), F.lit(_ALL).alias("category")),
                    *[F.struct(F.lit(c).alias("col"), _cat(df, c).alias("category")) for c in cols])
    stats = materialize(
        df.select(label, F.explode(pairs).alias("_p"))
        .where(F.col("_p.category").isNotNull())
        .groupBy(F.col("_p.col").alias("col"), F.col("_p.category").alias("category"))
        .agg(F.count(label).alias("n"), F.sum(F.col(label).cast("double")).alias("s")))
    tot = stats.where(F.col("col") == _ALL).first()
    g = float(tot["s"] / tot["n"]) if tot is not None and tot["n"] else 0.0
    mean = F.col("s") / F.col("n")
    state = materialize(stats.where(F.col("col") != _ALL).select(
        "col", "category", "n", "s",
        ((F.col("n") * mean + F.lit(smoothing * g)) / (F.col("n") + F.lit(smoothing))).alias("value")))
    return TargetEncoding(list(cols), g, smoothing, state, *_state_size(state))


def target_encode_out_of_fold(df: DataFrame, enc: TargetEncoding, label: str, fold: str) -> DataFrame:
    """Training-row encoding: unsmoothed label mean of the category over the OTHER
    folds; global mean when the category is null or absent from the other folds.

    One aggregation per (col, category, fold) gives fold sums; subtracting them
    from the category totals yields every "other folds" mean at once, instead
    of k separate group-bys.
    """
    per_fold = category_label_stats(df, enc.cols, label, fold)
    tot = per_fold.groupBy("col", "category").agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all"))
    n_other, s_other = F.col("n_all") - F.col("n"), F.col("s_all") - F.col("s")
    other = (per_fold.join(tot, ["col", "category"])
             .select("col", "category", fold, F.when(n_other > 0, s_other / n_other).alias("value")))
    other = materialize(other)
    rows, size = _state_size(other)
    return _apply_state(df, other, enc.cols, enc.global_mean, rows, key_cols=[fold], state_bytes=size)


@dataclass
class FrequencyEncoding:
    cols: list[str]
    normalize: bool
    state: DataFrame          # col, category, n, value
    state_rows: int
    state_bytes: int | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return _apply_state(df, self.state, self.cols, 0.0, self.state_rows, state_bytes=self.state_bytes)

    def save(self, path: str) -> None:
        self.state.write.mode("overwrite").parquet(f"{path}/state")
        _write_meta(self.state.sparkSession,
                    dict(cols=self.cols, normalize=self.normalize, state_rows=self.state_rows, state_bytes=self.state_bytes), f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FrequencyEncoding":
        meta = _read_meta(spark, f"{path}/meta")
        return cls(meta["cols"], meta["normalize"], spark.read.parquet(f"{path}/state"), meta["state_rows"], meta.get("state_bytes"))


def fit_frequency_encoding(df: DataFrame, cols: Sequence[str], normalize: bool = True) -> FrequencyEncoding:
    """Share of non-null rows per category (``normalize``) or the raw count."""
    cols = [c for c in cols if c in df.columns]
    counts = _unpivot(df, cols, []).groupBy("col", "category").agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        totals = counts.groupBy("col").agg(F.sum("n").alias("_tot"))
        # one row per encoded column: bounded broadcast
        value = counts.join(F.broadcast(totals), "col").select(
            "col", "category", "n", (F.col("n") / F.col("_tot")).alias("value"))
    else:
        value = counts.select("col", "category", "n", F.col("n").cast("double").alias("value"))
    state = materialize(value)
    return FrequencyEncoding(list(cols), normalize, state, *_state_size(state))


__all__ = [
    "TARGET_ENCODE_COLS", "FREQ_ENCODE_COLS", "TargetEncoding", "FrequencyEncoding",
    "category_label_stats", "fit_target_encoding", "target_encode_out_of_fold", "fit_frequency_encoding",
]
