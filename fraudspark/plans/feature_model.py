"""Feature pipeline: fit on training rows, apply anywhere.

Fixed step order (null flags before ordinal codes, frequency after target
encoding): time -> amount / per-card -> null flags -> ordinal codes ->
target encoding -> frequency encoding -> drop time column -> numeric
coercion -> V-column pruning.  The fitted state (encoder tables, pruned
list, feature order, card profile) is stored as Parquet so batch scoring,
stream scoring and training read the same numbers.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import encoders as enc
from ..operators import features as fe
from ..operators import prune
from ..operators.split import add_folds


def base_features(df: DataFrame, dt: str, fold_case: bool, profile: DataFrame | None = None,
                  profile_rows: int | None = None) -> DataFrame:
    x = df
    if dt in x.columns:
        x = fe.add_time_features(x, dt)
    if "TransactionAmt" in x.columns and "card1" in x.columns:
        x = fe.add_card_features(x, profile=profile, profile_rows=profile_rows)
    x = fe.add_null_indicators(x)
    return fe.encode_ordinals(x, fold_case=fold_case)


@dataclass
class FeatureModel:
    key: str
    label: str
    dt: str
    fold_case: bool
    target: enc.TargetEncoding | None
    freq: enc.FrequencyEncoding
    dropped_v: list[str]
    feature_columns: list[str] = field(default_factory=list)
    profile: DataFrame | None = None
    profile_rows: int | None = None

    def _finish(self, x: DataFrame) -> DataFrame:
        x = x.drop(self.dt)
        x = fe.coerce_all_numeric(x, keep=[self.key])
        return x.drop(*self.dropped_v)

    def transform(self, df: DataFrame, frozen_profile: bool = False) -> DataFrame:
        """Features of new rows with the fitted encoders.

        By default the per-card statistics are recomputed over ``df`` (batch
        behaviour); ``frozen_profile=True`` uses the card profile fitted on
        the training rows, which is what a stream or a single row needs.
        """
        prof = self.profile if frozen_profile else None
        x = base_features(df, self.dt, self.fold_case, prof, self.profile_rows if frozen_profile else None)
        if self.target is not None:
            x = self.target.transform(x)
        x = self.freq.transform(x)
        return self._finish(x)

    def save(self, path: str) -> None:
        spark = self.freq.state.sparkSession
        if self.target is not None:
            self.target.save(f"{path}/target")
        self.freq.save(f"{path}/freq")
        if self.profile is not None:
            self.profile.write.mode("overwrite").parquet(f"{path}/profile")
        meta = dict(key=self.key, label=self.label, dt=self.dt, fold_case=self.fold_case,
                    dropped_v=self.dropped_v, feature_columns=self.feature_columns,
                    profile_rows=self.profile_rows, has_target=self.target is not None)
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureModel":
        try:
            meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        except Exception as e:  # missing path: say what to run
            raise FileNotFoundError(f"No fitted features at {path}; fit the feature pipeline first") from e
        target = enc.TargetEncoding.load(spark, f"{path}/target") if meta["has_target"] else None
        prof = spark.read.parquet(f"{path}/profile") if meta.get("profile_rows") is not None else None
        return cls(meta["key"], meta["label"], meta["dt"], meta["fold_case"], target,
                   enc.FrequencyEncoding.load(spark, f"{path}/freq"), meta["dropped_v"],
                   meta["feature_columns"], prof, meta.get("profile_rows"))


@dataclass
class FeaturePipeline:
    key: str = "TransactionID"
    label: str = "isFraud"
    dt: str = "TransactionDT"
    n_splits: int = 5
    smoothing: float = 1.0
    normalize_freq: bool = True
    prune_threshold: float = prune.PRUNE_THRESHOLD
    min_v_cols: int = prune.MIN_V_COLS
    fold_case: bool = True
    target_cols: list[str] = field(default_factory=lambda: list(enc.TARGET_ENCODE_COLS))
    freq_cols: list[str] = field(default_factory=lambda: list(enc.FREQ_ENCODE_COLS))

    def fit_transform(self, df: DataFrame, fold: str | None = None) -> tuple[FeatureModel, DataFrame]:
        """Fit on training rows; return the model and the training features
        (out-of-fold target encoding, so no row sees its own label).

        ``fold`` names the column of the rows' contiguous folds when the caller
        has it already (a time split does), which saves one indexing pass.
        """
        if self.label not in df.columns:
            raise ValueError("fitting the feature pipeline needs the label column")
        x = base_features(df, self.dt, self.fold_case)
        if fold is not None:
            x = x.withColumnRenamed(fold, "_fold")
        else:
            x = add_folds(x, self.n_splits, self.dt, self.key, fold="_fold")
        # kept once: the encoders are fitted on it, and the features read it with small states attached
        base = x = x.persist(StorageLevel.MEMORY_AND_DISK)
        te = enc.fit_target_encoding(x, self.target_cols, self.label, self.smoothing)
        x = enc.target_encode_out_of_fold(x, te, self.label, "_fold").drop("_fold")
        fq = enc.fit_frequency_encoding(x, self.freq_cols, self.normalize_freq)
        x = fq.transform(x)
        model = FeatureModel(self.key, self.label, self.dt, self.fold_case, te, fq, [])
        x = model._finish(x)
        vc = prune.v_columns(x)
        if len(vc) > self.min_v_cols:
            # no encoder changes the V columns: they are read from the base rows
            plain = fe.coerce_all_numeric(base.select(*vc), keep=[])
            model.dropped_v = prune.prune_list(plain, self.prune_threshold, self.min_v_cols)
            x = x.drop(*model.dropped_v)
        model.feature_columns = [c for c in x.columns if c not in (self.key, self.label)]
        prof = enc.materialize(fe.card_profile(df)) \
            if "card1" in df.columns and "TransactionAmt" in df.columns else None
        model.profile, model.profile_rows = prof, (prof.count() if prof is not None else None)
        return model, x
