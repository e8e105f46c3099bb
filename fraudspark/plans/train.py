"""Training job and batch scoring job.

train_all: time split -> fit features on the training rows -> apply to
validation and test rows -> fill -999 -> (optional oversampling) -> fit each
candidate -> grouped evaluation per split -> run log -> champion by
validation PR-AUC -> save champion model, fitted features and manifest.

score_table: fitted features -> align to the manifest's feature order ->
fill -> probability -> decision records.  The same function serves batch
tables and streams (with the frozen card profile).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import features as fe
from ..operators import models as mdl
from ..operators import score as sc
from ..operators.resample import smote
from ..operators.split import time_split
from ..session import materialize, together
from ..sources import io
from .feature_model import FeatureModel, FeaturePipeline

#: Marks the rows that oversampling adds.
SYNTHETIC = "_synthetic"


@dataclass
class Prepared:
    features: FeatureModel
    train: DataFrame
    val: DataFrame
    test: DataFrame


def prepare(df: DataFrame, pipeline: FeaturePipeline | None = None) -> Prepared:
    """Split by time, fit features on the training rows, build filled feature tables."""
    pipeline = pipeline or FeaturePipeline()
    s, _ = time_split(df, pipeline.dt, pipeline.key, folds=pipeline.n_splits)
    raw = {k: s.where(F.col("split") == k).drop("fold", "split") for k in ("val", "test")}
    train = s.where(F.col("split") == "train").drop("split")
    fm, x_train = pipeline.fit_transform(train, fold="fold")
    keep = [pipeline.key, pipeline.label]

    def finish(x):
        return fe.fill_sentinel(fe.align_features(x, fm.feature_columns, keep), fm.feature_columns) \
            .persist(StorageLevel.MEMORY_AND_DISK)

    return Prepared(fm, finish(x_train), finish(fm.transform(raw["val"])), finish(fm.transform(raw["test"])))


def evaluate_models(models: dict[str, mdl.TrainedModel], prep: Prepared, label: str = "isFraud") -> DataFrame:
    """val / test metrics of every model (column ``model``), one grouped evaluation."""
    parts = [m.score(rows).select(F.lit(name).alias("model"), F.lit(split).alias("split"), "fraud_probability", label)
             for name, m in models.items() for split, rows in (("val", prep.val), ("test", prep.test))]
    return ev.eval_metrics(reduce(DataFrame.unionByName, parts), "fraud_probability", label, group_cols=["model", "split"])


def evaluate_model(model: mdl.TrainedModel, prep: Prepared, label: str = "isFraud") -> DataFrame:
    """val / test metrics of one model."""
    return evaluate_models({model.name: model}, prep, label).drop("model")


def train_all(spark: SparkSession, df: DataFrame, out_dir: str | None = None, n_trees: int = mdl.PRESET_TREES,
              models: Sequence[str] = mdl.MODEL_NAMES, oversample: bool = True,
              pipeline: FeaturePipeline | None = None, prep: Prepared | None = None,
              feature_columns: Sequence[str] | None = None, run_ids: dict[str, str] | None = None,
              thresholds: tuple[float, float] = (sc.THRESHOLD_APPROVE, sc.THRESHOLD_DECLINE)) -> dict:
    """``feature_columns`` restricts the features, ``run_ids`` names the runs, ``thresholds`` are stored
    with the champion."""
    prep = prep or prepare(df, pipeline)
    fm = prep.features
    train = prep.train
    if oversample:
        train = materialize(smote(train, fm.feature_columns, label=fm.label, key=fm.key, marker=SYNTHETIC), "oversampled")
    n_train = float(train.count())
    rows, fitted = [], {}
    fit = partial(mdl.fit_models, models, train, feature_columns or fm.feature_columns, fm.label, n_trees, fm.key,
                  synthetic=SYNTHETIC if oversample else None)
    found = together([fit, prep.val.count, prep.test.count])[0]     # the kept rows of the evaluation are made beside the fits
    metrics = evaluate_models(found, prep, fm.label).collect()   # two rows a model: val, test
    for name, m in found.items():        # the model column of the run table is the model type
        run_id = run_ids[name] if run_ids else mdl.new_run_id()
        for r in sorted((r for r in metrics if r["model"] == name), key=lambda r: r["split"]):
            for k in ("pr_auc", "roc_auc", "f1", "precision_at_80_rec", "threshold_at_80_rec"):
                rows.append((run_id, name, r["split"], k, float(r[k]) if r[k] is not None else None))
        rows.append((run_id, name, "train", "train_size", n_train))
        rows.append((run_id, name, "train", "smote_applied", float(oversample)))
        rows.append((run_id, name, "train", "n_features", float(len(m.feature_columns))))
        fitted[name] = (m, run_id)
    runs = mdl.runs_long(spark, rows)
    best = mdl.champion(runs.where(F.col("split") != "train"), list(models)).first()
    name = best["model"]
    model, run_id = fitted[name]
    manifest = dict(model_name=name, run_id=run_id, val_pr_auc=best["val_pr_auc"],
                    test_pr_auc=best["test_pr_auc"], feature_columns=model.feature_columns,
                    threshold_approve=thresholds[0], threshold_decline=thresholds[1])
    if out_dir:
        model.save(f"{out_dir}/champion/model")
        fm.save(f"{out_dir}/champion/features")
        io.write_manifest(spark, manifest, f"{out_dir}/champion/manifest")
        runs.write.mode("append").parquet(f"{out_dir}/runs")
    return dict(runs=runs, champion=name, model=model, manifest=manifest, prepared=prep,
                models={m: fit for m, (fit, _) in fitted.items()})


def load_champion(spark: SparkSession, out_dir: str) -> tuple[FeatureModel, mdl.TrainedModel, dict]:
    manifest = io.read_manifest(spark, f"{out_dir}/champion/manifest")
    fm = FeatureModel.load(spark, f"{out_dir}/champion/features")
    model = mdl.TrainedModel.load(manifest["model_name"], f"{out_dir}/champion/model", manifest["feature_columns"])
    return fm, model, manifest


def score_table(df: DataFrame, fm: FeatureModel, model: mdl.TrainedModel, manifest: dict,
                approve_below: float | None = None, decline_above: float | None = None,
                frozen_profile: bool = False, keep: Sequence[str] = ("TransactionID",)) -> DataFrame:
    """Decision records of ``df``; thresholds are the manifest's unless given."""
    if approve_below is None:
        approve_below = float(manifest.get("threshold_approve", sc.THRESHOLD_APPROVE))
    if decline_above is None:
        decline_above = float(manifest.get("threshold_decline", sc.THRESHOLD_DECLINE))
    x = fm.transform(df, frozen_profile=frozen_profile)
    keep = [k for k in keep if k in x.columns]
    x = fe.fill_sentinel(fe.align_features(x, manifest["feature_columns"], keep), manifest["feature_columns"])
    scored = model.score(x)
    return sc.decision_records(scored, "fraud_probability", manifest.get("run_id", "unknown"),
                               approve_below, decline_above, keep=tuple(keep))
