"""Candidate models, run log and champion selection.

The four candidates of the original and a linear one with a closed form:

* ``gbt_a``: best-first boosted trees, rate 0.05, 63 leaves, at least 20 rows a leaf, balanced class
  weights (``operators.boosting``);
* ``gbt_b``: boosted trees grown level by level, rate 0.05, depth 6, L2 penalty 1, positive weight 30;
* ``logreg``: standardisation + L2 logistic regression with C = 0.1
  (``regParam = 1 / (C * sum of weights)`` gives the same objective);
* ``calibrated``: 3 stratified folds of (booster of the other folds -> isotonic map of the
  held-out scores, ``operators.isotonic``), probabilities averaged over the folds;
* ``discriminant``: diagonal discriminant (``operators.linear``), whose values SQL can state.

Boosters asked for together grow in the same passes over the training rows.  ``PRESET_TREES`` is the
published tree count; jobs pass their own budget.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import together
from .boosting import Booster, TreeEnsemble, fit_boosters, importance
from .isotonic import IsotonicMap, fit_isotonic
from .linear import DiagonalDiscriminant
from .ordering import cut_keys, segment
from .resample import FIXED_POSITIVE_WEIGHT, add_class_weight

# Published model settings.
PRESET_TREES = 500
LEARNING_RATE = 0.05
TREE_LEAVES = 63
TREE_DEPTH = 6
MIN_LEAF_ROWS = 20
LOGREG_C = 0.1
LOGREG_MAX_ITER = 1000
CALIBRATION_FOLDS = 3
MODEL_NAMES = ["gbt_a", "gbt_b", "logreg", "calibrated"]
_BOOSTED = ("gbt_a", "gbt_b", "calibrated")


def assemble(feature_columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(feature_columns), outputCol="features", handleInvalid="keep")


def positive_probability(df: DataFrame, prob_col: str = "probability", out: str = "fraud_probability") -> DataFrame:
    """P(class 1) from a probability vector."""
    return df.withColumn(out, vector_to_array(F.col(prob_col))[1])


@dataclass
class CalibratedModel:
    """Average of ``k`` (booster, isotonic map) pairs."""
    boosters: list[TreeEnsemble]
    isotonic: list[IsotonicMap]

    def transform(self, df: DataFrame) -> DataFrame:
        raw, cal = [f"_raw{i}" for i in range(len(self.boosters))], [f"_cal{i}" for i in range(len(self.boosters))]
        out = df
        for i, (b, iso) in enumerate(zip(self.boosters, self.isotonic, strict=True)):
            out = iso.transform(b.transform(out, raw[i]), raw[i], cal[i])
        return out.withColumn("fraud_probability", sum(F.col(c) for c in cal) / len(cal)).drop(*raw, *cal)

    def save(self, path: str, spark: SparkSession) -> None:
        for i, (b, iso) in enumerate(zip(self.boosters, self.isotonic, strict=True)):
            b.save(f"{path}/booster_{i}", spark)
            iso.save(f"{path}/isotonic_{i}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, k: int = CALIBRATION_FOLDS) -> "CalibratedModel":
        return cls([TreeEnsemble.load(spark, f"{path}/booster_{i}") for i in range(k)],
                   [IsotonicMap.load(spark, f"{path}/isotonic_{i}") for i in range(k)])


class TrainedModel:
    """Uniform wrapper: ``score(df)`` adds ``fraud_probability``."""

    def __init__(self, name: str, model, feature_columns: Sequence[str]):
        self.name, self.model, self.feature_columns = name, model, list(feature_columns)

    def score(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        if "probability" in out.columns:
            out = positive_probability(out).drop("features", "scaled", "rawPrediction", "probability", "prediction")
        return out

    def save(self, path: str) -> None:
        if self.name in _BOOSTED:
            self.model.save(path, SparkSession.active())
        else:
            self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, name: str, path: str, feature_columns: Sequence[str]) -> "TrainedModel":
        if name in _BOOSTED:
            kind = CalibratedModel if name == "calibrated" else TreeEnsemble
            return cls(name, kind.load(SparkSession.active(), path), feature_columns)
        return cls(name, PipelineModel.load(path), feature_columns)


def stratified_folds(df: DataFrame, label: str, key: str, k: int = CALIBRATION_FOLDS, synthetic: str | None = None,
                     fold: str = "fold") -> DataFrame:
    """Add the fold of each labelled row: contiguous stretches of every class's rows in key order
    (synthetic rows, marked by ``synthetic``, after the others), sized so that the folds of both
    classes together differ by one row at most."""
    made = F.lit(False) if synthetic is None else F.coalesce(F.col(synthetic), F.lit(False))
    rows = df.where(F.col(label).isNotNull()).withColumn("_c", F.col(label).cast("int")).withColumn("_m", made.cast("int"))
    order = ["_c", "_m", key]
    sizes = [r["count"] for r in rows.groupBy("_c").count().orderBy("_c").collect()]  # one row a class

    def ends(n: int) -> list[int]:
        out, before = [], 0
        for size in sizes:
            # of the positions before .. before + size, fold i gets those that leave i when divided by k
            share = [(before + size - i + k - 1) // k - (before - i + k - 1) // k for i in range(k)]
            for part in share:
                before += part
                out.append(before)
        return out[:-1]

    cuts, _ = cut_keys(rows, order, ends)
    return rows.withColumn(fold, F.pmod(segment(rows, order, cuts), F.lit(k))).drop("_c", "_m")


def _balanced(label: str, counts: dict, use: Column | None = None) -> Column:
    """Weight n / (2 n_class) of the counted rows."""
    n = sum(counts.values())
    out = F.lit(0.0)
    for c, m in counts.items():
        out = F.when(F.col(label) == c, F.lit(n / (2.0 * m))).otherwise(out)
    return out if use is None else F.when(use, out).otherwise(0.0)


def _fit_boosted(names: Sequence[str], data: DataFrame, columns: Sequence[str], n_trees: int, key: str,
                 calibrate_on_real_rows: bool, synthetic: str | None) -> dict:
    """gbt_a, gbt_b and calibrated in shared passes over ``data`` (label column ``label``)."""
    folds = range(CALIBRATION_FOLDS) if "calibrated" in names else []
    if folds:
        data = stratified_folds(data, "label", key, CALIBRATION_FOLDS, synthetic, "_cfold")
    by = {}
    for r in data.where("label is not null").groupBy("label", *(["_cfold"] if folds else [])).count().collect():
        by[r["label"], r["_cfold"] if folds else 0] = r["count"]
    counts = lambda skip=None: {c: sum(n for (d, f), n in by.items() if d == c and f != skip) for c in {c for c, f in by if f != skip}}
    leafwise = dict(trees=n_trees, learning_rate=LEARNING_RATE, max_leaves=TREE_LEAVES, min_rows=MIN_LEAF_ROWS)
    boosters, rows = [], data
    if "gbt_a" in names:
        rows = rows.withColumn("_wa", _balanced("label", counts()))
        boosters.append(Booster("gbt_a", "_wa", **leafwise))
    if "gbt_b" in names:
        rows = rows.withColumn("_wb", F.when(F.col("label") == 1, FIXED_POSITIVE_WEIGHT).otherwise(1.0))
        boosters.append(Booster("gbt_b", "_wb", n_trees, LEARNING_RATE, max_leaves=None, max_depth=TREE_DEPTH, min_rows=1, min_hessian=1.0, l2=1.0, start=0.0))
    for k in folds:
        rows = rows.withColumn(f"_w{k}", _balanced("label", counts(k), F.col("_cfold") != k))
        boosters.append(Booster(f"fold_{k}", f"_w{k}", **leafwise))
    fitted = fit_boosters(rows, columns, "label", boosters)
    if folds:
        def calibrate(k: int) -> IsotonicMap:
            held = data.where(F.col("_cfold") == k)
            if calibrate_on_real_rows and synthetic is not None:
                held = held.where(~F.coalesce(F.col(synthetic), F.lit(False)))
            return fit_isotonic(fitted[f"fold_{k}"].transform(held, "_raw"), "_raw", "label")

        maps = together([partial(calibrate, k) for k in folds])
        fitted["calibrated"] = CalibratedModel([fitted[f"fold_{k}"] for k in folds], maps)
    return fitted


def _fit_pipeline(name: str, data: DataFrame, columns: Sequence[str]) -> PipelineModel:
    if name == "discriminant":
        return Pipeline(stages=[DiagonalDiscriminant(featureColumns=list(columns), labelCol="label")]).fit(data)
    if name != "logreg":
        raise ValueError(f"unknown model {name}")
    data = add_class_weight(data, "label", "balanced", "w")
    total_w = data.agg(F.sum("w")).first()[0]
    lr = LogisticRegression(featuresCol="scaled", labelCol="label", weightCol="w",
                            regParam=1.0 / (LOGREG_C * total_w), elasticNetParam=0.0,
                            standardization=False, maxIter=LOGREG_MAX_ITER)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return Pipeline(stages=[assemble(columns), scaler, lr]).fit(data)


def fit_models(names: Sequence[str], train: DataFrame, feature_columns: Sequence[str], label: str = "isFraud",
               n_trees: int = PRESET_TREES, key: str = "TransactionID", calibrate_on_real_rows: bool = True,
               synthetic: str | None = None) -> dict[str, TrainedModel]:
    """Fit candidates on a filled feature table (label column ``label``).

    ``synthetic`` names the boolean column that marks oversampled rows.  With
    ``calibrate_on_real_rows`` the isotonic maps of ``calibrated`` are fitted on the other held-out rows,
    so probabilities keep the real class prior; ``False`` calibrates on the rebalanced rows as the
    original did.
    """
    data = train.withColumn("label", F.col(label).cast("double"))
    boosted, others = [n for n in names if n in _BOOSTED], [n for n in names if n not in _BOOSTED]
    # the boosters' tasks leave cores idle, so the other candidates' jobs run beside them
    fits = [partial(_fit_boosted, boosted, data, feature_columns, n_trees, key, calibrate_on_real_rows, synthetic)] if boosted else []
    done = together([*fits, *(partial(_fit_pipeline, n, data, feature_columns) for n in others)])
    found = {**(done[0] if boosted else {}), **dict(zip(others, done[len(fits):], strict=True))}
    return {n: TrainedModel(n, found[n], feature_columns) for n in names}


def fit_model(name: str, train: DataFrame, feature_columns: Sequence[str], label: str = "isFraud", **settings) -> TrainedModel:
    """Fit one candidate (see ``fit_models``)."""
    return fit_models([name], train, feature_columns, label, **settings)[name]


def feature_importance(model: TrainedModel, spark: SparkSession, top: int = 30) -> DataFrame:
    """Top features of a booster: how many splits use a feature, and what they gain."""
    ensembles = model.model.boosters if isinstance(model.model, CalibratedModel) else [model.model]
    nodes = ensembles[0].nodes(spark)
    for e in ensembles[1:]:
        nodes = nodes.unionByName(e.nodes(spark))
    return importance(nodes).limit(top)


def new_run_id() -> str:
    return uuid.uuid4().hex


def runs_long(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Run log in long form: (run_id, model, split, metric, value)."""
    return spark.createDataFrame(rows, "run_id string, model string, split string, metric string, value double")


def leaderboard(runs: DataFrame) -> DataFrame:
    """One row per model, metrics as columns, best validation PR-AUC first."""
    wide = (runs.withColumn("m", F.concat_ws("_", "split", "metric"))
            .groupBy("model").pivot("m").agg(F.first("value")))
    return wide.orderBy(F.desc("val_pr_auc"), "model")


def champion(runs: DataFrame, order: Sequence[str] = MODEL_NAMES) -> DataFrame:
    """Arg-max of validation PR-AUC; ties go to the model listed first."""
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    lb = leaderboard(runs).withColumn("_pos", pos)
    return lb.orderBy(F.desc("val_pr_auc"), "_pos").limit(1).drop("_pos")
