"""Mixing to target weights: soft domain memberships and projected-gradient least squares.

Domains are the classes of the labelled table: ``toxic``, else ``high`` or ``low`` quality.  A softmax
classifier over hashed words of the text (fitted on a bounded sample of labelled rows, ``SAMPLE_ROWS``
of each class) predicts each document's domain posterior p.  Document rates w >= 0 then minimise

    1/2 sum_k (sum_d w_d n_d p_dk / N - t_k)^2 / t_k + RIDGE/2 sum_d n_d / N (w_d - 1)^2

with n_d the document's tokens, N all tokens and t_k the domain's target share: expected domain
totals match the targets, and among rates that do, those near one are chosen.  In the metric n_d / N
a projected gradient step from the point y is

    w_d <- max(0, y_d - eta (sum_k p_dk r_k + RIDGE (y_d - 1))),   r_k = (sum_d y_d n_d p_dk / N) / t_k - 1

with a constant momentum between steps; step and momentum follow from the extreme eigenvalues of the
domains' second moments.  Only the residuals r (one number for each domain) depend on all rows.  A
document's rate is hence a function of its posterior and the residuals so far: each iteration is one
pass over the narrow table (tokens and posterior) that replays the steps per document and sums the
next residuals.  Nothing else is kept, so a lost executor costs one task.

Defined results
    null text, empty text  no tokens: the rate is that of its posterior, it adds nothing to a total
    no labels, one class   one domain, posterior one: every rate is the same
    absent domains         a target whose domain has no labelled row is left out, the others are scaled to one
    labels                 null ids and labels are left out; of repeated ids the largest label counts
    repeated rows          each row has its own rate and counts with its own tokens
    empty table            empty result
    extra columns          ignored by ``rates``, kept by ``mix`` (its own are added under free names)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

DOMAINS = ("high", "low", "toxic")
#: Target share of the tokens of each domain.
TARGETS = {"high": 0.70, "low": 0.28, "toxic": 0.02}
#: Labelled rows of each domain that the classifier is fitted on, at most.
SAMPLE_ROWS = 4000
FEATURES = 1 << 14
RIDGE = 1e-4
#: The iteration ends when no residual moves by more than this, or after so many steps.
TOLERANCE, STEPS = 1e-5, 300
#: Relative distance from the targets up to which they count as reached.
REACHED = 0.01
#: Partitions of the bounded sample that the classifier is fitted on.
PARTS = 12
#: Least eigenvalue that the momentum counts on, as a share of the largest.
LEAST_EIGENVALUE = 1e-4


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, y): the index in DOMAINS of every labelled document."""
    one = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("t"), F.max(F.col("quality").cast("int")).alias("q"))
    return one.select("doc_id", F.when(F.col("t") == 1, 2).when(F.col("q") == 1, 0).when(F.col("q") == 0, 1).alias("y")).filter("y is not null")


def _features(df: DataFrame) -> DataFrame:
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[ \t\n\x0B\f\r]+").transform(df)
    return HashingTF(inputCol="words", outputCol="features", numFeatures=FEATURES, binary=True).transform(words).drop("words")


def _normed(df: DataFrame) -> DataFrame:
    """Unit length, so that long and short texts weigh alike."""
    from pyspark.ml.feature import Normalizer

    return Normalizer(inputCol="features", outputCol="unit", p=2.0).transform(df).drop("features")


def _posteriors(documents: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, list[int]]:
    """``documents`` (rid, doc_id, text) as (rid, doc_id, n, p), and the domains that have labels."""
    y = materialize(domains(labels).join(documents.select("doc_id").distinct(), "doc_id", "left_semi"), "mix_labels")
    size = {int(r["y"]): int(r["n"]) for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    there = sorted(size)
    tokens = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    if len(there) < 2:
        return documents.select("doc_id", tokens.cast("long").alias("n"), F.array(F.lit(1.0)).alias("p")), there[:1] or [0]
    parts = [y.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in there]
    sample = parts[0]
    for x in parts[1:]:
        sample = sample.unionByName(x)
    code = F.create_map(*[F.lit(v) for i, c in enumerate(there) for v in (c, float(i))])
    # a class's rows weigh as much as the class has of all labels, whatever share of them is sampled
    weight = F.create_map(*[F.lit(v) for c in there for v in (c, size[c] / min(size[c], rows))])
    text = documents.select("doc_id", "text").join(F.broadcast(materialize(sample, "mix_sample")), "doc_id").dropDuplicates(["doc_id"])
    train = text.select("text", code[F.col("y")].alias("label"), weight[F.col("y")].alias("weight"))
    # few rows, many passes: PARTS partitions, kept in memory for the fit only
    train = _normed(_features(train)).select("unit", "label", "weight").repartition(PARTS).cache()
    model = LogisticRegression(featuresCol="unit", labelCol="label", weightCol="weight", family="multinomial", regParam=1e-4, maxIter=40).fit(train)
    train.unpersist()
    scored = model.transform(_normed(_features(documents.select("doc_id", "text", tokens.cast("long").alias("n")))))
    return scored.select("doc_id", "n", vector_to_array("probability").alias("p")), there


def _rates(p: np.ndarray, history: np.ndarray, eta: float, momentum: float, ahead: bool = False) -> np.ndarray:
    """Rates after the steps of ``history`` (a row of residuals for each), from one; or the point
    ahead of them where the next step starts."""
    w = before = np.ones(len(p))
    for r in history:
        y = w + momentum * (w - before)
        before, w = w, np.maximum(0.0, y - eta * (p @ r + RIDGE * (y - 1)))
    return w + momentum * (w - before) if ahead else w


def _matrix(p: pd.Series, k: int) -> np.ndarray:
    return np.array([np.asarray(x, dtype=float) for x in p], dtype=float).reshape(-1, k)


def solve(table: DataFrame, targets: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """(history of residuals, step, momentum, last residual) for ``table`` (n, p) and target shares; the last
    residual is the largest relative distance of a domain's expected share from its target."""
    k = len(targets)
    total = float(table.agg(F.sum("n")).first()[0] or 0)
    if not total:
        return np.zeros((0, k)), 0.0, 0.0, 0.0
    # second moments of the scaled posteriors: k * k sums
    pairs = table.agg(*[F.sum(F.col("n") * F.col("p")[i] * F.col("p")[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(k)]).first()
    eigen = np.linalg.eigvalsh(np.array([float(v) for v in pairs]).reshape(k, k) / total / np.sqrt(np.outer(targets, targets)))
    eta = 1.0 / (float(eigen.max()) + RIDGE)
    root = float(np.sqrt(max(eigen.min() + RIDGE, LEAST_EIGENVALUE * eigen.max()) * eta))
    momentum = (1 - root) / (1 + root)

    def residuals(history: np.ndarray, ahead: bool = True) -> np.ndarray:
        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros(k)
            for b in batches:
                p = _matrix(b["p"], k)
                sums += (b["n"].to_numpy(dtype=float) * _rates(p, history, eta, momentum, ahead)) @ p
            yield pd.DataFrame({"k": np.arange(k), "x": sums})
        sums = np.zeros(k)
        for r in table.mapInPandas(add, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():
            sums[r["k"]] = r["x"]
        return sums / total / targets - 1.0

    history = np.zeros((0, k))
    while len(history) < STEPS:
        r = residuals(history)
        history = np.vstack((history, r))
        if len(history) > 2 and np.abs(history[-3:] - r).max() < TOLERANCE:
            break
    # of the rates as they are given out, without the look ahead
    return history, eta, momentum, float(np.abs(residuals(history, False)).max())


def _shares(there: list[int], targets: dict[str, float]) -> np.ndarray:
    x = np.array([max(1e-9, targets.get(DOMAINS[i], 0.0)) for i in there])
    return x / x.sum()


def rates(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, n_tokens, the posterior of each domain, and the rate of every row.

    ``copies`` is the rate made whole: its integer part, and one more with the probability of the rest
    (drawn from the id).  ``residual`` is the largest relative distance of a domain's expected share of tokens
    from its target, and ``reached`` whether it is at most ``REACHED``: the same in every row.  Targets that no
    rates can meet (a domain without documents, or posteriors that never favour it), and a descent cut
    off after ``STEPS`` steps, are told by it.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scored, there = _posteriors(docs, labels, rows)
    scored = materialize(scored, "posteriors")
    history, eta, momentum, residual = solve(scored.select("n", "p"), _shares(there, targets or TARGETS))
    k = len(there)

    def rate(ps: pd.Series) -> pd.Series:
        return pd.Series(_rates(_matrix(ps, k), history, eta, momentum))

    out = scored.withColumn("rate", F.pandas_udf(rate, "double")("p"))
    place = {d: there.index(i) for i, d in enumerate(DOMAINS) if i in there}
    posterior = [(F.col("p")[place[d]] if d in place else F.lit(0.0)).alias(f"p_{d}") for d in DOMAINS]
    return out.select("doc_id", F.col("n").alias("n_tokens"), *posterior, "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"),
                      F.lit(residual).alias("residual"), F.lit(residual <= REACHED).alias("reached"))


def copies(rate, doc_id):
    """Whole number of copies with the rate as its mean over ids."""
    u = F.pmod(F.xxhash64(doc_id, F.lit("copies")), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix(documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``documents`` with the rate and number of copies of each; rows with rate zero go."""
    found = rates(documents, labels, targets, rows)
    rate, number = fresh(documents, "rate"), fresh(documents, "copies")
    # rows that repeat an id have rates of their own; the id's mean is theirs
    mean = found.groupBy("doc_id").agg(F.avg("rate").alias(rate)).withColumnRenamed("doc_id", "__id")
    met = documents.join(mean, documents["doc_id"].eqNullSafe(mean["__id"]), "left").drop("__id")
    return met.withColumn(number, copies(F.col(rate), F.col("doc_id"))).filter(F.col(rate) > 0)
