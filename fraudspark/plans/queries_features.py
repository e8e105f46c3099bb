"""Correlation, pruning and full feature-matrix queries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import prune
from ..operators import split as sp
from ..operators.stages import CardProfiler, CorrelationPruner, FrequencyEncoder, NullIndicator, OrdinalEncoder, TargetEncoder
from ..session import scratch_path
from ..sources import tables as tb
from .catalog import r6, register, rounded, s6
from .feature_model import FeaturePipeline
from .ingest import left_join_identity
from .queries_encode import _SPLIT_CTE

_V = tb.V_COLUMNS


def _corr_sql(a: str, b: str) -> str:
    return (f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END")


def _pairs_sql(source: str = "txn") -> str:
    parts = []
    for j in range(len(_V)):
        for i in range(j):
            parts.append(f"SELECT '{_V[i]}' AS col_i, '{_V[j]}' AS col_j, "
                         f"{s6('abs(' + _corr_sql(_V[i], _V[j]) + ')')} AS abs_r FROM {source}")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", tb.with_views(_pairs_sql(), "txn"))
def q_corr_matrix(spark, sf):
    """|r| of every pair of V columns, pairwise-complete, long form."""
    pairs = prune.corr_pairs(tb.txn(spark, sf).select(*_V), _V)
    return pairs.select("col_i", "col_j", r6(F.abs("r")).alias("abs_r"))


@register("corr_matrix_gram", tb.with_views(_pairs_sql(), "txn"))
def q_corr_matrix_gram(spark, sf):
    """Earlier second name of ``corr_matrix`` (one plan serves every width)."""
    return q_corr_matrix(spark, sf)


def _prune_sql(source: str = "txn") -> str:
    return f"""
SELECT v.column_name, cast(coalesce(d.dropped, false) AS int) AS dropped
FROM (SELECT unnest([{', '.join(f"'{c}'" for c in _V)}]) AS column_name) v
LEFT JOIN (SELECT col_j, bool_or(abs_r > 0.95) AS dropped FROM ({_pairs_sql(source)}) GROUP BY col_j) d
  ON v.column_name = d.col_j
"""


@register("prune_correlated", tb.with_views(_prune_sql(), "txn"))
def q_prune(spark, sf):
    """Per V column: dropped (1) if an earlier V column has |r| > 0.95."""
    t = tb.txn(spark, sf).select(*_V)
    dropped = prune.columns_to_prune(prune.corr_pairs(t, _V))
    names = spark.createDataFrame([(c,) for c in _V], "column_name string")
    # at most one row per V column: bounded broadcast
    return names.join(F.broadcast(dropped.select("column_name", F.lit(1).alias("d"))), "column_name", "left") \
        .select("column_name", F.coalesce(F.col("d"), F.lit(0)).alias("dropped"))


_NUMERIC = [c for c in tb.TXN_COLUMNS if c not in (
    "isFraud", "ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "M1", "M2", "M3", "M4",
    "DeviceType")]


@register("label_correlation", tb.with_views(
    "SELECT column_name, abs_corr FROM (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {s6('abs(' + _corr_sql(c, 'isFraud') + ')')} AS abs_corr FROM txn"
        for c in _NUMERIC) + ") ORDER BY abs_corr DESC NULLS LAST, column_name LIMIT 20", "txn"))
def q_label_corr(spark, sf):
    """Top 20 numeric columns by |corr with label| (label itself excluded)."""
    t = tb.txn(spark, sf)
    lc = prune.label_correlation(t.select(*[c for c in t.columns if c in _NUMERIC], "isFraud"), "isFraud")
    return (lc.select("column_name", r6("abs_corr").alias("abs_corr"))
            .orderBy(F.desc_nulls_last("abs_corr"), "column_name").limit(20))


# ------------------------------------------------------------ feature matrix

_ORD = {c: v for c, v in fe.ORDINAL_COLS.items()}


def _ord(c):
    lits = ", ".join(f"'{x.lower()}'" for x in _ORD[c])
    return f"coalesce(cast(list_position([{lits}], lower(trim(tr.{c}, ' \t\n\r\x0b\x0c'))) - 1 AS int), -1)"


_H = "((floor(tr.TransactionDT / 3600) % 24 + 24) % 24)"
_D = "(((floor(tr.TransactionDT / 86400) + 3) % 7 + 7) % 7)"


def _oof_join(c, i):
    return f"""LEFT JOIN (
  SELECT st.cat, st.fold, CASE WHEN tt.nn - st.n > 0 THEN (tt.ss - st.s) / (tt.nn - st.n) END AS v
  FROM (SELECT cast({c} AS varchar) AS cat, fold, count(isFraud) AS n, sum(isFraud) AS s
        FROM tr WHERE {c} IS NOT NULL GROUP BY 1, 2) st
  JOIN (SELECT cast({c} AS varchar) AS cat, count(isFraud) AS nn, sum(isFraud) AS ss
        FROM tr WHERE {c} IS NOT NULL GROUP BY 1) tt ON st.cat = tt.cat
) t{i} ON cast(tr.{c} AS varchar) = t{i}.cat AND tr.fold = t{i}.fold"""


def _freq_join(c, i):
    return (f"LEFT JOIN (SELECT cast({c} AS varchar) AS cat, count(*) / sum(count(*)) OVER () AS v FROM tr "
            f"WHERE {c} IS NOT NULL GROUP BY 1) f{i} ON cast(tr.{c} AS varchar) = f{i}.cat")


# (name, sql, is_double) of the pipeline's output; of the V columns those that pruning keeps.
_FM_COLS = [
    ("TransactionID", "tr.TransactionID", False), ("isFraud", "tr.isFraud", False),
    ("TransactionAmt", "tr.TransactionAmt", True), ("card1", "coalesce(f0.v, 0.0)", True),
    ("ProductCD", _ord("ProductCD"), False), ("card2", "coalesce(f1.v, 0.0)", True),
    ("card3", "coalesce(f2.v, 0.0)", True), ("card4", _ord("card4"), False), ("card5", "tr.card5", True),
    ("card6", _ord("card6"), False), ("addr1", "tr.addr1", True), ("addr2", "tr.addr2", True),
    ("dist1", "tr.dist1", True), ("dist2", "tr.dist2", True),
    ("P_emaildomain", "coalesce(t0.v, (SELECT g FROM g))", True),
    ("R_emaildomain", "coalesce(t1.v, (SELECT g FROM g))", True),
    ("C1", "tr.C1", True), ("C2", "tr.C2", True), ("C3", "tr.C3", True), ("C4", "tr.C4", True),
    ("M1", "try_cast(tr.M1 AS double)", True), ("M2", "try_cast(tr.M2 AS double)", True),
    ("M3", "try_cast(tr.M3 AS double)", True), ("M4", _ord("M4"), False),
    ("DeviceType", _ord("DeviceType"), False),
    ("hour_sin", f"sin(2 * pi() * {_H} / 24)", True), ("hour_cos", f"cos(2 * pi() * {_H} / 24)", True),
    ("dow_sin", f"sin(2 * pi() * {_D} / 7)", True), ("dow_cos", f"cos(2 * pi() * {_D} / 7)", True),
    ("is_weekend", f"coalesce(cast({_D} >= 5 AS int), 0)", False),
    ("is_night", f"coalesce(cast({_H} >= 23 OR {_H} <= 5 AS int), 0)", False),
    ("log_amount", "ln(1 + tr.TransactionAmt)", True),
    ("amount_zscore", "(tr.TransactionAmt - cs.m) / (cs.sd + 1e-8)", True),
    ("card_txn_count", "cs.n", False), ("card_total_spend", "cs.tot", True), ("card_mean_spend", "cs.m", True),
    ("DeviceType_was_null", "cast(tr.DeviceType IS NULL AS int)", False),
    ("P_emaildomain_was_null", "cast(tr.P_emaildomain IS NULL AS int)", False),
    *[(c, f"tr.{c}", True) for c in ("V1", "V3", "V4", "V6")],
]
_FM_NAMES = [n for n, _, _ in _FM_COLS]


def _feature_joins(target: list[str], freq: list[str]) -> str:
    """Joins of training rows with their out-of-fold label means and category shares."""
    return "\n".join([_oof_join(c, i) for i, c in enumerate(target)] + [_freq_join(c, i) for i, c in enumerate(freq)])


def _feature_matrix_sql() -> str:
    sel = ",\n  ".join((s6(e) if d else e) + f" AS {n}" for n, e, d in _FM_COLS)
    return tb.with_views(f"""
WITH {_SPLIT_CTE},
cs AS (SELECT card1, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS sd, count(TransactionID) AS n,
              coalesce(sum(TransactionAmt), 0.0) AS tot FROM tr WHERE card1 IS NOT NULL GROUP BY card1)
SELECT {sel}
FROM tr LEFT JOIN cs ON tr.card1 = cs.card1
{_feature_joins(["P_emaildomain", "R_emaildomain"], ["card1", "card2", "card3"])}
""", "txn")


def _fit(spark, sf):
    t = tb.txn(spark, sf).drop("p")
    s, _ = sp.time_split(t, folds=5)
    train = s.where(F.col("split") == "train").drop("split")
    # the V-column gate is a parameter; the fixture has six V columns
    return FeaturePipeline(min_v_cols=5).fit_transform(train, fold="fold")


@register("feature_matrix", _feature_matrix_sql())
def q_feature_matrix(spark, sf):
    """Fitted feature matrix of the training rows (out-of-fold target encoding)."""
    _, x = _fit(spark, sf)
    return rounded(x)


@register("feature_pruned_v", tb.with_views(
    f"WITH {_SPLIT_CTE}\nSELECT column_name FROM ({_prune_sql('tr')}) WHERE dropped = 1", "txn"))
def q_feature_pruned(spark, sf):
    """V columns the fitted pipeline drops (correlation measured on the training rows)."""
    model, _ = _fit(spark, sf)
    return spark.createDataFrame([(c,) for c in model.dropped_v], "column_name string")


# ------------------------------------------------- features of the merged table
def _merged(spark, sf):
    return left_join_identity(tb.transactions(spark, sf), tb.identity(spark, sf))


_MERGED_SPLIT = "mg AS (SELECT t.*, i.* EXCLUDE (TransactionID) FROM transactions t LEFT JOIN identity i ON t.TransactionID = i.TransactionID)," \
    + _SPLIT_CTE.replace("FROM txn", "FROM mg")
_CARD_CTE = """cs AS (SELECT card1, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS sd, count(TransactionID) AS n,
              coalesce(sum(TransactionAmt), 0.0) AS tot FROM tr WHERE card1 IS NOT NULL GROUP BY card1)"""
_MERGED_COLS = [*_FM_COLS, ("DeviceInfo", "coalesce(t2.v, (SELECT g FROM g))", True), ("id_31", "coalesce(t3.v, (SELECT g FROM g))", True),
                ("DeviceInfo_was_null", "cast(tr.DeviceInfo IS NULL AS int)", False), ("id_31_was_null", "cast(tr.id_31 IS NULL AS int)", False)]


@register("feature_matrix_merged", tb.with_views(f"""
WITH {_MERGED_SPLIT}, {_CARD_CTE}
SELECT {", ".join((s6(e) if d else e) + f" AS {n}" for n, e, d in _MERGED_COLS)}
FROM tr LEFT JOIN cs ON tr.card1 = cs.card1
{_feature_joins(["P_emaildomain", "R_emaildomain", "DeviceInfo", "id_31"], ["card1", "card2", "card3"])}
""", "transactions", "identity"))
def q_feature_matrix_merged(spark, sf):
    """Fitted feature matrix of the training rows of transactions joined with identity."""
    s, _ = sp.time_split(_merged(spark, sf).drop("p"), folds=5)
    train = s.where(F.col("split") == "train").drop("split")
    return rounded(FeaturePipeline(min_v_cols=5).fit_transform(train, fold="fold")[1])


_STAGE_TARGETS, _STAGE_SHARES = ["P_emaildomain", "R_emaildomain", "DeviceInfo", "id_31"], ["card1", "card2"]


def _smoothed_join(c, i):
    return f"""LEFT JOIN (SELECT {c} AS cat, (sum(isFraud) + (SELECT g FROM g)) / (count(isFraud) + 1.0) AS v
  FROM tr WHERE {c} IS NOT NULL GROUP BY 1) e{i} ON a.{c} = e{i}.cat"""


@register("feature_stages", tb.with_views(f"""
WITH {_MERGED_SPLIT}, {_CARD_CTE}
SELECT a.TransactionID, {", ".join(_ord(c).replace("tr.", "a.") + f" AS {c}" for c in ("card4", "DeviceType"))},
       {", ".join(f"cast(a.{c} IS NULL AS int) AS {c}_was_null" for c in ("DeviceInfo", "id_31"))},
       {", ".join(s6(f"coalesce(e{i}.v, (SELECT g FROM g))") + f" AS {c}" for i, c in enumerate(_STAGE_TARGETS))},
       {", ".join(s6(f"coalesce(f{i}.v, 0.0)") + f" AS {c}" for i, c in enumerate(_STAGE_SHARES))},
       {s6("(a.TransactionAmt - cs.m) / (cs.sd + 1e-8)")} AS amount_zscore, cs.n AS card_txn_count,
       {", ".join(s6(f"a.{c}") + f" AS {c}" for c in ("V1", "V3", "V4", "V6"))}
FROM sp a LEFT JOIN cs ON a.card1 = cs.card1
{" ".join(_smoothed_join(c, i) for i, c in enumerate(_STAGE_TARGETS))}
{" ".join(_freq_join(c, i).replace("cast(tr.", "cast(a.") for i, c in enumerate(_STAGE_SHARES))}
""", "transactions", "identity"))
def q_feature_stages(spark, sf):
    """One ML pipeline of all feature stages, fitted on the merged training rows, saved, loaded, and
    applied to every merged row."""
    merged = _merged(spark, sf).drop("p")
    s, _ = sp.time_split(merged)
    stages = [CardProfiler(), NullIndicator(inputCols=["DeviceInfo", "id_31"]), OrdinalEncoder(), TargetEncoder(inputCols=_STAGE_TARGETS),
              FrequencyEncoder(inputCols=_STAGE_SHARES), CorrelationPruner(minCols=5)]
    path = scratch_path(spark, "feature_stages")
    Pipeline(stages=stages).fit(s.where(F.col("split") == "train").drop("split")).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(merged)
    kept = [c for c in out.columns if c.startswith("V")]
    return rounded(out.select("TransactionID", "card4", "DeviceType", "DeviceInfo_was_null", "id_31_was_null", *_STAGE_TARGETS, *_STAGE_SHARES,
                              "amount_zscore", "card_txn_count", *kept))
