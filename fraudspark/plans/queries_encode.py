"""Split, fold and categorical-encoder queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import encoders as enc
from ..operators import ordering as od
from ..operators import split as sp
from ..session import scratch_path
from ..sources import tables as tb
from .catalog import r6, register, s6

# Common oracle CTEs: time positions, train rows with contiguous folds, label mean.
_SPLIT_CTE = """
sp AS (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) AS rn, count(*) OVER () AS n FROM txn),
tr AS (SELECT *, ntile(5) OVER (ORDER BY rn) - 1 AS fold FROM sp WHERE rn <= floor(n * 0.7::double)),
ap AS (SELECT * FROM sp WHERE rn > floor(n * 0.7::double)),
g AS (SELECT avg(isFraud) AS g FROM tr)
"""


def _train_apply(spark, sf, frame=None):
    """(train rows with fold, val+test rows) of the time split."""
    t = frame if frame is not None else tb.txn(spark, sf)
    s, _ = sp.time_split(t, folds=5)
    train = s.where(F.col("split") == "train")
    rest = s.where(F.col("split") != "train")
    return train, rest


# ------------------------------------------------------------------ split

@register("time_split", """
SELECT o_orderkey, rn, CASE WHEN rn <= floor(n * 0.7::double) THEN 'train'
                            WHEN rn <= floor(n * 0.85::double) THEN 'val' ELSE 'test' END AS split
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n
      FROM orders)
""")
def q_time_split(spark, sf):
    """Orders by date (2,399 distinct days for 15,000 rows at sf0.01: heavy ties, key breaks them)."""
    o = tb.read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return sp.time_split_positions(o, dt="o_orderdate", key="o_orderkey")[0].select("o_orderkey", "rn", "split")


@register("split_rates", tb.with_views(f"""
WITH {_SPLIT_CTE}
SELECT split, count(*) AS n_rows, {s6('avg(isFraud)')} AS fraud_rate FROM (
  SELECT isFraud, CASE WHEN rn <= floor(n * 0.7::double) THEN 'train'
                       WHEN rn <= floor(n * 0.85::double) THEN 'val' ELSE 'test' END AS split FROM sp)
GROUP BY split
""", "txn"))
def q_split_rates(spark, sf):
    s, _ = sp.time_split(tb.txn(spark, sf).select("TransactionID", "TransactionDT", "isFraud"))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), r6(F.avg("isFraud")).alias("fraud_rate"))


@register("test_tail", tb.with_views(f"""
WITH {_SPLIT_CTE}
SELECT TransactionID, rn FROM sp WHERE rn > floor(n * 0.85::double)
""", "txn"))
def q_test_tail(spark, sf):
    tail, _ = sp.test_tail_positions(tb.txn(spark, sf).select("TransactionID", "TransactionDT"))
    return tail.select("TransactionID", "rn")


@register("batch_index", tb.with_views(f"""
WITH {_SPLIT_CTE}
SELECT TransactionID, cast(floor((rn - floor(n * 0.85::double) - 1) / 500) AS bigint) AS batch
FROM sp WHERE rn > floor(n * 0.85::double)
""", "txn"))
def q_batch_index(spark, sf):
    """Test tail replayed in fixed batches of 500 rows."""
    tail, start = sp.test_tail_positions(tb.txn(spark, sf).select("TransactionID", "TransactionDT"))
    return tail.select("TransactionID", od.batch_index(F.col("rn") - start, 500).alias("batch"))


# --------------------------------------------------------- target encoding
_TE_COLS = ["P_emaildomain", "R_emaildomain"]


def _te_state_sql(cols) -> str:
    parts = [f"""SELECT '{c}' AS col, cast({c} AS varchar) AS category, count(isFraud) AS n,
       {s6('(count(isFraud) * (sum(isFraud) / count(isFraud)) + 1.0 * (SELECT g FROM g)) / (count(isFraud) + 1.0)')}
       AS value
FROM tr WHERE {c} IS NOT NULL GROUP BY {c}""" for c in cols]
    return "\nUNION ALL\n".join(parts)


def _te_fit(spark, sf):
    train, rest = _train_apply(spark, sf)
    return enc.fit_target_encoding(train, _TE_COLS, "isFraud", 1.0), train, rest


def _state_out(state):
    return state.select("col", "category", "n", r6("value").alias("value"))


@register("target_encode_fit", tb.with_views(f"WITH {_SPLIT_CTE}\n{_te_state_sql(_TE_COLS)}", "txn"))
def q_te_fit(spark, sf):
    e, _, _ = _te_fit(spark, sf)
    return _state_out(e.state)


@register("encoder_state_roundtrip", tb.with_views(f"WITH {_SPLIT_CTE}\n{_te_state_sql(_TE_COLS)}", "txn"))
def q_te_roundtrip(spark, sf):
    e, _, _ = _te_fit(spark, sf)
    path = scratch_path(spark, "target_state")
    e.save(path)
    return _state_out(enc.TargetEncoding.load(spark, path).state)


def _te_apply_sql(cols, rows_cte: str, fold: bool) -> str:
    sel, joins = [], []
    for i, c in enumerate(cols):
        if fold:
            joins.append(f"""LEFT JOIN (
  SELECT st.cat, st.fold, CASE WHEN tt.nn - st.n > 0 THEN (tt.ss - st.s) / (tt.nn - st.n) END AS v
  FROM (SELECT cast({c} AS varchar) AS cat, fold, count(isFraud) AS n, sum(isFraud) AS s
        FROM tr WHERE {c} IS NOT NULL GROUP BY 1, 2) st
  JOIN (SELECT cast({c} AS varchar) AS cat, count(isFraud) AS nn, sum(isFraud) AS ss
        FROM tr WHERE {c} IS NOT NULL GROUP BY 1) tt ON st.cat = tt.cat
) j{i} ON cast(r.{c} AS varchar) = j{i}.cat AND r.fold = j{i}.fold""")
        else:
            joins.append(f"""LEFT JOIN (
  SELECT cast({c} AS varchar) AS cat,
         (count(isFraud) * (sum(isFraud) / count(isFraud)) + 1.0 * (SELECT g FROM g)) / (count(isFraud) + 1.0) AS v
  FROM tr WHERE {c} IS NOT NULL GROUP BY 1
) j{i} ON cast(r.{c} AS varchar) = j{i}.cat""")
        sel.append(f"{s6(f'coalesce(j{i}.v, (SELECT g FROM g))')} AS {c}")
    return f"SELECT r.TransactionID, {', '.join(sel)} FROM {rows_cte} r\n" + "\n".join(joins)


@register("target_encode_apply", tb.with_views(f"WITH {_SPLIT_CTE}\n{_te_apply_sql(_TE_COLS, 'ap', False)}",
                                               "txn"))
def q_te_apply(spark, sf):
    """Smoothed map fitted on the train rows, applied to validation + test rows."""
    e, _, rest = _te_fit(spark, sf)
    out = e.transform(rest.select("TransactionID", *_TE_COLS))
    return out.select("TransactionID", *[r6(c).alias(c) for c in _TE_COLS])


@register("target_encode_joined", tb.with_views(f"WITH {_SPLIT_CTE}\n{_te_apply_sql(_TE_COLS, 'ap', False)}", "txn"))
def q_te_joined(spark, sf):
    """The same values by the way of a state too large to broadcast."""
    e, _, rest = _te_fit(spark, sf)
    out = replace(e, state_bytes=1 << 60).transform(rest.select("TransactionID", *_TE_COLS))
    return out.select("TransactionID", *[r6(c).alias(c) for c in _TE_COLS])


@register("target_encode_oof", tb.with_views(f"WITH {_SPLIT_CTE}\n{_te_apply_sql(_TE_COLS, 'tr', True)}",
                                             "txn"))
def q_te_oof(spark, sf):
    """Training rows: mean label of the category over the other four folds."""
    e, train, _ = _te_fit(spark, sf)
    out = enc.target_encode_out_of_fold(train.select("TransactionID", "isFraud", "fold", *_TE_COLS),
                                        e, "isFraud", "fold")
    return out.select("TransactionID", *[r6(c).alias(c) for c in _TE_COLS])


# ------------------------------------------------------- frequency encoding
_FE_COLS = ["card1", "card2", "card3"]


def _fe_state_sql(cols, normalize=True) -> str:
    parts = []
    for c in cols:
        val = f"count(*) / sum(count(*)) OVER ()" if normalize else "cast(count(*) AS double)"
        # whole numbers read the same from integer and floating columns
        parts.append(f"SELECT '{c}' AS col, cast(cast({c} AS bigint) AS varchar) AS category, count(*) AS n, {s6(val)} AS value "
                     f"FROM tr WHERE {c} IS NOT NULL GROUP BY {c}")
    return "\nUNION ALL\n".join(parts)


@register("freq_encode_fit", tb.with_views(f"WITH {_SPLIT_CTE}\n{_fe_state_sql(_FE_COLS)}", "txn"))
def q_fe_fit(spark, sf):
    train, _ = _train_apply(spark, sf)
    return _state_out(enc.fit_frequency_encoding(train, _FE_COLS).state)


def _fe_apply_sql(cols, normalize=True) -> str:
    sel, joins = [], []
    for i, c in enumerate(cols):
        val = "count(*) / sum(count(*)) OVER ()" if normalize else "cast(count(*) AS double)"
        joins.append(f"LEFT JOIN (SELECT cast({c} AS varchar) AS cat, {val} AS v FROM tr "
                     f"WHERE {c} IS NOT NULL GROUP BY 1) j{i} ON cast(r.{c} AS varchar) = j{i}.cat")
        sel.append(f"{s6(f'coalesce(j{i}.v, 0.0)')} AS {c}")
    return f"SELECT r.TransactionID, {', '.join(sel)} FROM ap r\n" + "\n".join(joins)


@register("freq_encode_apply", tb.with_views(f"WITH {_SPLIT_CTE}\n{_fe_apply_sql(_FE_COLS)}", "txn"))
def q_fe_apply(spark, sf):
    train, rest = _train_apply(spark, sf)
    e = enc.fit_frequency_encoding(train, _FE_COLS)
    return e.transform(rest.select("TransactionID", *_FE_COLS)).select(
        "TransactionID", *[r6(c).alias(c) for c in _FE_COLS])


@register("freq_encode_joined", tb.with_views(f"WITH {_SPLIT_CTE}\n{_fe_apply_sql(_FE_COLS)}", "txn"))
def q_fe_joined(spark, sf):
    """The same values by the way of a state too large to broadcast."""
    train, rest = _train_apply(spark, sf)
    e = replace(enc.fit_frequency_encoding(train, _FE_COLS), state_bytes=1 << 60)
    return e.transform(rest.select("TransactionID", *_FE_COLS)).select(
        "TransactionID", *[r6(c).alias(c) for c in _FE_COLS])


@register("freq_encode_raw", tb.with_views(f"WITH {_SPLIT_CTE}\n{_fe_apply_sql(_FE_COLS, False)}", "txn"))
def q_fe_raw(spark, sf):
    train, rest = _train_apply(spark, sf)
    e = enc.fit_frequency_encoding(train, _FE_COLS, normalize=False)
    return e.transform(rest.select("TransactionID", *_FE_COLS)).select(
        "TransactionID", *[r6(c).alias(c) for c in _FE_COLS])


@register("encode_missing_column", tb.with_views(f"""
WITH {_SPLIT_CTE}
SELECT TransactionID, {s6('(SELECT g FROM g)')} AS DeviceType, 0.0 AS card2 FROM ap
""", "txn"))
def q_missing(spark, sf):
    """Columns fitted but absent when applying: global mean / 0.0."""
    train, rest = _train_apply(spark, sf)
    te = enc.fit_target_encoding(train, ["DeviceType"], "isFraud")
    fq = enc.fit_frequency_encoding(train, ["card2"])
    out = fq.transform(te.transform(rest.select("TransactionID")))
    return out.select("TransactionID", r6("DeviceType").alias("DeviceType"), r6("card2").alias("card2"))


@register("category_fraud_rate", tb.with_views(f"""
SELECT P_emaildomain AS domain, {s6('avg(isFraud)')} AS fraud_rate, count(isFraud) AS n
FROM txn WHERE P_emaildomain IS NOT NULL GROUP BY P_emaildomain HAVING count(isFraud) > 100
ORDER BY avg(isFraud) DESC, domain LIMIT 20
""", "txn"))
def q_category_rate(spark, sf):
    """Label rate per e-mail domain with more than 100 rows, top 20."""
    st = enc.category_label_stats(tb.txn(spark, sf), ["P_emaildomain"], "isFraud")
    return (st.where(F.col("n") > 100).select(F.col("category").alias("domain"),
                                              (F.col("s") / F.col("n")).alias("rate"), "n")
            .orderBy(F.desc("rate"), "domain").limit(20)
            .select("domain", r6("rate").alias("fraud_rate"), "n"))
