"""Row-level feature queries: time, amount, per-card and point-in-time velocity,
null flags, ordinal / match-flag encodings, numeric coercion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import TWO_PI, event_time, hour_expr
from ..operators import features as fe
from ..sources import tables as tb
from .catalog import r6, register, s6

_H = "((floor(TransactionDT / 3600) % 24 + 24) % 24)"
_D = "(((floor(TransactionDT / 86400) + 3) % 7 + 7) % 7)"


@register("time_features", tb.with_views(f"""
SELECT TransactionID,
       {s6('sin(2 * pi() * h / 24)')} AS hour_sin, {s6('cos(2 * pi() * h / 24)')} AS hour_cos,
       {s6('sin(2 * pi() * d / 7)')} AS dow_sin, {s6('cos(2 * pi() * d / 7)')} AS dow_cos,
       coalesce(cast(d >= 5 as int), 0) AS is_weekend,
       coalesce(cast(h >= 23 OR h <= 5 as int), 0) AS is_night
FROM (SELECT TransactionID, {_H} AS h, {_D} AS d FROM txn)
""", "txn"))
def q_time_features(spark, sf):
    df = fe.add_time_features(tb.txn(spark, sf).select("TransactionID", "TransactionDT"))
    return df.select("TransactionID", *[r6(c).alias(c) for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")],
                     "is_weekend", "is_night")


@register("hour_cycle", f"""
SELECT h AS hour, {s6('sin(2 * pi() * h / 24)')} AS hour_sin, {s6('cos(2 * pi() * h / 24)')} AS hour_cos,
       count(t.TransactionID) AS n_transactions
FROM range(24) r(h) LEFT JOIN ({tb.duck_view('txn')}) t ON {_H} = h
GROUP BY h
""")
def q_hour_cycle(spark, sf):
    """24-row cyclical encoding table, with how many transactions fall in each hour."""
    hours = spark.range(24).withColumnRenamed("id", "hour")
    t = tb.txn(spark, sf).select(hour_expr(F.col("TransactionDT")).alias("hour"), "TransactionID")
    counts = t.groupBy("hour").agg(F.count("TransactionID").alias("n_transactions"))
    # 24 rows by construction: broadcast is size-safe.
    out = hours.join(F.broadcast(counts), "hour", "left")
    return out.select(F.col("hour").cast("bigint").alias("hour"),
                      r6(F.sin(F.lit(TWO_PI) * F.col("hour") / 24)).alias("hour_sin"),
                      r6(F.cos(F.lit(TWO_PI) * F.col("hour") / 24)).alias("hour_cos"),
                      F.coalesce(F.col("n_transactions"), F.lit(0)).cast("bigint").alias("n_transactions"))


@register("event_time", tb.with_views("""
SELECT TransactionID, strftime(timestamp '2017-11-30 00:00:00' + to_seconds(TransactionDT), '%Y-%m-%d %H:%M:%S') AS event_time
FROM txn
""", "txn"))
def q_event_time(spark, sf):
    t = tb.txn(spark, sf)
    return t.select("TransactionID",
                    F.date_format(event_time(F.col("TransactionDT")), "yyyy-MM-dd HH:mm:ss").alias("event_time"))


@register("log_amount", tb.with_views(f"""
SELECT TransactionID, {s6('ln(1 + TransactionAmt)')} AS log_amount FROM txn
""", "txn"))
def q_log_amount(spark, sf):
    return tb.txn(spark, sf).select("TransactionID", r6(F.log1p("TransactionAmt")).alias("log_amount"))


_CARD_STATS = """
cs AS (SELECT card1, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS sd,
              count(TransactionID) AS n, coalesce(sum(TransactionAmt), 0.0) AS tot
       FROM txn WHERE card1 IS NOT NULL GROUP BY card1)
"""


@register("amount_zscore", tb.with_views(f"""
WITH {_CARD_STATS}
SELECT t.TransactionID, {s6('ln(1 + t.TransactionAmt)')} AS log_amount,
       {s6('(t.TransactionAmt - cs.m) / (cs.sd + 1e-8)')} AS amount_zscore
FROM txn t LEFT JOIN cs ON t.card1 = cs.card1
""", "txn"))
def q_amount_zscore(spark, sf):
    df = fe.add_card_features(tb.txn(spark, sf).select("TransactionID", "card1", "TransactionAmt"))
    return df.select("TransactionID", r6("log_amount").alias("log_amount"), r6("amount_zscore").alias("amount_zscore"))


@register("velocity", tb.with_views(f"""
WITH {_CARD_STATS}
SELECT t.TransactionID, cs.n AS card_txn_count, {s6('cs.tot')} AS card_total_spend,
       {s6('cs.m')} AS card_mean_spend
FROM txn t LEFT JOIN cs ON t.card1 = cs.card1
""", "txn"))
def q_velocity(spark, sf):
    df = fe.add_card_features(tb.txn(spark, sf).select("TransactionID", "card1", "TransactionAmt"))
    return df.select("TransactionID", "card_txn_count", r6("card_total_spend").alias("card_total_spend"),
                     r6("card_mean_spend").alias("card_mean_spend"))


@register("card_profile", tb.with_views(f"""
WITH {_CARD_STATS}
SELECT card1, {s6('m')} AS mean_amount, {s6('sd')} AS std_amount, n AS n_transactions,
       {s6('tot')} AS total_amount FROM cs
""", "txn"))
def q_card_profile(spark, sf):
    p = fe.card_profile(tb.txn(spark, sf))
    return p.select("card1", r6("_card_mean").alias("mean_amount"), r6("_card_std").alias("std_amount"),
                    F.col("_card_count").alias("n_transactions"), r6("_card_total").alias("total_amount"))


def _pit_sql(seconds: int, suffix: str) -> str:
    return tb.with_views(f"""
SELECT TransactionID, count(*) OVER w AS card_count_{suffix},
       {s6('coalesce(sum(TransactionAmt) OVER w, 0.0)')} AS card_spend_{suffix}
FROM txn
WINDOW w AS (PARTITION BY card1 ORDER BY TransactionDT RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING)
""", "txn")


def _pit(spark, sf, seconds, suffix):
    t = tb.txn(spark, sf).select("TransactionID", "card1", "TransactionDT", "TransactionAmt")
    df = fe.add_point_in_time_velocity(t, seconds, suffix)
    return df.select("TransactionID", F.col(f"card_count_{suffix}").cast("bigint").alias(f"card_count_{suffix}"),
                     r6(f"card_spend_{suffix}").alias(f"card_spend_{suffix}"))


@register("velocity_1h", _pit_sql(3600, "1h"))
def q_velocity_1h(spark, sf):
    return _pit(spark, sf, 3600, "1h")


@register("velocity_24h", _pit_sql(86400, "24h"))
def q_velocity_24h(spark, sf):
    return _pit(spark, sf, 86400, "24h")


@register("null_indicators", tb.with_views("""
SELECT TransactionID, cast(DeviceType IS NULL as int) AS DeviceType_was_null,
       cast(P_emaildomain IS NULL as int) AS P_emaildomain_was_null
FROM txn
""", "txn"))
def q_null_indicators(spark, sf):
    t = tb.txn(spark, sf).select("TransactionID", "DeviceType", "P_emaildomain")
    out = fe.add_null_indicators(t)
    return out.select("TransactionID", *[c for c in out.columns if c.endswith("_was_null")])


def _ord_sql(col: str, cats: list[str]) -> str:
    lits = ", ".join(f"'{c.lower()}'" for c in cats)
    return f"coalesce(cast(list_position([{lits}], lower(trim({col}, ' \t\n\r\x0b\x0c'))) - 1 as int), -1) AS {col}"


@register("ordinal_encode", tb.with_views(f"""
SELECT TransactionID, {', '.join(_ord_sql(c, v) for c, v in fe.ORDINAL_COLS.items())} FROM txn
""", "txn"))
def q_ordinal_encode(spark, sf):
    t = tb.txn(spark, sf).select("TransactionID", *fe.ORDINAL_COLS)
    return fe.encode_ordinals(t)


@register("match_flags", tb.with_views("""
SELECT TransactionID,
       cast(CASE M1 WHEN 'T' THEN 1 WHEN 'F' THEN 0 ELSE -1 END as int) AS M1,
       cast(CASE M2 WHEN 'T' THEN 1 WHEN 'F' THEN 0 ELSE -1 END as int) AS M2,
       cast(CASE M3 WHEN 'T' THEN 1 WHEN 'F' THEN 0 ELSE -1 END as int) AS M3
FROM txn
""", "txn"))
def q_match_flags(spark, sf):
    return fe.encode_match_flags(tb.txn(spark, sf).select("TransactionID", "M1", "M2", "M3"))


@register("numeric_coerce", tb.with_views("""
SELECT TransactionID, try_cast(M1 AS double) AS M1, try_cast(card4 AS double) AS card4,
       try_cast(concat(cast(card1 AS varchar), '.5') AS double) AS card1_text, TransactionAmt
FROM txn
""", "txn"))
def q_numeric_coerce(spark, sf):
    t = tb.txn(spark, sf).select("TransactionID", "M1", "card4",
                                 F.concat(F.col("card1").cast("string"), F.lit(".5")).alias("card1_text"),
                                 "TransactionAmt")
    return fe.coerce_all_numeric(t, keep=["TransactionID"])


# Feature order of a fitted model; hour_sin is absent from the frame being scored.
_ALIGN_LIST = ["TransactionAmt", "dist1", "hour_sin", "card5", "V5"]


def _aligned(spark, sf):
    t = tb.txn(spark, sf).select("TransactionID", "TransactionAmt", "dist1", "card5", "V5", "ProductCD")
    return fe.align_features(t, _ALIGN_LIST, keep=["TransactionID"])


@register("align_features", tb.with_views("""
SELECT TransactionID, TransactionAmt, dist1, CAST(NULL AS double) AS hour_sin, card5, V5 FROM txn
""", "txn"))
def q_align(spark, sf):
    """Absent features added as null, extra columns dropped, manifest order imposed."""
    return _aligned(spark, sf)


@register("fill_sentinel", tb.with_views("""
SELECT TransactionID, coalesce(TransactionAmt, -999.0) AS TransactionAmt, coalesce(dist1, -999.0) AS dist1,
       -999.0 AS hour_sin, coalesce(card5, -999.0) AS card5, coalesce(V5, -999.0) AS V5 FROM txn
""", "txn"))
def q_fill(spark, sf):
    """Nulls (and NaN) of the aligned features replaced by -999."""
    return fe.fill_sentinel(_aligned(spark, sf), _ALIGN_LIST)
