"""Row-level and per-card feature operators.

Per-card statistics are computed as an aggregation (map-side partial
aggregation absorbs hot cards) and attached back by a join, never by a
whole-partition window: a window puts every row of one card into one task,
while the aggregate + join lets AQE broadcast the small profile table or
split a skewed join partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scalar import coerce_numeric, match_flag, ordinal_code
from ..functions.time import time_feature_columns
from ..session import materialize
from .joins import attach

# Low-cardinality categories and their code order.
ORDINAL_COLS = {
    "ProductCD": ["C", "H", "R", "S", "W"],
    "card4": ["american express", "discover", "mastercard", "visa"],
    "card6": ["charge card", "credit", "debit", "debit or credit"],
    "DeviceType": ["desktop", "mobile"],
    "M4": ["M0", "M1", "M2"],
}
# Columns that get a `<col>_was_null` flag.
NULL_FLAG_COLS = ["DeviceType", "DeviceInfo", "id_30", "id_31", "P_emaildomain"]
# Fixed value: added to the card standard deviation before dividing.
ZSCORE_EPS = 1e-8


def add_time_features(df: DataFrame, dt: str = "TransactionDT") -> DataFrame:
    return df.select("*", *time_feature_columns(F.col(dt)))


def card_profile(df: DataFrame, key: str = "card1", amount: str = "TransactionAmt",
                 id_col: str | None = "TransactionID") -> DataFrame:
    """Per-key amount statistics: mean, sample std, count of ids, total.

    Null keys form no group (they get null statistics after the join).
    """
    cnt = F.count(id_col) if id_col else F.count(F.lit(1))
    return (df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.avg(amount).alias("_card_mean"),
                 F.stddev_samp(amount).alias("_card_std"),
                 cnt.alias("_card_count"),
                 F.coalesce(F.sum(amount), F.lit(0.0)).alias("_card_total")))


def add_card_features(df: DataFrame, key: str = "card1", amount: str = "TransactionAmt",
                      profile: DataFrame | None = None, profile_rows: int | None = None) -> DataFrame:
    """log amount, per-card z-score and whole-frame velocity proxies.

    With ``profile=None`` the statistics are recomputed on ``df`` itself
    (batch behaviour of the original); pass a fitted profile table to score
    with frozen statistics (streams, single rows).
    """
    has_id = "TransactionID" in df.columns
    prof = profile
    if prof is None:
        # Batch mode: build the profile first (a narrow aggregation, written
        # once) and count it, so the join can broadcast it when it is small
        # instead of shuffling the full-width frame; a large profile falls back
        # to a skew-aware sort-merge join.
        prof = materialize(card_profile(df, key, amount, "TransactionID" if has_id else None), "card_profile")
        profile_rows = prof.count()
    joined = attach(df, prof, key, known_rows=profile_rows)
    amt = F.col(amount)
    # Batch mode without an id column: every row counts as one transaction of
    # its card (a single scoring row).  A fitted profile always supplies counts.
    count_col = F.col("_card_count") if (has_id or profile is not None) else F.lit(1)
    out = joined.select(
        *[F.col(c) for c in df.columns],
        F.log1p(amt).alias("log_amount"),
        ((amt - F.col("_card_mean")) / (F.col("_card_std") + ZSCORE_EPS)).alias("amount_zscore"),
        count_col.cast("bigint").alias("card_txn_count"),
        F.col("_card_total").alias("card_total_spend"),
        F.col("_card_mean").alias("card_mean_spend"),
    )
    return out


def add_point_in_time_velocity(df: DataFrame, seconds: int, suffix: str, key: str = "card1",
                               dt: str = "TransactionDT", amount: str = "TransactionAmt") -> DataFrame:
    """Count and spend of the same card in [t - seconds, t - 1], past rows only.

    One plan for every size, independent of the row id.  Rows are first summed
    per (card, second), with partial aggregation, so a hot card shrinks before
    the shuffle and a (card, bucket of ``seconds``) group has at most
    2 * ``seconds`` rows however many transactions it stands for.  Every second
    is also entered ``seconds`` later as a "past" entry; a range [t - seconds,
    t - 1] is then the end of the previous bucket (past entries at t or later,
    summed backwards) plus the start of the own bucket (entries before t, summed
    forwards): two linear running sums, nothing is subtracted.  The result is
    joined back on (card, second), where AQE splits a hot card's rows.

    Times must be whole seconds (an integer column).  Rows with a null card or
    time get null results and take no part in the join; null amounts add
    nothing to the spend; a NaN amount makes the spend of the ranges that hold
    it NaN; repeated or null ids make no difference.
    """
    if not isinstance(df.schema[dt].dataType, T.IntegralType):
        raise TypeError(f"{dt} must hold whole seconds in an integer column")
    valid = F.col(key).isNotNull() & F.col(dt).isNotNull()
    t = F.col(dt).cast("bigint")
    secs = df.where(valid).groupBy(F.col(key).alias("_k"), t.alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(F.col(amount).cast("double")), F.lit(0.0)).alias("_s"))
    entries = secs.select("_k", "_n", "_s", F.explode(F.array(
        F.struct(F.col("_t").alias("x"), F.lit(True).alias("own")),
        F.struct((F.col("_t") + seconds).alias("x"), F.lit(False).alias("own")))).alias("e"))
    own = F.col("e.own")
    x = F.col("e.x")
    line = entries.select(
        "_k", x.alias("_x"), F.floor(x / F.lit(seconds)).alias("_b"), own.alias("_own"),
        F.when(own, F.col("_n")).otherwise(0).alias("_on"), F.when(own, F.col("_s")).otherwise(0.0).alias("_os"),
        F.when(own, 0).otherwise(F.col("_n")).alias("_pn"), F.when(own, 0.0).otherwise(F.col("_s")).alias("_ps"))
    bucket = Window.partitionBy("_k", "_b")
    before = bucket.orderBy(F.col("_x")).rangeBetween(Window.unboundedPreceding, -1)
    after = bucket.orderBy(F.col("_x").desc()).rangeBetween(Window.unboundedPreceding, 0)
    cnt_name, sum_name = f"card_count_{suffix}", f"card_spend_{suffix}"
    none = F.lit(0), F.lit(0.0)
    value = (line.select(
        "_k", "_x", "_own",
        (F.coalesce(F.sum("_on").over(before), none[0]) + F.sum("_pn").over(after)).cast("bigint").alias(cnt_name),
        (F.coalesce(F.sum("_os").over(before), none[1]) + F.sum("_ps").over(after)).alias(sum_name))
        .where("_own").drop("_own"))
    found = df.where(valid).join(value, (F.col(key) == F.col("_k")) & (t == F.col("_x")), "left")
    rest = df.where(~valid).select(*df.columns, F.lit(None).cast("bigint").alias(cnt_name),
                                   F.lit(None).cast("double").alias(sum_name))
    return found.select(*df.columns, cnt_name, sum_name).unionByName(rest)


def add_null_indicators(df: DataFrame, cols: Sequence[str] = NULL_FLAG_COLS) -> DataFrame:
    """`<c>_was_null` (0/1) for each listed column that is present; NaN counts as null."""
    extra = []
    for c in cols:
        if c not in df.columns:
            continue
        col = F.col(c)
        is_missing = col.isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            is_missing = is_missing | F.isnan(col)
        extra.append(is_missing.cast("int").alias(f"{c}_was_null"))
    return df.select("*", *extra)


def encode_ordinals(df: DataFrame, mapping: dict[str, list[str]] = ORDINAL_COLS,
                    fold_case: bool = True) -> DataFrame:
    """Replace each present ordinal column by its code (-1 for null / unseen)."""
    return df.select(*[ordinal_code(F.col(c), mapping[c], fold_case).alias(c) if c in mapping else F.col(c)
                       for c in df.columns])


def encode_match_flags(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Documented M-flag mapping T -> 1, F -> 0, null -> -1."""
    cols = [c for c in (cols or [f"M{i}" for i in range(1, 10)]) if c in df.columns and c != "M4"]
    return df.select(*[match_flag(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def coerce_all_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every string column -> double (null where unparsable); numbers unchanged."""
    out: list[Column] = []
    for f in df.schema.fields:
        if f.name in keep or not isinstance(f.dataType, (T.StringType, T.BooleanType)):
            out.append(F.col(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            out.append(F.col(f.name).cast("int").alias(f.name))
        else:
            out.append(coerce_numeric(F.col(f.name)).alias(f.name))
    return df.select(*out)


def align_features(df: DataFrame, feature_columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Fix the column set and order: absent features become null doubles, extras go."""
    present = set(df.columns)
    cols = [F.col(c) for c in keep if c in present]
    cols += [F.col(c) if c in present else F.lit(None).cast("double").alias(c) for c in feature_columns]
    return df.select(*cols)


def fill_sentinel(df: DataFrame, cols: Sequence[str] | None = None, value: float = -999.0) -> DataFrame:
    """Replace null (and NaN) numeric values by the sentinel."""
    cols = set(cols) if cols is not None else set(df.columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(value)).alias(f.name))
        elif f.name in cols and isinstance(f.dataType, T.NumericType):
            out.append(F.coalesce(c, F.lit(value).cast(f.dataType)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
