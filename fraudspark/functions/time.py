"""Elapsed-seconds time features.

Hour and weekday come straight from integer arithmetic on the elapsed
seconds, which keeps them inside whole-stage codegen and free of time zones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The origin that elapsed seconds are counted from, and its
# weekday with Monday = 0 (2017-11-30 was a Thursday).
REFERENCE_DATE = "2017-11-30 00:00:00"
REFERENCE_WEEKDAY = 3

TWO_PI = 2 * math.pi


def event_time(dt: Column) -> Column:
    """Reference date + elapsed seconds as TIMESTAMP_NTZ (no zone involved)."""
    return F.expr(f"timestamp_ntz'{REFERENCE_DATE}'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), dt.cast("decimal(18,6)"))


def hour_expr(dt: Column) -> Column:
    return F.pmod(F.floor(dt / 3600), F.lit(24))


def dow_expr(dt: Column) -> Column:
    """Day of week, Monday = 0 (pandas ``dayofweek``)."""
    return F.pmod(F.floor(dt / 86400) + REFERENCE_WEEKDAY, F.lit(7))


def time_feature_columns(dt: Column) -> list[Column]:
    """Cyclical hour / weekday encodings and weekend / night flags.

    A null elapsed time gives null sin/cos but 0 for both flags, as NaN
    comparisons do in pandas.
    """
    h = hour_expr(dt)
    d = dow_expr(dt)
    return [
        F.sin(F.lit(TWO_PI) * h / 24).alias("hour_sin"),
        F.cos(F.lit(TWO_PI) * h / 24).alias("hour_cos"),
        F.sin(F.lit(TWO_PI) * d / 7).alias("dow_sin"),
        F.cos(F.lit(TWO_PI) * d / 7).alias("dow_cos"),
        F.coalesce((d >= 5).cast("int"), F.lit(0)).alias("is_weekend"),
        F.coalesce(((h >= 23) | (h <= 5)).cast("int"), F.lit(0)).alias("is_night"),
    ]
