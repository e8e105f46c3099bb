"""Registered queries: Spark job + DuckDB oracle text, side by side.

Every query reads the driver's tables through the fixture views of
``sources.tables`` and runs over the whole table.  Doubles are rounded to six
places (four where the original rounds) on both sides, and ``+ 0.0`` folds
negative zero, so the value hashes of the two engines can agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Both engines round the same nudged value: a true tie at the last place
# (means of 3-decimal scores over 16 rows, say) is pushed the same way on both
# sides instead of depending on the last bit of each engine's summation order.
# The nudge stays far below half a unit of the last place (capped at 1e-8).
_ABS_NUDGE, _REL_NUDGE, _MAX_NUDGE = 1e-12, 1e-11, 1e-8


def r6(c: Column | str, places: int = 6) -> Column:
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    nudge = F.least(F.lit(_ABS_NUDGE) + F.abs(c) * F.lit(_REL_NUDGE), F.lit(_MAX_NUDGE))
    return F.round(c + F.signum(c) * nudge, places) + F.lit(0.0)


def s6(expr: str, places: int = 6) -> str:
    x = f"cast({expr} as double)"
    nudge = f"least({_ABS_NUDGE} + abs({x}) * {_REL_NUDGE}, {_MAX_NUDGE})"
    return f"(round({x} + sign({x}) * {nudge}, {places}) + 0.0)"


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column of a result."""
    return df.select(*[r6(f.name, places).alias(f.name) if f.dataType.typeName() in ("double", "float")
                       else F.col(f.name) for f in df.schema.fields])


# Query modules register themselves on import.
from . import queries_core, queries_encode, queries_eval, queries_features, queries_models, queries_quality, queries_stream  # noqa: E402,F401,I001
