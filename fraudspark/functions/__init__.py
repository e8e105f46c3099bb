"""Column-expression builders (JVM-side, codegen friendly)."""

from .scalar import (category_text, coerce_numeric, log_amount, match_flag, ordinal_code,
                     portable_hash, round_half_even_4)
from .time import REFERENCE_DATE, dow_expr, event_time, hour_expr, time_feature_columns

__all__ = [
    "category_text", "coerce_numeric", "log_amount", "match_flag", "ordinal_code", "portable_hash",
    "round_half_even_4", "REFERENCE_DATE", "dow_expr", "event_time", "hour_expr", "time_feature_columns",
]
