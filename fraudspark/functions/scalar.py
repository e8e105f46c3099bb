"""Scalar column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from both ends of a category before lookup (Python's
# ASCII whitespace, the set ``str.strip`` removes for these inputs).
_WHITESPACE = " \t\n\r\x0b\x0c"


def category_text(c: Column) -> Column:
    """lower + strip, the normalisation applied before ordinal lookup."""
    return F.lower(F.btrim(c, F.lit(_WHITESPACE)))


def ordinal_code(c: Column, categories: Sequence[str], fold_case: bool = True) -> Column:
    """0-based index in ``categories``; -1 for null or unseen.

    ``fold_case=False`` keeps the list as given, so upper-case lists never
    match the lower-cased input (the literal behaviour of the original).
    """
    cats = [x.lower() for x in categories] if fold_case else list(categories)
    pos = F.array_position(F.array(*[F.lit(x) for x in cats]), category_text(c))
    return F.coalesce((pos - 1).cast("int"), F.lit(-1))


def match_flag(c: Column) -> Column:
    """T -> 1, F -> 0, anything else (null included) -> -1."""
    return (F.when(c == "T", F.lit(1)).when(c == "F", F.lit(0)).otherwise(F.lit(-1))).cast("int")


def coerce_numeric(c: Column) -> Column:
    """String -> double, null where unparsable (never throws under ANSI)."""
    return c.try_cast("double")


def log_amount(c: Column) -> Column:
    return F.log1p(c)


def round_half_even_4(c: Column) -> Column:
    """Python's round(x, 4) on the binary value: half-even at exact ties."""
    return F.bround(c, 4)


_M32 = 4294967296


def portable_hash(key: Column, seed: int) -> Column:
    """(key * 2654435761 + seed) mod 2**32 for any BIGINT key, without overflow.

    The multiplier is split in 16-bit halves so every intermediate stays below
    2**63; DuckDB evaluates the same text (see ``portable_hash_sql``).
    """
    x = F.pmod(key.cast("bigint"), F.lit(_M32))
    hi = F.pmod(x * F.lit(40503), F.lit(_M32)) * F.lit(65536)
    return F.pmod(hi + x * F.lit(31153) + F.lit(seed), F.lit(_M32))


def portable_hash_sql(key: str, seed: int) -> str:
    x = f"((({key}) % {_M32} + {_M32}) % {_M32})"
    return f"(((({x} * 40503) % {_M32}) * 65536 + {x} * 31153 + {seed}) % {_M32})"
