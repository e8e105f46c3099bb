"""Time-ordered split, hold-out tail and contiguous folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import cut_keys, fold_ends, segment, with_row_index

# Train and validation shares; the test share is the rest.
TRAIN_FRAC, VAL_FRAC = 0.70, 0.15


def time_split(df: DataFrame, dt: str = "TransactionDT", key: str = "TransactionID",
               train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC,
               folds: int = 0) -> tuple[DataFrame, int]:
    """Add ``split`` in {train, val, test} by time (ties by key), cut after
    ``int(n * train)`` and ``int(n * (train + val))`` rows; with ``folds``, also
    ``fold``: the contiguous fold of each training row (null elsewhere).

    All cuts come from one index of (time, key); the rows themselves are
    labelled where they are, by comparing their key with the cut keys.
    """
    def ends(n: int) -> list[int]:
        train = int(n * train_frac)
        return [train, int(n * (train_frac + val_frac)), *(fold_ends(train, folds) if folds else [])]

    cuts, n = cut_keys(df, [dt, key], ends)
    part = segment(df, [dt, key], cuts[:2])
    out = df.withColumn("split", F.when(part == 0, "train").when(part == 1, "val").otherwise("test"))
    if folds:
        out = out.withColumn("fold", F.when(part == 0, segment(df, [dt, key], cuts[2:])))
    return out, n


def time_split_positions(df: DataFrame, dt: str = "TransactionDT", key: str = "TransactionID",
                         train_frac: float = TRAIN_FRAC, val_frac: float = VAL_FRAC) -> tuple[DataFrame, int]:
    """The split with each row's position ``rn``, both from one index of the rows."""
    at, n = with_row_index(df, [dt, key])
    rn = F.col("rn")
    return at.withColumn("split", F.when(rn <= int(n * train_frac), "train").when(rn <= int(n * (train_frac + val_frac)), "val").otherwise("test")), n


def test_tail(df: DataFrame, dt: str = "TransactionDT", key: str = "TransactionID",
              start_frac: float = TRAIN_FRAC + VAL_FRAC) -> tuple[DataFrame, int]:
    """``(tail, start)``: the last part of the time order, the rows after position
    ``start = int(n * start_frac)``."""
    cuts, n = cut_keys(df, [dt, key], lambda n: [int(n * start_frac)])
    return df.where(segment(df, [dt, key], cuts) > 0), int(n * start_frac)


def test_tail_positions(df: DataFrame, dt: str = "TransactionDT", key: str = "TransactionID",
                        start_frac: float = TRAIN_FRAC + VAL_FRAC) -> tuple[DataFrame, int]:
    """The tail with each row's global position ``rn``; the position inside the
    tail is ``rn - start``."""
    tail, start = test_tail(df, dt, key, start_frac)
    indexed, _ = with_row_index(tail, [dt, key])
    return indexed.withColumn("rn", F.col("rn") + start), start


def add_folds(df: DataFrame, k: int = 5, dt: str = "TransactionDT", key: str = "TransactionID",
              fold: str = "fold") -> DataFrame:
    """Contiguous fold id over the time order of ``df`` (k-fold without shuffling)."""
    cuts, _ = cut_keys(df, [dt, key], lambda n: fold_ends(n, k))
    return df.withColumn(fold, segment(df, [dt, key], cuts))
