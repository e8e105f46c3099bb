"""Hard-negative mining by slot-decomposed selection.

For every anchor the ``POSITIVES`` best other rows of its label are its positives; the negatives of a
positive are the best rows of another label whose score lies between ``low`` percent of the positive's
score and that score.  The windows of an anchor's positives overlap, so no row is compared with each of
them: the positives' scores, in descending order, are the upper limits that cut the axis of scores into
disjoint slots, a candidate falls into one slot, and only the ``k`` best of each slot are kept, first
in every task and then over all of them.  What lies below a positive's upper limit is its own slot and
all later ones, so merging the slots from the last to the first, cut to ``k`` each time, gives the best
``k`` below every limit; the window's lower limit then cuts off a tail.  No link is lost by any of this.

Components become integers ``floor(256 * x)`` and scores are exact inner products.  Anchors are met
with all rows in blocks: ``block_bytes`` bounds the anchors (with their positives' scores) that are
broadcast at a time, every block is one scan for positives and one for negatives, and tasks hand on at
most ``k`` rows for each anchor and slot.  A block's anchors and positives pass through the driver, so
its memory is bounded by ``block_bytes`` whatever the table's size.

Defined results
    null label, null vector, null or non-finite component   the row takes no part
    null vec_id        is no anchor, is not relabelled, sorts after every other id among equal scores
    repeated rows      each is a row of its own: repeated anchors answer twice, the repeat of an anchor
                       may be its positive
    ties               equal scores come by smaller vec_id; equal upper limits share a slot
    other lengths      of two vectors the shorter counts as filled up with zeros
    huge components    scores beyond a long count as the largest or smallest long
    anchors without positives, positives without negatives, empty table   no rows
    negative positive  its window is empty (80 % of it lies above it)
    extra columns      ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import with_row_index
from .common import materialize

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
#: Lower limit of a window as a share of its upper limit.
LOW_PERCENT = 80
SCALE = 256
BLOCK_BYTES = 16 << 20
#: Scores of one tile (rows of a batch x anchors) that a task holds at a time.
TILE = 4 << 20
#: Candidates that a task gathers before it cuts them to the best of each slot.
GATHER = 1 << 20
_LONG = (1 << 63) - 1
_EXACT = float(1 << 53)


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part; q is the array of integer components."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    label = F.col("label").cast("long")
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        x.alias("q")).filter(
        F.col("label").isNotNull() & F.col("q").isNotNull()
        & F.forall("q", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))


def _matrix(vectors, width: int) -> np.ndarray:
    """Integer components as doubles, a row for each vector, filled up with zeros."""
    size = np.fromiter(map(len, vectors), dtype=np.int64, count=len(vectors))
    if len(size) and size.min() == size.max():
        out = np.floor(SCALE * np.array(list(vectors), dtype=np.float64).reshape(len(size), -1))
        return out if out.shape[1] >= width else np.pad(out, ((0, 0), (0, width - out.shape[1])))
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))))
    for r, v in enumerate(vectors):
        out[r, :len(v)] = np.floor(SCALE * np.asarray(v, dtype=np.float64))
    return out


def _scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products as longs (saturating); the fast product is exact while no sum can pass 2^53."""
    width = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :width], anchors[:, :width]
    with np.errstate(over="ignore"):
        bound = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(width, 1)
    if bound < _EXACT:
        return (rows @ anchors.T).astype(np.int64)
    whole = np.array([[int(x) if np.isfinite(x) else int(np.sign(x)) << 1032 for x in r] for r in rows], dtype=object)
    other = np.array([[int(x) if np.isfinite(x) else int(np.sign(x)) << 1032 for x in a] for a in anchors], dtype=object)
    exact = whole.reshape(len(rows), width) @ other.reshape(len(anchors), width).T
    return np.array([[max(-_LONG, min(_LONG, int(v))) for v in r] for r in np.asarray(exact).reshape(len(rows), len(anchors))], dtype=np.int64).reshape(len(rows), len(anchors))


class Best:
    """The ``k`` best (score, id) of many groups, best first: higher score, then smaller id."""

    def __init__(self, groups: int, k: int):
        self.k, self.floor = k, np.full(groups, -_LONG - 1, dtype=np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        keep = score >= self.floor[group]  # a tie with the last one may still win by its id
        if keep.any():
            self.parts.append((group[keep], score[keep], vec_id[keep]))
            self.held += int(keep.sum())
        if self.held > GATHER:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        group, score, vec_id = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((vec_id, ~score, group))  # ~ turns the order without leaving the range of a long
        group, score, vec_id = group[order], score[order], vec_id[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
        last = place == self.k - 1
        self.floor[group[last]] = score[last]
        keep = place < self.k
        self.parts, self.held = [(group[keep], score[keep], vec_id[keep])], int(keep.sum())
        return self.parts[0]


#: Id that stands for null inside a task, where it sorts last.
_NO_ID = _LONG


def _ids(column: pd.Series) -> np.ndarray:
    return column.astype("Int64").fillna(_NO_ID).to_numpy(dtype=np.int64)


def _frame(found, first: str) -> pd.DataFrame:
    group, score, vec_id = found
    return pd.DataFrame({first: group, "score": score, "vec_id": pd.array(vec_id, dtype="Int64").copy()}).assign(
        vec_id=lambda f: f["vec_id"].mask(f["vec_id"] == _NO_ID))


def _tiles(rows: np.ndarray, anchors: np.ndarray):
    """(first row, first anchor, scores) of tiles of at most TILE scores."""
    step = max(1, TILE // max(1, min(len(rows), 2048)))
    for a in range(0, len(anchors), step):
        deep = max(1, TILE // max(1, min(step, len(anchors))))
        for r in range(0, len(rows), deep):
            yield r, a, _scores(rows[r:r + deep], anchors[a:a + step])


def _positive_scan(rows: DataFrame, block: pd.DataFrame, k: int) -> DataFrame:
    """The best ``k + 1`` rows of each anchor's own label, the anchor among them, from every task."""
    shared = rows.sparkSession.sparkContext.broadcast((_matrix(block["q"].tolist(), 0), block["label"].to_numpy(dtype=np.int64), block["anchor"].to_numpy(dtype=np.int64)))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix, label, number = shared.value
        best = Best(len(number), k + 1)
        for b in batches:
            if not len(b):
                continue
            vectors, own, ids = _matrix(b["q"].tolist(), 0), b["label"].to_numpy(dtype=np.int64), _ids(b["vec_id"])
            for value in np.unique(own):
                at, of = np.flatnonzero(own == value), np.flatnonzero(label == value)
                for r, a, s in _tiles(vectors[at], matrix[of]):
                    floor = best.floor[of[a:a + s.shape[1]]]
                    if len(s) > k + 1:
                        floor = np.maximum(floor, np.partition(s, -(k + 1), axis=0)[-(k + 1)])
                    row, anchor = np.nonzero(s >= floor)
                    best.add(of[a + anchor], s[row, anchor], ids[at[r + row]])
        group, score, vec_id = best.cut()
        yield _frame((number[group], score, vec_id), "anchor")

    return rows.mapInPandas(scan, "anchor long, score long, vec_id long")


def _negative_scan(rows: DataFrame, block: pd.DataFrame, limits: np.ndarray, k: int, low_percent: int) -> DataFrame:
    """The best ``k`` rows of another label in each slot of each anchor, from every task.

    ``limits`` has a row of descending upper limits for each anchor of the block; places without a
    positive hold the smallest long, below every score that could count.
    """
    m = limits.shape[1]
    lowest = np.where(limits > -_LONG - 1, _lower(limits, low_percent), _LONG).min(axis=1)
    shared = rows.sparkSession.sparkContext.broadcast((_matrix(block["q"].tolist(), 0), block["label"].to_numpy(dtype=np.int64), block["anchor"].to_numpy(dtype=np.int64), limits, lowest))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix, label, number, limits, lowest = shared.value
        best = Best(len(number) * m, k)
        for b in batches:
            if not len(b):
                continue
            vectors, own, ids = _matrix(b["q"].tolist(), 0), b["label"].to_numpy(dtype=np.int64), _ids(b["vec_id"])
            for r, a, s in _tiles(vectors, matrix):
                to = a + s.shape[1]
                row, anchor = np.nonzero((s >= lowest[a:to]) & (s <= limits[a:to, 0]) & (own[r:r + len(s), None] != label[a:to]))
                score = s[row, anchor]
                # the slot is that of the smallest upper limit that is not below the score
                slot = (limits[a + anchor] >= score[:, None]).sum(axis=1) - 1
                best.add((a + anchor) * m + slot, score, ids[r + row])
        group, score, vec_id = best.cut()
        yield _frame((number[group // m], score, vec_id), "anchor").assign(slot=(group % m).astype(np.int32))[["anchor", "slot", "score", "vec_id"]]

    return rows.mapInPandas(scan, "anchor long, slot int, score long, vec_id long")


def _lower(upper: np.ndarray, low_percent: int) -> np.ndarray:
    """Smallest whole score with 100 * score >= low_percent * upper, without leaving the range of a long."""
    hundreds, rest = np.divmod(upper, 100)
    return hundreds * low_percent - (-(rest * low_percent) // 100)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key; tasks cut their own before the shuffle, so a key's rows are at
    most ``k`` a task."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
         anchor_every: int = ANCHOR_EVERY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score."""
    spark = rows.sparkSession
    rows = quantised(rows)
    anchors, count = with_row_index(rows.filter(F.col("vec_id") % anchor_every == 0), ["vec_id", "label", "q"], "anchor")
    parts = []
    if count:
        anchors = materialize(anchors, "anchors")
        widest = anchors.agg(F.max(F.size("q"))).first()[0]
        step = max(1, block_bytes // (8 * (widest + positives + 4)))
        for start in range(1, count + 1, step):
            chosen = anchors.filter(F.col("anchor").between(start, start + step - 1))
            block = chosen.toPandas()  # at most block_bytes
            same = _first(_positive_scan(rows, block, positives), ["anchor"], positives + 1)
            # the anchor itself is one row of its own score and id: take that one away, then the first ones are left
            own = pd.Series([int(_scores(v, v)[0, 0]) for v in (_matrix([q], 0) for q in block["q"])], index=block["anchor"])
            met = same.select("anchor", "score", "vec_id").toPandas()  # positives + 1 rows for each anchor of the block
            met["vec_id"] = met["vec_id"].astype("Int64")
            ids = pd.Series(block["vec_id"].to_numpy(), index=block["anchor"])
            itself = (met["score"] == met["anchor"].map(own)) & (met["vec_id"] == met["anchor"].map(ids)).fillna(False)
            itself &= ~itself.groupby(met["anchor"]).cumsum().gt(1)
            met = met[~itself.astype(bool)].sort_values(["anchor", "score", "vec_id"], ascending=[True, False, True], na_position="last", kind="stable")
            met["j"] = met.groupby("anchor").cumcount()
            met = met[met["j"] < positives]
            limits = np.full((len(block), positives), -_LONG - 1, dtype=np.int64)
            at = pd.Series(np.arange(len(block)), index=block["anchor"])
            limits[at[met["anchor"]].to_numpy(), met["j"].to_numpy()] = met["score"].to_numpy()
            slots = _first(_negative_scan(rows, block, limits, negatives, low_percent), ["anchor", "slot"], negatives)
            low = _lower(met["score"].to_numpy(dtype=np.int64), low_percent)
            wanted = spark.createDataFrame(
                [(int(a), int(ids[a]), int(j), None if pd.isna(i) else int(i), int(s), int(w))
                 for (a, j, i, s), w in zip(met[["anchor", "j", "vec_id", "score"]].itertuples(index=False), low, strict=True)],
                "anchor long, anchor_id long, j int, positive_id long, positive_score long, low long")
            parts.append(materialize(_windows(slots, wanted, positives, negatives), "hard_negatives"))
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for p in parts:
        empty = empty.unionByName(p)
    return empty


def _windows(slots: DataFrame, wanted: DataFrame, positives: int, negatives: int) -> DataFrame:
    """Answer every window from the slots' best by merging them from the last slot to the first."""
    best = slots.groupBy("anchor").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("slot") == j, F.struct(F.col("place"), F.col("score"), F.col("vec_id"))))).alias(f"slot_{j}")
        for j in range(positives)])
    suffix = None
    for j in reversed(range(positives)):  # slots are disjoint and descend, so joined lists stay in order
        here = F.col(f"slot_{j}")
        suffix = here if suffix is None else F.slice(F.concat(here, F.col(f"from_{j + 1}")), 1, negatives)
        best = best.withColumn(f"from_{j}", suffix)
    met = wanted.join(best, "anchor")
    below = F.element_at(F.array(*[F.col(f"from_{j}") for j in range(positives)]), F.col("j") + 1)
    return met.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.filter(below, lambda n: n["score"] >= F.col("low"))).alias("place", "n")).select(
        "anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"))
