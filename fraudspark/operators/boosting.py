"""Gradient-boosted trees for two classes: second order, best-first, on histograms.

Features are cut once into at most ``MAX_BINS`` bins and written as one byte a feature with each row's
label, weights and raw scores.  A pass over that table adds, in every task, the gradients and
hessians of the rows of the wanted nodes by feature and bin; a shuffle on the node adds the tasks'
histograms; the driver gets one histogram a node (features x bins, whatever the number of rows).

A tree grows best first: the leaf whose split gains most is split next, until ``max_leaves`` leaves
(a depth limit instead gives a tree level by level).  A pass looks one step ahead for every leaf that
may still be split, so a tree takes about as many passes as it is deep, and replaying the order of
gains afterwards gives exactly the tree that one split at a time gives.  Only the child with fewer rows
is summed, the other one is its parent less its sibling.  A node of at most ``LOCAL_ROWS`` rows and
``LOCAL_BYTES`` goes to one task with its rows, which grows all that best-first order can still take below it, so many nodes
of a deep tree cost one pass; where that holds for the root, the task grows up to ``LOCAL_TREES`` trees one after
another before it answers, once the first tree is there.  Leaves hold Newton steps.

Boosters that share their rows (the candidates, the folds of a calibration) grow in the same passes.
Raw scores are brought up to date every ``WRITE_EVERY`` trees by writing the table anew, which also cuts
the lineage; between these, tasks add the new trees themselves.  Missing values count as smallest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, together

MAX_BINS = 255
WRITE_EVERY = 5
#: Rows of a node that one task may hold to grow what lies below it, and their bytes (one byte a feature, and
#: two doubles); a larger node is summed by all tasks.  Long chains of small splits would cost a pass each.
LOCAL_ROWS, LOCAL_BYTES = 1 << 20, 64 << 20
#: Trees that one task grows in a pass where all rows of a booster are such a node.
LOCAL_TREES = 25
#: Rows that a task bins or sums at a time.
CHUNK_ROWS = 65_536
#: Rows times features whose histograms are summed in one call.
HISTOGRAM_CELLS = 1 << 16
_QUANTILE_ACCURACY = 10_000
#: Features whose quantiles one job sketches.
SKETCHED = 4


@dataclass(frozen=True)
class Booster:
    """Settings of one booster; ``weight`` names the column of its row weights (0: not its row)."""
    name: str
    weight: str
    trees: int
    learning_rate: float = 0.05
    max_leaves: int | None = 63
    max_depth: int | None = None
    min_rows: int = 20
    min_hessian: float = 1e-3
    l2: float = 0.0
    start: float | None = None      # raw score before the first tree; None: log-odds of the weighted labels

    def leaf(self, g: float, h: float) -> float:
        """Newton step of a leaf."""
        return -self.learning_rate * g / (h + self.l2) if h + self.l2 > 0 else 0.0


# ------------------------------------------------------------------- bins

def _matrix_column(columns: Sequence[str]) -> Column:
    """Features as one array; null and NaN count as smallest."""
    low = F.lit(float("-inf"))
    value = [F.coalesce(F.col(c).cast("double"), low) for c in columns]
    return F.array(*[F.when(F.isnan(v), low).otherwise(v) for v in value])


def bin_cuts(df: DataFrame, columns: Sequence[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cuts of every feature: a value at most the b-th cut lies in one of the first b + 1 bins.

    A feature of at most ``bins`` distinct values is cut half-way between neighbours, any other one at
    its (sketched) quantiles.
    """
    if not columns:
        return []
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    steps = [k / bins for k in range(1, bins)]
    seen = df.agg(*[F.approx_count_distinct(value[c]).alias(f"f{i}") for i, c in enumerate(columns)]).first()
    # few by count (the estimate is off by some per cent): their distinct values are a bounded set
    few = [i for i in range(len(columns)) if seen[i] <= 1.5 * bins]
    sets = df.agg(*[F.collect_set(value[columns[i]]).alias(f"f{i}") for i in few]).first() if few else ()
    exact = {i: sorted(s) for i, s in zip(few, sets, strict=True) if len(s) <= bins}
    # only features of many values need a sketch of their quantiles
    rest = [i for i in range(len(columns)) if i not in exact]
    # sketches of a few features a job: their last merge takes one task
    parts = [rest[k:k + SKETCHED] for k in range(0, len(rest), SKETCHED)]
    sketch = lambda part: df.agg(*[F.percentile_approx(value[columns[i]], steps, _QUANTILE_ACCURACY).alias(f"f{i}") for i in part]).first()
    found = together([partial(sketch, part) for part in parts])
    quantiles = {i: q for part, row in zip(parts, found, strict=True) for i, q in zip(part, row, strict=True)}
    out = []
    for i in range(len(columns)):
        if i in exact:
            v = np.array(exact[i], dtype=np.float64)
            cuts = v[:-1] + (v[1:] - v[:-1]) / 2
            cuts = np.where(np.isfinite(cuts), cuts, v[:-1])
        else:
            cuts = np.unique(np.array(quantiles[i], dtype=np.float64))
        out.append(cuts)
    return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= CHUNK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _lists(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


#: A row of the written table is a block of up to ``CHUNK_ROWS`` training rows: labels, weights and scores by
#: booster, bins by feature, each as the bytes of its array.
_BLOCK = "label binary, weights binary, bins binary, scores binary"


def _block(label: np.ndarray, weights: np.ndarray, bins: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    parts = (label, weights, bins, scores)
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["label", "weights", "bins", "scores"])


def _blocks(batches: Iterator[pa.RecordBatch], many: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Labels, weights (boosters x rows), bins (features x rows) and scores (boosters x rows) of every block."""
    for b in batches:
        for k in range(b.num_rows):
            label, weights, bins, scores = (np.frombuffer(b.column(c)[k].as_buffer(), dtype=d) for c, d in enumerate((np.float64, np.float64, np.uint8, np.float64)))
            yield label, weights.reshape(many, -1), bins.reshape(width, -1), scores.reshape(many, -1)


def _binned(df: DataFrame, columns: Sequence[str], label: str, boosters: Sequence[Booster], cuts: list[np.ndarray], starts: list[float]) -> DataFrame:
    """Blocks (label, weights, bins, scores) of the rows that some booster uses."""
    width, many = len(columns), len(boosters)
    weights = F.array(*[F.coalesce(F.col(b.weight).cast("double"), F.lit(0.0)) for b in boosters])
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), weights.alias("weights"), _matrix_column(columns).alias("x"))
    rows = rows.where(F.exists("weights", lambda w: w > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _batches(batches):
            x = _lists(t["x"], width)
            bins = np.empty((width, len(x)), dtype=np.uint8)
            for f in range(width):
                bins[f] = np.searchsorted(cuts[f], x[:, f], side="left")
            scores = np.repeat(np.array(starts, dtype=np.float64), len(x))
            yield _block(t["label"].to_numpy(), np.ascontiguousarray(_lists(t["weights"], many).T), bins, scores)

    return rows.mapInArrow(run, _BLOCK)


# ------------------------------------------------------------------ trees

@dataclass
class Tree:
    """Nodes as arrays: a row goes left where its value is at most the threshold; a leaf has no left child."""
    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def leaves(self, x: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Leaf of every row of ``x`` (bins with ``cut`` = bin, raw values with ``cut`` = threshold)."""
        node = np.zeros(len(x), dtype=np.int32)
        open_ = [(0, np.arange(len(x)))]
        while open_:        # a node's rows at a time: long chains of splits cost one comparison a row and level
            k, rows = open_.pop()
            if self.left[k] < 0:
                node[rows] = k
            elif len(rows):
                left = x[rows, self.feature[k]] <= cut[k]
                open_ += [(int(self.left[k]), rows[left]), (int(self.right[k]), rows[~left])]
        return node

    def path(self, k: int) -> list[tuple[int, int, int]]:
        """(feature, low, high) of node ``k``: its rows are those whose bins are above low and at most high."""
        up = {int(c): (n, right) for n in range(len(self.left)) if self.left[n] >= 0 for right, c in enumerate((self.left[n], self.right[n]))}
        box: dict[int, list[int]] = {}
        while k:
            k, right = up[k]
            low_high = box.setdefault(int(self.feature[k]), [-1, MAX_BINS])
            low_high[not right] = (max if right else min)(low_high[not right], int(self.bin[k]))
        return [(f, low, high) for f, (low, high) in box.items()]


def best_split(hist: np.ndarray, b: Booster, depth: int) -> tuple[np.ndarray, float, int, int]:
    """Sums of a node (gradient, hessian, rows), and gain, feature and bin of its best split (-1: none)."""
    total = hist[:, 0, :].sum(axis=1) if hist.shape[1] else np.zeros(3)
    if hist.shape[2] < 2 or not hist.shape[1] or (b.max_depth is not None and depth >= b.max_depth):
        return total, 0.0, -1, -1
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    least = max(b.min_rows, 1)
    enough = (left[2] >= least) & (total[2] - left[2] >= least) & (left[1] >= b.min_hessian) & (total[1] - left[1] >= b.min_hessian)
    at = np.flatnonzero(enough)
    if not len(at):
        return total, 0.0, -1, -1
    lg, lh = left[0][enough], left[1][enough]       # gains only where a split may be
    rg, rh = total[0] - lg, total[1] - lh
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = lg ** 2 / (lh + b.l2) + rg ** 2 / (rh + b.l2) - total[0] ** 2 / (total[1] + b.l2)
    k = int(gain.argmax())
    best = float(gain[k])
    return (total, best, *divmod(int(at[k]), left.shape[2])) if best > 1e-12 else (total, 0.0, -1, -1)


def histogram(bins: np.ndarray, g: np.ndarray, h: np.ndarray, size: int, slot: np.ndarray | None = None, slots: int = 1) -> np.ndarray:
    """Sums of gradient, hessian and rows by (slot and) feature and bin: 3 x slots x features x size."""
    out = np.empty((3, slots, bins.shape[1], size))
    steps = np.empty(len(g), dtype=np.complex128)       # both sums in one walk over the rows
    steps.real, steps.imag = g, h
    many = max(1, HISTOGRAM_CELLS // max(len(g), 1))    # of few rows, several features at a time
    for f in range(0, bins.shape[1], many):
        at = bins[:, f:f + many].T.astype(np.intp)
        m, length = len(at), len(at) * slots * size
        if slot is not None:
            at += slot * size
        at = (at + np.arange(m)[:, None] * (slots * size)).ravel() if m > 1 else at[0]
        sums = np.zeros(length, dtype=np.complex128)
        np.add.at(sums, at, np.tile(steps, m) if m > 1 else steps)
        for part, found in enumerate((sums.real, sums.imag, np.bincount(at, minlength=length))):
            out[part, :, f:f + m] = found.reshape(m, slots, size).swapaxes(0, 1)
    return out


def _steps(label: np.ndarray, weight: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the logistic loss."""
    p = 1 / (1 + np.exp(-raw))
    return weight * (p - label), weight * p * (1 - p)


def grow_rows(bins: np.ndarray, g: np.ndarray, h: np.ndarray, b: Booster, depth: int, size: int, ends: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """The nodes that best-first order can take below a node with these rows, the node itself first: rows of
    feature, bin, left, right, gain, gradient, hessian, rows.  ``ends`` takes the rows of the nodes left whole."""
    limit = b.max_leaves - 1 if b.max_leaves else 1 << 30
    by_feature = np.ascontiguousarray(bins.T)
    nodes: list[list[float]] = []
    held: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
    heap: list[tuple[float, int]] = []

    def put(rows: np.ndarray, hist: np.ndarray, depth: int) -> int:
        total, gain, feature, bin_ = best_split(hist, b, depth)
        nodes.append([feature, bin_, -1, -1, gain, *total])
        if ends is not None:
            ends[len(nodes) - 1] = rows
        if feature >= 0:
            held[len(nodes) - 1] = (rows, hist, depth)
            heapq.heappush(heap, (-gain, len(nodes) - 1))
        return len(nodes) - 1

    put(np.arange(len(bins)), histogram(bins, g, h, size)[:, 0], depth)
    while heap and limit > 0:
        k = heapq.heappop(heap)[1]
        rows, hist, at = held.pop(k)
        if ends is not None:
            del ends[k]
        left = by_feature[int(nodes[k][0])][rows] <= nodes[k][1]
        parts = [rows[left], rows[~left]]
        small = int(len(parts[1]) < len(parts[0]))
        r = parts[small]
        # children that are not split any more need their totals only, which one feature gives
        some = slice(1) if limit == 1 or (b.max_depth is not None and at + 1 >= b.max_depth) else slice(None)
        part = histogram(np.take(by_feature[some], r, axis=1).T, g[r], h[r], size)[:, 0]
        sums = [part, hist[:, some] - part] if small == 0 else [hist[:, some] - part, part]
        nodes[k][2] = put(parts[0], sums[0], at + 1)
        nodes[k][3] = put(parts[1], sums[1], at + 1)
        limit -= 1
    return np.array(nodes, dtype=np.float64)


@dataclass
class _Node:
    depth: int
    count: float                        # its rows
    hist: np.ndarray | None = None      # gradient, hessian and rows by feature and bin
    total: np.ndarray | None = None
    gain: float = 0.0
    feature: int = -1
    bin: int = -1
    left: int = -1
    right: int = -1


class Grower:
    """One tree on its way: which nodes to sum or to grow in one task next, and the finished tree."""

    def __init__(self, booster: Booster, cuts: list[np.ndarray], rows: int, local_rows: int = LOCAL_ROWS):
        self.b, self.cuts, self.local_rows = booster, cuts, local_rows
        self.limit = booster.max_leaves or 1 << 30
        self.nodes = [_Node(0, rows)]
        self.split: list[tuple[int, int, int]] = []     # nodes whose larger child is the rest of the smaller
        self.summed, self.grown = ([], [0]) if rows <= local_rows else ([0], [])
        self.accepted: set[int] = set()

    def _attach(self, k: int, found: np.ndarray) -> None:
        place = [k] + [len(self.nodes) + i for i in range(len(found) - 1)]
        depth = {0: self.nodes[k].depth}
        self.nodes += [_Node(0, 0) for _ in range(len(found) - 1)]
        for i, (feature, bin_, left, right, gain, *total) in enumerate(found):
            node = self.nodes[place[i]]
            node.depth, node.feature, node.bin, node.gain, node.total, node.count = depth[i], int(feature), int(bin_), float(gain), np.array(total), total[2]
            if left >= 0:
                node.left, node.right = place[int(left)], place[int(right)]
                depth[int(left)] = depth[int(right)] = depth[i] + 1

    def absorb(self, sums: dict[int, np.ndarray], grown: dict[int, np.ndarray]) -> bool:
        """Take what was asked for; whether the tree is finished, else ``summed`` and ``grown`` are set anew."""
        for k in self.summed:
            self.nodes[k].hist = sums[k]
        for k, small, big in self.split:
            if self.nodes[big].count > self.local_rows:
                self.nodes[big].hist = self.nodes[k].hist - self.nodes[small].hist
            self.nodes[k].hist = None
        for k in self.grown:
            self.nodes[k].hist = None
            self._attach(k, grown[k])
        for node in self.nodes:
            if node.hist is not None and node.total is None:
                node.total, node.gain, node.feature, node.bin = best_split(node.hist, self.b, node.depth)
        self.split, self.summed, self.grown = [], [], []
        self._replay()
        return not (self.summed or self.grown)

    def _replay(self) -> None:
        """Split in order of gain as far as the children are known, and ask for what leads further."""
        self.accepted, leaves = set(), 1
        heap = [(-self.nodes[0].gain, 0)] if self.nodes[0].feature >= 0 else []
        while heap and leaves < self.limit:
            k = heap[0][1]
            if self.nodes[k].left < 0:
                break
            heapq.heappop(heap)
            self.accepted.add(k)
            leaves += 1
            for c in (self.nodes[k].left, self.nodes[k].right):
                if self.nodes[c].feature >= 0:
                    heapq.heappush(heap, (-self.nodes[c].gain, c))
        if not heap or leaves >= self.limit:
            return
        # no more than the open number of splits can still be taken, so only the best so many matter
        for _, k in heapq.nsmallest(min(len(heap), self.limit - leaves), heap):
            node = self.nodes[k]
            if node.left >= 0 or node.hist is None:
                continue
            node.left, node.right = len(self.nodes), len(self.nodes) + 1
            by_bin = node.hist[2, node.feature]
            below = float(by_bin[:node.bin + 1].sum())
            self.nodes += [_Node(node.depth + 1, below), _Node(node.depth + 1, float(by_bin.sum()) - below)]
            small, big = sorted((node.left, node.right), key=lambda c: self.nodes[c].count)
            self.split.append((k, small, big))
            if self.nodes[big].count > self.local_rows:
                self.summed.append(small)
            self.grown += [c for c in (small, big) if self.nodes[c].count <= self.local_rows]

    def shape(self) -> Tree:
        """The tree as far as it is split, for dealing rows to nodes."""
        n = self.nodes
        a = lambda name, t: np.array([getattr(x, name) for x in n], dtype=t)
        none = np.zeros(0)
        return Tree(np.maximum(a("feature", np.int64), 0), a("bin", np.int64), none, a("left", np.int32), a("right", np.int32), none, none, none)

    def tree(self) -> Tree:
        number, order = {0: 0}, [0]
        for k in order:
            if k in self.accepted:
                for c in (self.nodes[k].left, self.nodes[k].right):
                    number[c] = len(order)
                    order.append(c)
        rows = []
        for k in order:
            x = self.nodes[k]
            g, h, n = x.total
            if k in self.accepted:
                rows.append((x.feature, x.bin, float(self.cuts[x.feature][x.bin]), number[x.left], number[x.right], 0.0, x.gain, n))
            else:
                rows.append((0, 0, 0.0, -1, -1, self.b.leaf(g, h), 0.0, n))
        c = list(zip(*rows, strict=True))
        return Tree(np.array(c[0], dtype=np.int64), np.array(c[1], dtype=np.int64), np.array(c[2], dtype=np.float64), np.array(c[3], dtype=np.int32),
                    np.array(c[4], dtype=np.int32), *[np.array(v, dtype=np.float64) for v in c[5:]])


def grow_trees(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, raw: np.ndarray, b: Booster, size: int, trees: int) -> list[np.ndarray]:
    """The nodes (as ``grow_rows`` gives them) of as many trees, each grown on the scores that those before it leave."""
    raw, out = raw.copy(), []
    for _ in range(trees):
        ends: dict[int, np.ndarray] = {}
        out.append(grow_rows(bins, *_steps(label, weight, raw), b, 0, size, ends))
        for k, rows in ends.items():
            raw[rows] += b.leaf(*out[-1][k, 5:7])
    return out


def grown_tree(found: np.ndarray, b: Booster, cuts: list[np.ndarray]) -> Tree:
    """The tree whose root was grown with all of its rows."""
    grower = Grower(b, cuts, 0)
    grower.absorb({}, {0: found})
    return grower.tree()


_PART = "slot int, tree int, sums binary, bins binary, steps binary"


def _pass(rows: DataFrame, boosters: Sequence[Booster], fresh: list[list[Tree]], growers: dict[int, Grower], width: int, size: int,
          trees: dict[int, int]) -> dict[int, tuple[dict, dict, list]]:
    """Histograms and grown nodes that every growing tree has asked for, and the nodes of the trees after it,
    up to ``trees`` in all, of a booster whose root is grown in one task.

    Tasks send each node's histogram of their rows, or the rows themselves, to the task that adds or grows
    it; the driver gets a histogram or the grown nodes of each.
    """
    slots, plan = {}, []
    for i, g in growers.items():
        for k, grow in [*((k, False) for k in g.summed), *((k, True) for k in g.grown)]:
            slots[i, k, grow] = len(plan)
            plan.append((i, k, grow, g.nodes[k].depth, trees[i] if grow and k == 0 else 1))
    shapes = {i: g.shape() for i, g in growers.items()}
    paths = [shapes[i].path(k) for i, k, *_ in plan]
    many, few = len(boosters), 24 * width * size // (width + 16)
    shared = rows.sparkSession.sparkContext.broadcast((fresh, paths, plan, list(boosters)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, paths, plan = shared.value[:3]
        sums: dict[int, np.ndarray] = {}
        for label, weights, bins, scores in _blocks(batches, many, width):
            out = []
            # the rows of a wanted node by its path: no other node's rows are looked at
            for s, (i, _, grow, _, ahead) in enumerate(plan):
                mine = weights[i] > 0
                for f, low, high in paths[s]:
                    if low >= 0:
                        mine &= bins[f] > low
                    if high < MAX_BINS:
                        mine &= bins[f] <= high
                r = np.flatnonzero(mine)
                if not len(r):
                    continue
                x, y, w, raw = np.take(bins, r, axis=1).T, label[r], weights[i, r], scores[i, r]
                for tree in fresh[i]:
                    raw += tree.value[tree.leaves(x, tree.bin)]
                if ahead > 1:
                    out.append((s, None, None, x.T.tobytes(), np.concatenate([y, w, raw]).tobytes()))
                    continue
                g, h = _steps(y, w, raw)
                if grow or len(r) < few:     # few rows are less to send than their histogram
                    out.append((s, None, None, x.T.tobytes(), np.concatenate([g, h]).tobytes()))
                else:
                    part = histogram(x, g, h, size)[:, 0]
                    sums[s] = sums[s] + part if s in sums else part
            if out:
                yield _rows(out)
        yield _rows([(s, 0, v.tobytes(), None, None) for s, v in sums.items()])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, boosters = shared.value[2:]
        sums: dict[int, np.ndarray] = {}
        held: dict[int, list] = {}
        for b in batches:
            for s, total, bins, steps in zip(*(b.column(c).to_pylist() for c in (0, 2, 3, 4)), strict=True):
                if total is None:
                    x = np.frombuffer(bins, dtype=np.uint8).reshape(width, -1)
                    steps = np.frombuffer(steps, dtype=np.float64).reshape(-1, x.shape[1])
                    if plan[s][2]:
                        held.setdefault(s, []).append((x, steps))
                        continue
                    part = histogram(x.T, *steps, size).ravel()
                else:
                    part = np.frombuffer(total, dtype=np.float64)
                sums[s] = sums[s] + part if s in sums else part
        out = [(s, 0, v.tobytes(), None, None) for s, v in sums.items()]
        for s in list(held):
            i, _, _, depth, ahead = plan[s]
            parts = held.pop(s)
            bins, steps = np.concatenate([p[0] for p in parts], axis=1).T, np.concatenate([p[1] for p in parts], axis=1)
            if ahead > 1:
                grown = grow_trees(bins, *steps, boosters[i], size, ahead)
            else:
                grown = [grow_rows(bins, *steps, boosters[i], depth, size)]
            out += [(s, n, found.tobytes(), None, None) for n, found in enumerate(grown)]
        yield _rows(out)

    deal = min(len(plan), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = rows.mapInArrow(send, _PART).repartition(deal, "slot").mapInArrow(finish, _PART)
    got = {(r["slot"], r["tree"]): np.frombuffer(r["sums"], dtype=np.float64) for r in parts.select("slot", "tree", "sums").collect()}
    answers: dict[int, tuple[dict, dict, list]] = {i: ({}, {}, []) for i in growers}
    for s, (i, k, grow, _, ahead) in enumerate(plan):
        if grow:
            answers[i][1][k] = got[s, 0].reshape(-1, 8) if (s, 0) in got else np.array([[-1, -1, -1, -1, 0, 0, 0, 0]], dtype=np.float64)
            answers[i][2].extend(got[s, n].reshape(-1, 8) for n in range(1, ahead) if (s, n) in got)
        else:
            answers[i][0][k] = got[s, 0].reshape(3, width, size) if (s, 0) in got else np.zeros((3, width, size))
    return answers


def _rows(out: list[tuple]) -> pa.RecordBatch:
    column = lambda c, kind: pa.array([r[c] for r in out], kind)
    return pa.RecordBatch.from_arrays([column(0, pa.int32()), column(1, pa.int32()), *(column(c, pa.binary()) for c in (2, 3, 4))],
                                      names=["slot", "tree", "sums", "bins", "steps"])


def _rescored(rows: DataFrame, many: int, width: int, fresh: list[list[Tree]]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(fresh)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, weights, bins, scores in _blocks(batches, many, width):
            scores = scores.copy()
            for i, trees in enumerate(shared.value):
                for tree in trees:
                    scores[i] += tree.value[tree.leaves(bins.T, tree.bin)]
            yield _block(label, weights, bins, scores)

    return rows.mapInArrow(run, _BLOCK)


# --------------------------------------------------------------- ensembles

_NODES = "tree int, node int, feature string, threshold double, left int, right int, value double, gain double, rows double"


@dataclass
class TreeEnsemble:
    """Fitted booster: the probability of class 1 is the logistic of ``start`` plus its leaves' values."""
    feature_columns: list[str]
    start: float
    trees: list[Tree] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += t.value[t.leaves(x, t.threshold)]
        return out

    def transform(self, df: DataFrame, out: str = "fraud_probability") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)
        width = len(self.feature_columns)

        @F.pandas_udf("double")
        def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in parts:
                matrix = np.array(x.tolist(), dtype=np.float64).reshape(len(x), width)
                yield pd.Series(1 / (1 + np.exp(-shared.value.raw(matrix))))

        return df.withColumn(out, probability(_matrix_column(self.feature_columns)))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The trees as a table, a row for each node; leaves have no feature."""
        rows = []
        for k, t in enumerate(self.trees):
            for n in range(len(t.left)):
                leaf = t.left[n] < 0
                rows.append((k, n, None if leaf else self.feature_columns[t.feature[n]], None if leaf else float(t.threshold[n]),
                             None if leaf else int(t.left[n]), None if leaf else int(t.right[n]), float(t.value[n]), float(t.gain[n]), float(t.rows[n])))
        return spark.createDataFrame(rows, _NODES)

    def save(self, path: str, spark: SparkSession) -> None:
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.start, self.feature_columns)], "start double, feature_columns array<string>").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeEnsemble:
        meta = spark.read.parquet(f"{path}/meta").first()
        return cls.from_nodes(spark.read.parquet(f"{path}/nodes"), meta["feature_columns"], meta["start"])

    @classmethod
    def from_nodes(cls, nodes: DataFrame, feature_columns: Sequence[str], start: float = 0.0) -> TreeEnsemble:
        """The ensemble of a node table (a model's own size: trees x leaves)."""
        place = {c: i for i, c in enumerate(feature_columns)}
        trees = []
        for _, t in nodes.toPandas().sort_values(["tree", "node"]).groupby("tree", sort=True):
            inner = t["feature"].notna().to_numpy()
            f = np.array([place[c] if i else 0 for c, i in zip(t["feature"], inner, strict=True)], dtype=np.int64)
            child = lambda c, t=t, inner=inner: np.where(inner, t[c].fillna(-1), -1).astype(np.int32)
            trees.append(Tree(f, np.zeros(len(t), dtype=np.int64), t["threshold"].fillna(0.0).to_numpy(), child("left"), child("right"),
                              t["value"].to_numpy(), t["gain"].to_numpy(), t["rows"].to_numpy()))
        return cls(list(feature_columns), float(start), trees)


def importance(nodes: DataFrame) -> DataFrame:
    """(feature, splits, gain) of a node table, most splits first."""
    inner = nodes.where(F.col("feature").isNotNull())
    return inner.groupBy("feature").agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain")).orderBy(F.desc("splits"), F.desc("gain"), "feature")


# -------------------------------------------------------------------- fit

def fit_boosters(train: DataFrame, feature_columns: Sequence[str], label: str, boosters: Sequence[Booster], bins: int = MAX_BINS,
                 write_every: int = WRITE_EVERY, local_rows: int | None = None) -> dict[str, TreeEnsemble]:
    """Fit several boosters in the same passes over ``train``; rows without a label take no part."""
    columns, many, width = list(feature_columns), len(boosters), len(feature_columns)
    weights = [F.when(F.col(label).isNotNull(), F.coalesce(F.col(b.weight).cast("double"), F.lit(0.0))).otherwise(0.0) for b in boosters]
    seen = train.agg(*[F.struct(F.sum(w).alias("w"), F.sum(w * F.col(label).cast("double")).alias("y"), F.count_if(w > 0).alias("n")).alias(f"b{i}")
                       for i, w in enumerate(weights)]).first()
    starts = []
    for b, s in zip(boosters, seen, strict=True):
        mean = min(max((s["y"] or 0.0) / s["w"], 1e-12), 1 - 1e-12) if s["w"] else 0.5
        starts.append(b.start if b.start is not None else float(np.log(mean / (1 - mean))))
    cuts = bin_cuts(train, columns, bins)
    size = max(map(len, cuts), default=0) + 1
    if local_rows is None:
        local_rows = min(LOCAL_ROWS, LOCAL_BYTES // (width + 16))
    rows = materialize(_binned(train, columns, label, boosters, cuts, starts), "boost_rows")
    fitted: list[list[Tree]] = [[] for _ in boosters]
    written = [0] * many
    begin = lambda i: Grower(boosters[i], cuts, seen[i]["n"], local_rows)
    growers = {i: begin(i) for i, b in enumerate(boosters) if b.trees > 0 and width}
    while growers:
        ahead = {i: min(LOCAL_TREES, boosters[i].trees - len(fitted[i])) if fitted[i] else 1 for i in growers}
        answers = _pass(rows, boosters, [trees[w:] for trees, w in zip(fitted, written, strict=True)], growers, width, size, ahead)
        for i in list(growers):
            sums, grown, after = answers[i]
            if growers[i].absorb(sums, grown):
                fitted[i] += [growers[i].tree(), *(grown_tree(found, boosters[i], cuts) for found in after)]
                if len(fitted[i]) < boosters[i].trees:
                    growers[i] = begin(i)
                else:
                    del growers[i]
        if growers and max(len(fitted[i]) - written[i] for i in growers) >= write_every:
            rows = materialize(_rescored(rows, many, width, [t[w:] for t, w in zip(fitted, written, strict=True)]), "boost_rows")
            written = [len(t) for t in fitted]
    return {b.name: TreeEnsemble(columns, s, t) for b, s, t in zip(boosters, starts, fitted, strict=True)}
