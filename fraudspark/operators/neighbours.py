"""Exact nearest neighbours over a pivot index.

A bounded sample of the vectors are the pivots; every vector belongs to the cell of its nearest pivot and
knows its distance to it.  The vectors are written once in order of (cell, distance), so a cell of many
vectors is spread over many tasks.  Queries are the same vectors, taken in that order in chunks of
``chunk_bytes``, which are broadcast: the vectors themselves are shuffled once, by the ordering.

By the triangle inequality a query at distance d from a pivot has its neighbours within r only among
vectors of that cell whose own distance lies between d - r and d + r.  The k-th distance within the
query's own cell gives the first r (a cell of fewer vectors: the best sum of a distance to a pivot and that
pivot's k-th distance); a second scan, which reads only cells that some query of the chunk can
reach (by the distances of pivots), finds the rest, and r shrinks as neighbours are found.  Pivots are numbered by halving
them again and again where they spread most, so a chunk's queries lie close together and few cells are in their
reach; of a cell's chunk only the queries of cells in reach by their pivots are looked at.  Tasks measure a
chunk's distances to the pivots of the cells they hold, so a chunk is as many queries as its vectors fill.  A matrix product measures what is left with
a margin for its rounding, and pairs within the margin are measured exactly.  Tasks hand on k pairs of
numbers for each query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, together
from .ordering import with_row_index

#: Bytes of the pivots, and of the queries of one chunk (vectors and a few numbers each).
PIVOT_BYTES, MAX_PIVOTS = 16 << 20, 4_096
#: Vectors of a cell, as far as there are pivots for so many cells.
CELL_ROWS = 128
CHUNK_BYTES = 32 << 20
#: Chunks under way at a time: the cells of one chunk are few tasks, and its queries come to the driver meanwhile.
CHUNKS_AT_ONCE = 4
#: Distances that a task measures at a time.
TILE = 1 << 19


class Nearest:
    """The ``k`` nearest (distance, number) of many queries."""

    def __init__(self, queries: int, k: int, reach: np.ndarray):
        self.k, self.reach = k, reach.copy()
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, query: np.ndarray, distance: np.ndarray, other: np.ndarray) -> None:
        keep = distance <= self.reach[query]
        if keep.any():
            self.parts.append((query[keep], distance[keep], other[keep]))
            self.held += int(keep.sum())
            if self.held > 4 * self.k * len(self.reach) + 100_000:
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        query, distance, other = (np.concatenate(p) for p in zip(*self.parts, strict=True))
        order = np.lexsort((other, distance, query))
        query, distance, other = query[order], distance[order], other[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        full = place == self.k - 1
        self.reach[query[full]] = np.minimum(self.reach[query[full]], distance[full])
        keep = place < self.k
        self.parts, self.held = [(query[keep], distance[keep], other[keep])], int(keep.sum())
        return self.parts[0]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs by a matrix product, up to rounding."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T), 0)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each pair of rows, summed in order of the components."""
    out = np.zeros(len(a))
    for c in range(a.shape[1]):
        out += (a[:, c] - b[:, c]) ** 2
    return np.sqrt(out)


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(_squares(x, pivots))


def _margin(scale, dim: int):
    """What the rounding of a matrix product can hide of a distance between vectors not longer than ``scale``."""
    return scale * (16 * np.finfo(np.float64).eps * max(dim, 1)) ** 0.5


def _near_order(x: np.ndarray) -> np.ndarray:
    """The rows ordered so that those near each other stand together: halves along the widest component."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        spread = np.ptp(x[rows], axis=0) if len(rows) > 2 else np.zeros(0)
        if not spread.any():
            out.append(rows)
            continue
        rows = rows[np.argsort(x[rows, spread.argmax()], kind="stable")]
        todo += [rows[len(rows) // 2:], rows[:len(rows) // 2]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _indexed(nodes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(_rn, _x, _cell, _d): the nearest pivot of every vector and the distance to it."""
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.array(b["_x"].tolist(), dtype=np.float64)
                step = max(1, TILE // len(shared.value))
                near = [_to_pivots(x[a:a + step], shared.value) for a in range(0, len(x), step)]
                b["_cell"] = np.concatenate([d.argmin(axis=1) for d in near]).astype(np.int32)
                b["_d"] = np.concatenate([d.min(axis=1) for d in near])
            else:
                b["_cell"], b["_d"] = np.zeros(0, np.int32), np.zeros(0)
            yield b[["_rn", "_x", "_cell", "_d"]]

    return nodes.select("_rn", "_x").mapInPandas(run, "_rn long, _x array<double>, _cell int, _d double")


def _scan(points: DataFrame, queries: tuple, k: int, own_cell: bool) -> DataFrame:
    """(_q, _other, _dd): the k nearest others of each query within its reach, from every task."""
    shared = points.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, number, cell, own, reach, margin, pivots = shared.value
        best = Nearest(len(x), k, reach)
        squares, last, between = (x * x).sum(axis=1), -1, np.zeros(0)
        # queries come in order of their cells: those of one cell, and how far they can reach from its pivot
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[:len(cell)]
        homes, many = cell[first], np.diff(np.r_[first, len(cell)])
        wide = np.maximum.reduceat(reach + own + 2 * margin, first) if len(first) else np.zeros(0)
        for b in batches:
            cells, d, other = b["_cell"].to_numpy(), b["_d"].to_numpy(), b["_rn"].to_numpy()
            starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])[:len(cells)]
            for a, end in zip(starts, np.r_[starts[1:], len(cells)], strict=False):
                j = cells[a]
                if own_cell:
                    mine = np.arange(*np.searchsorted(cell, [j, j + 1]))
                    to = _to_pivots(x[mine], pivots[j:j + 1])[:, 0]
                else:
                    if j != last:       # rows come in order of the cell
                        last, between = j, _to_pivots(pivots[homes], pivots[j:j + 1])[:, 0]
                    near_home = (between - wide <= d[a:end].max() + margin) & (between + wide >= d[a:end].min() - margin)
                    here = np.flatnonzero(np.repeat(near_home, many))
                    to_pivot = np.sqrt(np.maximum(squares[here] + (pivots[j] * pivots[j]).sum() - 2 * (x[here] @ pivots[j]), 0))
                    ring = best.reach[here] + margin
                    kept = (to_pivot >= d[a:end].min() - ring) & (to_pivot <= d[a:end].max() + ring)
                    mine, to = here[kept], to_pivot[kept]
                if not len(mine):
                    continue
                points_ = np.array(b["_x"].iloc[a:end].tolist(), dtype=np.float64)
                near = points_ - pivots[j]  # short vectors keep the product's rounding small
                lengths = (near * near).sum(axis=1)
                longest, one = np.sqrt(lengths.max()), np.ones((len(near), 1))
                right = np.concatenate([near, one, lengths[:, None]], axis=1).T
                step = max(1, TILE // len(points_))
                for m in range(0, len(mine), step):
                    q = mine[m:m + step]
                    slack = _margin(to[m:m + step] + margin + longest, x.shape[1])
                    left = x[q] - pivots[j]
                    # squared distances as one product: -2 a b + a a + b b
                    left = np.concatenate([-2 * left, (left * left).sum(axis=1)[:, None], np.ones((len(q), 1))], axis=1)
                    row, at = np.divmod(np.flatnonzero(left @ right <= ((best.reach[q] + slack) ** 2)[:, None]), len(near))
                    same = number[q[row]] == other[a + at]
                    row, at = row[~same], at[~same]
                    for part in range(0, len(row), TILE):
                        r, p = row[part:part + TILE], at[part:part + TILE]
                        best.add(q[r], _distances(x[q[r]], points_[p]), other[a + p])
                if best.held > 4 * k * len(x):
                    best.cut()
        query, distance, found = best.cut()
        yield pd.DataFrame({"_q": number[query], "_other": found, "_dd": distance})

    parts = points.select("_rn", "_x", "_cell", "_d").mapInPandas(run, "_q long, _other long, _dd double")
    order = Window.partitionBy("_q").orderBy("_dd", "_other")  # at most k rows of each task
    return parts.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).drop("_place")


def node_neighbours(nodes: DataFrame, k: int, chunk_bytes: int = CHUNK_BYTES, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """The k nearest other vectors of every distinct vector (_node, _x): ``(_node, _other, _dd)``, ties by
    ``_node``."""
    spark = nodes.sparkSession
    named, n = with_row_index(nodes, ["_node"], name="_rn")
    named = materialize(named, "knn_named")
    ids = named.select("_rn", "_node")
    kind = nodes.schema["_node"].dataType.simpleString()
    if n < 2:
        return spark.createDataFrame([], f"_node {kind}, _other {kind}, _dd double")
    seen = named.agg(F.max(F.size("_x")).alias("dim"), F.max(F.sqrt(F.aggregate("_x", F.lit(0.0), lambda acc, v: acc + v * v))).alias("scale")).first()
    dim, margin = seen["dim"], _margin(2 * seen["scale"], seen["dim"])
    many = int(max(1, min(max_pivots, PIVOT_BYTES // (8 * max(dim, 1)), max(n ** 0.5, n / CELL_ROWS))))
    pivots = np.array([r["_x"] for r in named.orderBy(F.xxhash64("_rn"), "_rn").limit(many).collect()], dtype=np.float64).reshape(many, dim)
    pivots = pivots[_near_order(pivots)]
    index, _ = with_row_index(_indexed(named, pivots), ["_cell", "_d", "_rn"], name="_at")
    index = materialize(index, "knn_index")
    # k + 1 smallest distances of each cell (a row a pivot) bound every query's k-th distance
    near = Window.partitionBy("_cell").orderBy("_d")
    few = index.select("_cell", "_d").withColumn("_place", F.row_number().over(near)).where(F.col("_place") <= k + 1)
    cells = {r["_cell"]: (r["d"], r["far"]) for r in few.groupBy("_cell").agg(F.sort_array(F.collect_list("_d")).alias("d")).join(
        index.groupBy("_cell").agg(F.max("_d").alias("far")), "_cell").collect()}
    kth = np.array([cells[j][0][k] if j in cells and len(cells[j][0]) > k else np.inf for j in range(many)])
    farthest = np.array([cells[j][1] if j in cells else -np.inf for j in range(many)])
    between = _to_pivots(pivots, pivots)
    step = max(1, chunk_bytes // (8 * (dim + 8)))

    def answered(start: int) -> DataFrame:
        # at most chunk_bytes, as Arrow whatever the session's setting for toPandas
        chunk = index.where(F.col("_at").between(start, start + step - 1)).select("_rn", "_x", "_cell", "_d").toArrow()
        order = np.argsort(chunk["_cell"].to_numpy(), kind="stable")
        x = chunk["_x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(order), -1)[order]
        number, cell, d = (chunk[c].to_numpy()[order] for c in ("_rn", "_cell", "_d"))
        reach = d + kth[cell] + margin
        first = _scan(index.where(F.col("_cell").between(int(cell.min()), int(cell.max()))), (x, number, cell, d, reach, margin, pivots), k, True)
        own = first.groupBy("_q").agg(F.max("_dd").alias("r"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).toArrow()  # a row a query
        at = pd.Series(np.arange(len(number)), index=number)
        place = at[own["_q"].to_numpy()].to_numpy()
        reach[place] = np.minimum(reach[place], own["r"].to_numpy())
        short = np.flatnonzero(~np.isfinite(reach)) if np.isfinite(kth).any() else np.zeros(0, dtype=np.int64)
        for part in np.array_split(short, len(short) * many // TILE + 1):
            reach[part] = (_to_pivots(x[part], pivots) + kth).min(axis=1, initial=np.inf) + margin
        # a query of cell a is at least the distance of the pivots of a and j less its own from the pivot of j
        widest = np.full(many, -np.inf)
        np.maximum.at(widest, cell, d + reach + 2 * margin)
        here = np.flatnonzero(widest > -np.inf)
        wanted = np.flatnonzero((between[here] - widest[here, None] <= farthest + margin).any(axis=0) & (farthest > -np.inf))
        found = _scan(index.where(F.col("_cell").isin(wanted.tolist())), (x, number, cell, d, reach, margin, pivots), k, False)
        return materialize(found, "knn_found")

    parts = together([partial(answered, start) for start in range(1, n + 1, step)], CHUNKS_AT_ONCE)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.join(ids.select(F.col("_rn").alias("_q"), "_node"), "_q")
            .join(ids.select(F.col("_rn").alias("_other"), F.col("_node").alias("_o")), "_other").select("_node", F.col("_o").alias("_other"), "_dd"))
