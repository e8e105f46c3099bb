"""SimHash near-dedup by a self-join of binary tries.

Fingerprints: 64 majority bits over the XXH64 values (seed 42) of the word shingles of the whole
lower-cased text, repeats included.

Links: distinct fingerprints form a binary trie, bit by bit from the top.  The self-join walks pairs
of nodes of one depth together, starting from (root, root); a pair of children is kept while the
bits in which their paths differ stay within the error budget.  Two tries are joined, one over the
bits as they are and one with the halves exchanged: two fingerprints that differ in at most ``k``
bits differ in at most ``k // 2`` bits in one of the halves, so each walk may spend only ``k // 2``
errors on its upper half and the full budget below.  No pair within ``k`` bits is lost.

The walk is distributed.  Its top runs as joins of node tables (one row per trie node, with its
count): pairs of nodes are expanded until both hold few enough fingerprints for one task.  The
fingerprints below each surviving pair then meet in one task, which goes on level by level on
arrays.  A task emits a spanning forest, not all pairs: it raises the budget one bit at a time, and
skips a node pair whose fingerprints are all connected already, so a dense group of near copies
costs about one step per fingerprint.  Linked fingerprints become components over the whole table.

Defined results
    null text        counts as the empty text; no words give fingerprint zero, linked like any other
    few words        the whole sequence is the one shingle
    null doc_id      never the smallest id of a component that has another one
    repeated rows    share a fingerprint, so they share a component; each row is returned
    repeated ids     unlike texts under one id, or without id, are components of their own; ``dedup`` keeps a row of each
    ties             a bit is set in over half of the shingles, so an even split leaves it unset
    empty table      empty result
    extra columns    ignored by ``components_of``, kept by ``dedup`` whatever their names
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, lookup, materialize
from .components import components

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints on either side of a node pair that one task takes; larger nodes are split further.
NODE_ROWS = 100_000
#: Depth at which the distributed walk starts, and levels it descends at a time.
FIRST_DEPTH, STEP = 4, 4
#: A fingerprint of more than this share of the rows is joined by broadcast; there are at most 1/share.
HOT_SHARE = 1 / 2000
#: Shingles hashed at a time.
CHUNK = 1 << 20


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(tokens) - words + 1)
    last = ends[min(words, len(tokens)) - 1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, CHUNK):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(starts[k:min(n, k + CHUNK)].tolist(), last[k:k + CHUNK].tolist(), strict=False)], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(texts: pd.Series, words: int) -> pd.Series:
    return pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))


def with_fingerprint(documents: DataFrame, name: str, words: int = SHINGLE_WORDS, text_col: str = "text") -> DataFrame:
    """``documents`` with the fingerprint as a signed long in column ``name``."""
    def of(texts: pd.Series) -> pd.Series:
        return _fingerprints(texts, words)
    return documents.withColumn(name, F.pandas_udf(of, "long")(F.col(text_col)))


class _Forest:
    """Union-find over 0..n-1, by array passes."""

    def __init__(self, n: int):
        self.root = np.arange(n, dtype=np.int64)
        self.changed = True

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if not len(a):
                break
            self.changed = True
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:  # shorten every path to its root
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _ones(keys: np.ndarray, bit: int) -> np.ndarray:
    """Running count of keys with the bit set: in sorted keys, a node [lo, hi) turns from 0 to 1 at
    ``hi - (ones[hi] - ones[lo])``."""
    return np.concatenate(([0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int32)))


#: Node pairs expanded at a time; a wider frontier is cut in two and walked one part after the other.
FRONTIER = 1 << 20


def _walk(keys: np.ndarray, forest: _Forest, pairs: tuple, bit: int, budget: int, half: int) -> None:
    """Join the nodes ``pairs`` = (lo1, hi1, lo2, hi2, differing bits), whose next bit is ``bit``."""
    stack, ones, edge, forest.changed = [(*pairs, bit)], {}, None, True
    while stack:
        lo1, hi1, lo2, hi2, d, bit = stack.pop()
        # a pair whose fingerprints are all in one component has nothing left to link
        if forest.changed:
            edge, forest.changed = np.concatenate(([0], np.cumsum(forest.root[1:] != forest.root[:-1], dtype=np.int32))), False
        one = lambda lo, hi: edge[hi - 1] == edge[lo]
        done = one(lo1, hi1) & one(lo2, hi2) & (forest.root[lo1] == forest.root[lo2])
        go = ~done
        lo1, hi1, lo2, hi2, d = lo1[go], hi1[go], lo2[go], hi2[go], d[go]
        if not len(lo1):
            continue
        if len(lo1) > FRONTIER:
            m = len(lo1) // 2
            stack.append((lo1[m:], hi1[m:], lo2[m:], hi2[m:], d[m:], bit))
            stack.append((lo1[:m], hi1[:m], lo2[:m], hi2[:m], d[:m], bit))
            continue
        # single fingerprints need no further walk: compare them outright
        single = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        if single.any():
            a, b = lo1[single], lo2[single]
            near = (_popcount(keys[a] ^ keys[b]) <= budget) & (a != b)
            forest.link(a[near], b[near])
            lo1, hi1, lo2, hi2, d = (x[~single] for x in (lo1, hi1, lo2, hi2, d))
        if not len(lo1) or bit < 0:
            continue
        if bit not in ones:
            ones[bit] = _ones(keys, bit)
        turn = ones[bit]
        m1, m2, same = hi1 - (turn[hi1] - turn[lo1]), hi2 - (turn[hi2] - turn[lo2]), lo1 == lo2
        allowed = half if bit >= 32 else budget
        parts = []
        for x, y, cost in ((0, 0, 0), (1, 1, 0), (0, 1, 1), (1, 0, 1)):
            a1, b1 = (lo1, m1) if x == 0 else (m1, hi1)
            a2, b2 = (lo2, m2) if y == 0 else (m2, hi2)
            ok = (a1 < b1) & (a2 < b2) & (d + cost <= allowed)
            if (x, y) == (1, 0):
                ok &= ~same  # the mirror of (0, 1)
            parts.append((a1[ok], b1[ok], a2[ok], b2[ok], d[ok] + cost))
        stack.append((*(np.concatenate(c) for c in zip(*parts, strict=True)), bit - 1))


def join_nodes(keys: np.ndarray, side: np.ndarray, same: bool, depth: int, differing: int, budget: int, half: int) -> np.ndarray:
    """Root (an index) of every key: forest of the links between two trie nodes, or within one.

    ``keys`` unsigned and distinct; ``side`` 0 for the first node and 1 for the second; ``differing``
    is the count of bits in which the two paths to this ``depth`` differ.
    """
    order = np.lexsort((keys, side))
    keys = keys[order]
    forest = _Forest(len(keys))
    n1 = int((side == 0).sum())
    box = lambda *x: tuple(np.array([v], dtype=np.int64) for v in x)
    start = box(0, n1, 0, n1, differing) if same else box(0, n1, n1, len(keys), differing)
    if n1 and (same or n1 < len(keys)):
        for most in sorted({1, 2, budget}):  # near links first: what they connect is skipped later
            if differing <= most <= budget:
                _walk(keys, forest, start, 63 - depth, most, min(half, max(1, most // 2)))
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = order[forest.root]
    return out


def _prefix(key: str, depth: int):
    return F.shiftrightunsigned(F.col(key), 64 - depth)


def _node_pairs(keys: DataFrame, budget: int) -> list[tuple[int, DataFrame]]:
    """(depth, pairs v, u, w, d) of trie node pairs that are small enough for one task."""
    half = budget // 2
    out, depth = [], FIRST_DEPTH
    nodes = materialize(keys.groupBy("v", _prefix("key", depth).alias("u")).agg(F.count(F.lit(1)).alias("n")), "nodes")
    w = nodes.select("v", F.col("u").alias("w"), F.col("n").alias("m"))
    pairs = nodes.join(w, "v").filter("u <= w").withColumn("d", F.bit_count(F.col("u").bitwiseXOR(F.col("w")))).filter(F.col("d") <= half)
    while True:
        pairs = materialize(pairs, "node_pairs")
        large = (F.col("n") > NODE_ROWS) | (F.col("m") > NODE_ROWS)
        out.append((depth, pairs.filter(~large).select("v", "u", "w", "d")))
        rest = pairs.filter(large)
        if depth + STEP >= 60 or rest.isEmpty():  # below, a node holds at most 16 fingerprints
            return out
        open_ = rest.select("v", "u").unionByName(rest.select("v", F.col("w").alias("u"))).distinct()
        deeper = depth + STEP
        kids = materialize(keys.withColumn("u", _prefix("key", depth)).join(open_, ["v", "u"], "left_semi")
                           .groupBy("v", "u", _prefix("key", deeper).alias("c")).agg(F.count(F.lit(1)).alias("n")), "nodes")
        left = kids.select("v", "u", F.col("c").alias("cu"), F.col("n").alias("cn"))
        right = kids.select("v", F.col("u").alias("w"), F.col("c").alias("cw"), F.col("n").alias("cm"))
        pairs = (rest.join(left, ["v", "u"]).join(right, ["v", "w"]).filter("u <> w or cu <= cw")
                 .select("v", F.col("cu").alias("u"), F.col("cw").alias("w"), F.col("cn").alias("n"), F.col("cm").alias("m"),
                         F.bit_count(F.col("cu").bitwiseXOR(F.col("cw"))).alias("d"))
                 .filter(F.col("d") <= (half if deeper <= 32 else budget)))
        depth = deeper


def links(prints: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """(a, b): a spanning forest's edges of the pairs within ``budget`` bits; ``prints(fp)`` is distinct."""
    swapped = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    keys = prints.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col("fp").alias("key")),
                                                 F.struct(F.lit(1).alias("v"), swapped.alias("key")))).alias("x")).select("x.v", "x.key")
    tasks = []
    for depth, pairs in _node_pairs(keys, budget):
        at = keys.withColumn("node", _prefix("key", depth))
        for side, name in ((0, "u"), (1, "w")):
            own = pairs if side == 0 else pairs.filter("u <> w")
            tasks.append(at.join(own, (at["v"] == own["v"]) & (at["node"] == own[name]))
                         .select(own["v"], F.lit(depth).alias("depth"), "u", "w", "d", F.lit(side).alias("side"), "key"))
    rows = tasks[0]
    for x in tasks[1:]:
        rows = rows.unionByName(x)

    def join(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy(dtype=np.int64).view(np.uint64)
        first = group.iloc[0]
        root = join_nodes(keys, group["side"].to_numpy(), bool(first["u"] == first["w"]), int(first["depth"]), int(first["d"]), budget, budget // 2)
        moved = np.flatnonzero(root != np.arange(len(root)))
        if int(first["v"]):
            keys = (keys << np.uint64(32)) | (keys >> np.uint64(32))
        out = keys.view(np.int64)
        return pd.DataFrame({"a": out[moved], "b": out[root[moved]]})

    return rows.groupBy("v", "depth", "u", "w").applyInPandas(join, "a long, b long")


def _classes(prints: DataFrame, budget: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root, component_id) for every fingerprint of ``prints(doc_id, fp)``, and the hot ones.

    The root is a fingerprint and tells the components apart; component_id need not: components share
    it when they share a repeated id, or when all their ids are null."""
    per = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
    roots = components(links(per.select("fp"), budget))
    whole = per.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(whole.join(least, "root").select("fp", "root", "component_id"), "classes")
    total = per.agg(F.sum("n")).first()[0] or 0
    return named, per.filter(F.col("n") > max(1.0, total * HOT_SHARE)).select("fp")


def components_of(documents: DataFrame, words: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (smallest doc_id reachable) of every row."""
    prints = materialize(with_fingerprint(documents.select("doc_id", "text"), "fp", words).select("doc_id", "fp"), "fingerprints")
    named, hot = _classes(prints, budget)
    return lookup(prints, named, "fp", hot).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup(documents: DataFrame, words: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """One row of each component, the one with the smallest doc_id, with all its columns."""
    fp = fresh(documents, "fp")
    prints = materialize(with_fingerprint(documents.select("doc_id", "text"), "fp", words).select("doc_id", "fp"), "fingerprints")
    named, hot = _classes(prints, budget)
    per = lookup(prints, named, "fp", hot).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("m"))
    stay = per.select(F.col("m.doc_id").alias("__id"), F.col("m.fp").alias("__fp"))
    # rows that repeat the id that stays are cut to one of them; the fingerprint is computed for those
    # only, and for rows without an id, which need no join by id and so do not meet in one task
    known = documents.join(stay.select("__id").distinct(), documents["doc_id"] == F.col("__id"), "left_semi")
    printed = with_fingerprint(known.unionAll(documents.filter("doc_id is null")), fp, words)
    kept = printed.join(stay, printed["doc_id"].eqNullSafe(stay["__id"]) & (printed[fp] == stay["__fp"]), "left_semi")
    return kept.dropDuplicates(["doc_id", fp]).select(*[kept[c] for c in documents.columns])
