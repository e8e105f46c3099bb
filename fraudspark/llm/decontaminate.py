"""Benchmark decontamination: BM25 index of test items, searched with block-max WAND.

The inverted index holds the test items.  Every training passage is a query: whole texts are cut into
overlapping word windows, twice as long as the longest item and half overlapping, so each occurrence
of an item lies inside some window.  An item's BM25 score against a window is divided by its score
against itself, and block-max WAND retrieves all items at or above ``THRESHOLD``:

* postings are in item order (like items next to each other), cut into blocks of items, with the largest impact of each
  term overall and in each block;
* a window whose terms' largest impacts do not reach the threshold has no pivot and is done;
* blocks in which the block maxima do not reach it are skipped;
* inside the others the pivot moves over the cursors as usual, and only pivots are scored.

Retrieved items are verified: of the question's and of the answer's five-word shingles, at least
``OVERLAP`` of each must stand in the text.  Items with ``question`` and ``answer`` columns use
those; a plain ``text`` is cut at the sentence end nearest to its middle (else at the middle word).

The index is built for shards of items, each bounded in words, and broadcast shard by shard; document
frequencies and mean length are taken over all items.

Defined results
    null text        counts as the empty text; an item without words is in no index and matches nothing
    null ids         passed through, for documents and for items
    ties             every item at or above the threshold is retrieved, whatever its rank
    repeated rows    each document row is searched by itself; repeated items are reported each
    empty tables     without items no document is contaminated; without documents nothing is returned
    extra columns    ignored by ``contaminated``, kept by ``remove_contaminated`` whatever their names
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, materialize

K1, B = 1.2, 0.75
#: Retrieved: this share of the item's score against itself.
THRESHOLD = 0.5
#: Verified: this share of the shingles of the question, and of the answer.
OVERLAP, SHINGLE = 0.8, 5
#: Items in a block of postings, unless that makes more blocks than BLOCKS.
BLOCK, BLOCKS = 2, 512
#: Words of the items in one shard of the index, about; terms times blocks bound its size.
SHARD_WORDS = 40_000

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def parts(text: str) -> tuple[str, str]:
    """Question and answer of a plain item text."""
    middle = len(text) / 2
    ends = [m.end() for m in re.finditer(r"[.!?]+(?=\s+\S)", text)]
    if ends:
        cut = min(ends, key=lambda e: abs(e - middle))
    else:
        starts = [m.start() for m in _WORD.finditer(text)]
        cut = starts[len(starts) // 2] if starts else 0
    return text[:cut], text[cut:]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


class Index:
    """Block-max index of items (id, question, answer) with given document frequencies."""

    def __init__(self, items: list[tuple[int | None, str, str]], df: dict[str, int], n_items: int, mean_length: float, threshold: float = THRESHOLD):
        self.threshold = threshold
        rows = [(i, words_of(q), words_of(a)) for i, q, a in items]
        # items with the same commonest word, then of one length, next to each other: it keeps block maxima tight
        common = lambda r: max(r[1] + r[2], key=lambda w: (df.get(w, 1), w))
        rows = sorted((r for r in rows if r[1] or r[2]), key=lambda r: (common(r), len(r[1]) + len(r[2]), r[0] is None, r[0] or 0))
        self.ids = [r[0] for r in rows]
        self.sides = [(shingles(q), shingles(a)) for _, q, a in rows]
        lengths = [len(q) + len(a) for _, q, a in rows]
        self.window = 2 * max(lengths, default=1)
        self.terms: dict[str, int] = {}
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for item, (_, q, a) in enumerate(rows):
            impact = {}
            for w, tf in Counter(q + a).items():
                n = df.get(w, 1)
                idf = math.log1p((n_items - n + 0.5) / (n + 0.5))
                impact[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[item] / mean_length))
            own = sum(impact.values())
            for w, x in impact.items():
                postings[self.terms.setdefault(w, len(self.terms))].append((item, x / own))
        self.items = [np.array([i for i, _ in postings[t]], dtype=np.int32) for t in range(len(self.terms))]
        self.impacts = [np.array([x for _, x in postings[t]]) for t in range(len(self.terms))]
        self.block = max(BLOCK, -(-len(rows) // BLOCKS))
        blocks = -(-len(rows) // self.block)
        self.most = np.array([x.max() for x in self.impacts] or [0.0])
        # largest impact of each term in each block
        self.block_max = np.zeros((len(self.terms), blocks), dtype=np.float32)
        for t, (i, x) in enumerate(zip(self.items, self.impacts, strict=True)):
            np.maximum.at(self.block_max[t], i // self.block, x.astype(np.float32))

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Every item whose score over these distinct terms reaches the threshold."""
        if self.most[terms].sum() < self.threshold:
            return []  # no pivot
        live = np.flatnonzero(self.block_max[terms].sum(axis=0) >= self.threshold - 1e-6)
        return [hit for b in live for hit in self._wand(terms, int(b))]

    def _wand(self, terms: np.ndarray, block: int) -> list[tuple[int, float]]:
        """Pivot traversal inside one block of items."""
        lo, hi = block * self.block, (block + 1) * self.block
        cursors = []  # [item, bound, items, impacts, position, end]
        for t in terms:
            if (bound := float(self.block_max[t, block])) > 0:
                items = self.items[t]
                p, e = np.searchsorted(items, (lo, hi))
                if p < e:
                    cursors.append([int(items[p]), bound, items, self.impacts[t], int(p), int(e)])
        out, least = [], self.threshold - 1e-6

        def advance(c: list, to: int) -> None:
            c[4] += int(np.searchsorted(c[2][c[4]:c[5]], to))
            c[0] = int(c[2][c[4]]) if c[4] < c[5] else hi

        while True:
            cursors = sorted((c for c in cursors if c[0] < hi), key=lambda c: c[0])
            total, pivot = 0.0, None
            for c in cursors:
                total += c[1]
                if total >= least:
                    pivot = c[0]
                    break
            if pivot is None:
                return out
            if cursors[0][0] == pivot:
                at = [c for c in cursors if c[0] == pivot]
                s = float(sum(c[3][c[4]] for c in at))
                if s >= self.threshold - 1e-9:
                    out.append((pivot, s))
                for c in at:
                    advance(c, pivot + 1)
            else:
                for c in cursors:
                    if c[0] >= pivot:
                        break
                    advance(c, pivot)

    def matches(self, text: str | None) -> list[tuple[int | None, float, float, float, int]]:
        """(item id, best score, question overlap, answer overlap, first word of the window) of a text."""
        if not self.ids:
            return []
        words = words_of(text)
        get = self.terms.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        held = np.flatnonzero(ids >= 0)
        if not len(held):
            return []
        # impacts with repeats bound a window's distinct terms from above: one running sum prunes most windows
        run = np.concatenate(([0.0], np.cumsum(np.where(ids >= 0, self.most[ids], 0.0))))
        step = self.window // 2
        best: dict[int, tuple[float, int]] = {}
        for a in range(0, max(1, len(words) - step), step):
            b = min(len(words), a + self.window)
            if run[b] - run[a] < self.threshold - 1e-6:
                continue
            terms = np.unique(ids[a:b])
            for item, s in self.search(terms[1:] if terms[0] < 0 else terms):
                if s > best.get(item, (0.0, 0))[0]:
                    best[item] = (s, a)
        if not best:
            return []
        here = shingles_in(words, {s for i in best for side in self.sides[i] for s in side})
        out = []
        for item, (s, a) in sorted(best.items()):
            q, ans = (1.0 if not side else sum(x in here for x in side) / len(side) for side in self.sides[item])
            if q >= OVERLAP and ans >= OVERLAP:
                out.append((self.ids[item], min(s, 1.0), q, ans, a))
        return out


def shingles_in(words: list[str], wanted: set[tuple[str, ...]]) -> set[tuple[str, ...]]:
    """The wanted word sequences that stand in ``words``."""
    out = set()
    for size in {len(w) for w in wanted}:
        out |= wanted & {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
    return out


def _sides(items: DataFrame) -> DataFrame:
    """item_id, q, a of every item."""
    has = {c.lower() for c in items.columns}
    if {"question", "answer"} <= has:
        return items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("question", F.lit("")).alias("q"), F.coalesce("answer", F.lit("")).alias("a"))

    def cut(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parts(t or "") for t in texts], columns=["q", "a"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), F.pandas_udf(cut, "q string, a string")(F.col("text")).alias("x")).select("item_id", "x.q", "x.a")


def indexes(items: DataFrame, threshold: float = THRESHOLD, shard_words: int = SHARD_WORDS):
    """The index, shard by shard; only one shard is on the driver at a time."""
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(words_of)

    sides = _sides(items).withColumn("w", F.pandas_udf(words, T.ArrayType(T.StringType()))(F.concat_ws("\n", "q", "a")))
    sides = materialize(sides.withColumn("n", F.size("w")).filter("n > 0"), "items")
    n_items, total = sides.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_items:
        return
    df = materialize(sides.select(F.explode(F.array_distinct("w")).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")), "item_df")
    shards = max(1, math.ceil(total / shard_words))
    shard = F.pmod(F.xxhash64("item_id", "q", "a"), F.lit(shards))
    for s in range(shards):
        own = sides.filter(shard == s)
        terms = own.select(F.explode("w").alias("t")).distinct().join(df, "t").collect()
        rows = own.select("item_id", "q", "a").collect()
        if rows:
            yield Index([tuple(r) for r in rows], {r["t"]: r["df"] for r in terms}, n_items, total / n_items, threshold)


_MATCH = "array<struct<item_id: bigint, score: double, question_overlap: double, answer_overlap: double, first_word: bigint>>"


def _searcher(spark, index: Index):
    shared = spark.sparkContext.broadcast(index)

    def search(texts: pd.Series) -> pd.Series:
        names = ("item_id", "score", "question_overlap", "answer_overlap", "first_word")
        return pd.Series([[dict(zip(names, m, strict=True)) for m in shared.value.matches(t)] for t in texts], dtype=object)

    return F.pandas_udf(search, _MATCH)


def contaminated(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, item_id, score and overlaps of every verified pair; a scan of the documents per shard."""
    spark, out = documents.sparkSession, None
    for index in indexes(items, threshold, shard_words):
        found = documents.select("doc_id", _searcher(spark, index)(F.col("text")).alias("m")).select("doc_id", F.explode("m").alias("m")).select("doc_id", "m.*")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long")


def remove_contaminated(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents without a verified item, with all their columns."""
    spark, columns = documents.sparkSession, documents.columns
    for index in indexes(items, threshold, shard_words):
        name = fresh(documents, "items")
        documents = documents.withColumn(name, _searcher(spark, index)(F.col("text"))).filter(F.size(name) == 0).select(*columns)
    return documents
