"""Substring dedup by sliding sentence spans.

Whole texts are cut into sentences (after ``.``, ``!`` or ``?`` before white space, and at line
ends).  Every run of three consecutive sentences, and every run of two, is hashed to 128 bits when it has
at least ``MIN_WORDS`` words; where sentences are short, so is the shortest longer run from each sentence
on, and back from each sentence, that reaches ``MIN_WORDS``.  So every sentence of a repeated passage of
two or more sentences and ``MIN_WORDS`` words lies in a hashed run within the passage.  All runs meet by hash; the first occurrence (smallest doc_id, then
first in its text) stays, and the sentences covered by any other occurrence are removed.

Runs are counted with map-side partial aggregation, one row per document and hash.  The most frequent
runs (at most ``MAX_HOT``, above a number of documents chosen by counting) are broadcast with their first
documents as sorted arrays, and the tasks that cut the texts decide on them at once; every other run of
a document meets the repeated ones in one join on the hash, in groups of at most that number.

The method takes every run of several sentences; here runs below ``min_words`` words are left out, which
would remove phrases such as "Thank you. Goodbye." everywhere; ``min_words=1`` takes all of them.

Defined results
    null text        counts as the empty text: no sentences
    null doc_id      comes after every other id in the order of occurrences; rows without an id are told apart
                     by their texts, equal ones count as repeated rows; as a first document it is null
    repeated rows    rows with one id are one document: what they share with each other stays
    ties             the first occurrence inside a text is the one that starts first
    one sentence     repeated between differing neighbours is no run and stays, however long it is
    one line over    an unbroken stretch of one short sentence is no copy of itself; another stretch of it, in the
    and over         same text or elsewhere, is a copy as far as the first one goes
    very long text   cut whole; memory follows one text
    empty table      empty result
    extra columns    ignored by ``spans`` and ``changed``, kept by ``dedup`` whatever their names
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

RUNS = (2, 3)
MIN_WORDS = 16
#: Runs that are broadcast (24 bytes each): those that most documents have, and LEAST_HOT at least.
MAX_HOT, LEAST_HOT = 500_000, 8
#: Null ids stand from here on in the order of occurrences, by a hash of their text.
LAST_ID = 1 << 62

_SENTENCE = re.compile(r"[^\n.!?]*(?:[.!?]+(?![\s.!?])[^\n.!?]*)*(?:[.!?]+|\n|$)")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of every sentence that has a word; together with what lies between, the whole text."""
    return [(m.start(), m.end()) for m in _SENTENCE.finditer(text) if m.end() > m.start() and not m[0].isspace()]


def _longer(size: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, sentences) of the shortest run from each sentence on, and back from each, that has
    ``min_words`` words, where it takes more sentences than RUNS."""
    n = len(size)
    total = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
    end = np.searchsorted(total, total[:-1] + min_words)  # n + 1 where the text ends before
    start = np.searchsorted(total, total[1:] - min_words, side="right") - 1  # -1 where it starts after
    on, back = np.flatnonzero((end <= n) & (end - np.arange(n) > RUNS[-1])), np.flatnonzero((start >= 0) & (np.arange(n) + 1 - start > RUNS[-1]))
    return sorted({*zip(on.tolist(), (end[on] - on).tolist(), strict=True), *zip(start[back].tolist(), (back + 1 - start[back]).tolist(), strict=True)})


def runs(text: str, min_words: int = MIN_WORDS) -> list[tuple[bytes, int, int]]:
    """(hash, first sentence, sentences) of every run that is long enough."""
    words = [text[a:b].split() for a, b in sentences(text)]
    lines = [" ".join(w).encode("utf-8", "surrogatepass") for w in words]
    size = [len(w) for w in words]
    digest = xxhash.xxh3_128_digest
    out = [(digest(b"\n".join(lines[i:i + k])), i, k) for k in RUNS for i in range(len(lines) - k + 1) if sum(size[i:i + k]) >= min_words]
    longer = _longer(size, min_words)
    if longer:
        stretch = [0] * len(lines)  # where the stretch of equal sentences starts
        for i in range(1, len(lines)):
            stretch[i] = stretch[i - 1] if lines[i] == lines[i - 1] else i
        for i, k in longer:
            # a run of one sentence over and over is told from its neighbours by its place in the stretch
            place = b"\n\n%d" % (i - stretch[i]) if stretch[i + k - 1] <= i else b""
            out.append((digest(b"\n".join(lines[i:i + k]) + place), i, k))
    return out


_RUN = "doc_id long, th long, h1 long, h2 long, first int, n int, again boolean, removed array<int>, first_doc_ids array<long>"


class Hot:
    """First documents of the most frequent runs, looked up for many hashes at once."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, first: np.ndarray):
        order = np.lexsort((h2, h1))
        self.h1, self.h2, self.first = h1[order], h2[order], first[order]

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is not among them."""
        if not len(self.h1):
            return np.full(len(h1), -1)
        at = np.searchsorted(self.h1, h1)
        place = np.full(len(h1), -1)
        open_ = np.flatnonzero(at < len(self.h1))
        while len(open_):  # more than one step only where first halves collide
            open_ = open_[self.h1[at[open_]] == h1[open_]]
            hit = self.h2[at[open_]] == h2[open_]
            place[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < len(self.h1)]
        return place


def _listed(batch: pd.DataFrame, min_words: int, all_places: bool):
    """Row, hash halves, first sentence, sentences of the runs of a batch, and whether the text had the run before."""
    at, digests, first, n, again = [], [], [], [], []
    for row, text in enumerate(batch["text"]):
        seen: set[bytes] = set()
        for h, i, k in runs(text or "", min_words):
            known = h in seen
            seen.add(h)
            if all_places or not known:
                at.append(row)
                digests.append(h)
                first.append(i)
                n.append(k)
                again.append(known)
    h = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
    return np.array(at, dtype=np.int64), h[:, 0], h[:, 1], np.array(first, dtype=np.int32), np.array(n, dtype=np.int32), np.array(again, dtype=bool)


def _repeated(docs: DataFrame, min_words: int) -> tuple[DataFrame, int]:
    """(h1, h2, first_doc_id, docs) of runs that several documents have, and the number of documents above
    which a run is a hot one."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, h1, h2, *_ = _listed(batch, min_words, False)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(dtype=np.int64)[at], "h1": h1, "h2": h2})

    met = (docs.select("doc_id", "text").mapInPandas(count, "doc_id long, h1 long, h2 long")
           .groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("docs"))
           .filter("first_doc_id < last"))
    met = materialize(met.select("h1", "h2", "first_doc_id", "docs"), "repeated_runs")
    limits = [LEAST_HOT << k for k in range(48)]
    above = met.agg(*[F.count_if(F.col("docs") > limit).alias(str(limit)) for limit in limits]).first()
    return met, next(limit for limit in limits if above[str(limit)] <= MAX_HOT)


def _identified(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(_order(F.col("doc_id"), text).alias("doc_id"), text.alias("text"))


def _order(doc_id, text):
    """The id, or for a null one a number behind all ids, told by the text."""
    return F.coalesce(doc_id.cast("long"), F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(LAST_ID)))


def spans(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """What every document loses: doc_id, th (hash of the text), removed (sentence numbers) and first_doc_ids
    (documents that keep them), in one or more rows a document."""
    docs = _identified(documents)
    met, limit = _repeated(docs, min_words)
    frequent = met.filter(F.col("docs") > limit).select("h1", "h2", "first_doc_id").toPandas()  # at most MAX_HOT
    shared = documents.sparkSession.sparkContext.broadcast(Hot(*(frequent[c].to_numpy(dtype=np.int64) for c in ("h1", "h2", "first_doc_id"))))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, h1, h2, first, n, again = _listed(batch, min_words, True)
            ids, th = batch["doc_id"].to_numpy(dtype=np.int64), batch["th"].to_numpy(dtype=np.int64)
            place = shared.value.find(h1, h2)
            rest = np.flatnonzero(place < 0)
            out = pd.DataFrame({"doc_id": ids[at[rest]], "th": th[at[rest]], "h1": h1[rest], "h2": h2[rest], "first": first[rest], "n": n[rest], "again": again[rest]})
            out["removed"] = out["first_doc_ids"] = pd.Series([None] * len(out), dtype=object)
            yield out
            hot = np.flatnonzero(place >= 0)
            keeper = shared.value.first[place[hot]]
            gone = hot[(keeper < ids[at[hot]]) | again[hot]]
            by_row: dict[int, tuple[set, set]] = {}
            for k in gone.tolist():
                sentences_, keepers = by_row.setdefault(int(at[k]), (set(), set()))
                sentences_.update(range(first[k], first[k] + n[k]))
                keepers.add(int(shared.value.first[place[k]]))
            rows = list(by_row)
            # decided rows have no hash; their text's hash deals them out
            yield pd.DataFrame({"doc_id": ids[rows], "th": th[rows], "h1": th[rows], "h2": pd.array([None] * len(rows), dtype="Int64"), "first": 0, "n": 0, "again": False,
                                "removed": pd.Series([sorted(by_row[r][0]) for r in rows], dtype=object),
                                "first_doc_ids": pd.Series([sorted(by_row[r][1]) for r in rows], dtype=object)}).astype({"first": "int32", "n": "int32"})

    here = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInPandas(decide, _RUN)
    rest = met.filter(F.col("docs") <= limit).select("h1", "h2", "first_doc_id")
    found = here.join(rest.hint("merge"), ["h1", "h2"], "left")
    first = F.coalesce("first_doc_id", "doc_id")
    decided = F.col("removed").isNotNull()
    return found.filter(decided | (first < F.col("doc_id")) | F.col("again")).select(
        "doc_id", "th", F.when(decided, F.col("removed")).otherwise(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("removed"),
        F.when(decided, F.col("first_doc_ids")).otherwise(F.array(first)).alias("first_doc_ids"))


def without(text: str, removed: list[int]) -> str:
    """The text without these sentences; what lies between sentences stays."""
    bounds = sentences(text)
    out, at = [], 0
    for i in removed:
        a, b = bounds[i]
        out.append(text[at:a])
        at = b
    return "".join(out) + text[at:]


def _by_document(documents: DataFrame, min_words: int) -> DataFrame:
    """doc_id, th, removed (sentence numbers), first_doc_ids of every changed document."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return spans(documents, min_words).groupBy("doc_id", "th").agg(union("removed").alias("removed"), F.transform(
        union("first_doc_ids"), lambda i: F.when(i < LAST_ID, i)).alias("first_doc_ids"))


def _clean(texts: pd.Series, removed: pd.Series) -> pd.Series:
    return pd.Series([without(t or "", list(r)) if r is not None else t for t, r in zip(texts, removed, strict=True)], dtype=object)


def _joined(documents: DataFrame, min_words: int) -> tuple[DataFrame, str, str, str]:
    """``documents`` with the sentences to remove and the first documents, and the added names."""
    removed, first, th = fresh(documents, "removed"), fresh(documents, "first_doc_ids"), fresh(documents, "th")
    marks = _by_document(documents, min_words).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("removed").alias(removed), F.col("first_doc_ids").alias(first))
    tagged = documents.withColumn(th, F.xxhash64(F.coalesce("text", F.lit(""))))
    both = (_order(tagged["doc_id"], F.coalesce(tagged["text"], F.lit(""))) == marks["__id"]) & (tagged[th] == marks["__th"])
    return tagged.join(marks, both, "left").drop("__id", "__th", th), removed, first, th


def changed(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document that loses sentences: doc_id, first_doc_ids (documents that keep them),
    removed (sentence numbers from 0), n_removed and the remaining text."""
    docs, removed, first, _ = _joined(documents.select("doc_id", "text"), min_words)
    clean = F.pandas_udf(_clean, "string")(F.col("text"), F.col(removed))
    return (docs.filter(F.col(removed).isNotNull())
            .select("doc_id", F.col(first).alias("first_doc_ids"), F.col(removed).alias("removed"), F.size(removed).cast("long").alias("n_removed"), clean.alias("text")))


def dedup(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All documents, without the sentences that a non-first repeated run covers."""
    docs, removed, _, _ = _joined(documents, min_words)
    clean = F.pandas_udf(_clean, "string")(F.col("text"), F.col(removed))
    return docs.withColumn("text", F.when(F.col(removed).isNotNull(), clean).otherwise(F.col("text"))).select(*documents.columns)
