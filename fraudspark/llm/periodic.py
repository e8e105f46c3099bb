"""Periodic runs of words, by recompression.

A run is a stretch of consecutive words with smallest period q and a length of at least
``max(min_length, 2 q)`` that no neighbouring word extends.  A run of period q holds two neighbouring
points of the grid 0, q, 2q, ..., and the words at these agree, so the candidates of every period are
the agreeing neighbours of its grid: n/1 + n/2 + n/3 + ... comparisons.  How far the words around a
candidate agree, to the right and to the left, is asked of a grammar: the text is compressed by turns,
blocks of one symbol to one symbol, then pairs of symbols (every symbol falls left or right by its
hash, a left one followed by a right one joins), until each text is one symbol.  Equal stretches are
compressed alike up to their ends, so an extension climbs the levels while symbols agree and comes down
again where they differ: a few steps on each of logarithmically many levels, for all candidates at
once, and no suffix array.

Documents are taken in groups of at most ``GROUP_WORDS`` words (a longer one alone); a task holds one
group's arrays.  Words compare as bytes.

Defined results
    null text, empty text    no words, no runs
    null doc_id              kept
    very long texts          handled whole; some 150 bytes of memory for each word of one text
    ties, repeated rows      runs that share words are all returned; each row is searched by itself
    empty table              empty result
    extra columns            ignored
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
GROUP_WORDS = 400_000
#: Candidates whose extensions are asked for together.
ASKED = 200_000
RUN = "struct<start:long,length:long,period:long>"


class Level:
    """One string of the grammar, and how it was made from the one below."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.first = None  # place below where each symbol begins, and the end of the string
        self.above = None  # place above of each symbol
        self.blocks = False  # whether the symbols above are blocks, else pairs

    def mirrored(self, below: Level | None) -> Level:
        out = Level(self.symbols[::-1])
        out.blocks = self.blocks
        if self.above is not None:
            out.above = self.above[-1] - self.above[::-1]
        if below is not None:
            out.first = len(below.symbols) - self.first[::-1]
        return out


def _bit(symbols: np.ndarray, level: int) -> np.ndarray:
    mixed = (symbols.astype(np.uint64) + np.uint64(level * 0x51ED27 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(60) & np.uint64(1)).astype(bool)


def _named(keys: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """New symbols for the keys, equal ones alike, from ``free`` on."""
    names, distinct = pd.factorize(keys)
    return names + free, free + len(distinct)


def grammar(text: np.ndarray, bars: np.ndarray, free: int) -> list[Level]:
    """Levels over ``text``, whose symbols are below ``free``; the places ``bars`` hold symbols that
    occur once and are never compressed."""
    levels, quiet = [Level(text.astype(np.int64))], 0
    fixed = np.zeros(len(text), dtype=bool)
    fixed[bars] = True
    turn = 0
    while len(levels[-1].symbols) > 2 * len(bars) - 1 and quiet < 64:
        low = levels[-1]
        s, n = low.symbols, len(low.symbols)
        turn += 1
        if turn % 2:
            starts = np.r_[True, s[1:] != s[:-1]]
        else:
            left = _bit(s, turn)
            joins = left[:-1] & ~left[1:] & ~fixed[:-1] & ~fixed[1:]
            starts = np.r_[True, ~joins]
        first = np.flatnonzero(starts)
        if len(first) == n:
            quiet += 1
            continue
        quiet = 0
        size = np.diff(np.r_[first, n])
        made = s[first].copy()
        wide = np.flatnonzero(size > 1)
        second = size[wide] if turn % 2 else s[first[wide] + 1]
        made[wide], free = _named(made[wide] << 32 | second, free)
        low.above, low.blocks = np.cumsum(starts) - 1, bool(turn % 2)
        high = Level(made)
        high.first = np.r_[first, n]
        levels.append(high)
        fixed = fixed[first]
    return levels


def agreement(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal symbols of the lowest level from the places ``a`` and ``b`` on."""
    x, y = a.astype(np.int64), b.astype(np.int64)
    met = np.zeros(len(x), dtype=np.int64)  # the level on which a pair was found to differ
    live = np.arange(len(x))
    for h, level in enumerate(levels):
        s, begins = level.symbols, None
        if level.above is not None:
            begins, above = levels[h + 1].first, level.above
        rising = []
        while len(live):
            p, q = x[live], y[live]
            same = s[p] == s[q]
            met[live[~same]] = h
            live, p, q = live[same], p[same], q[same]
            if begins is None:  # the top: step on
                x[live] += 1
                y[live] += 1
                continue
            up, vp = above[p], above[q]
            ready = (begins[up] == p) & (begins[vp] == q)
            rising.append(live[ready])
            x[live[ready]], y[live[ready]] = up[ready], vp[ready]
            rest = ~ready
            live = live[rest]
            step = np.minimum(begins[up[rest] + 1] - p[rest], begins[vp[rest] + 1] - q[rest]) if level.blocks else 1
            x[live] += step
            y[live] += step
        live = np.concatenate(rising) if rising else live
    for h in range(len(levels) - 1, 0, -1):
        down = np.flatnonzero(met == h)
        if not len(down):
            continue
        first, s = levels[h].first, levels[h - 1].symbols
        p, q = first[x[down]], first[y[down]]
        same = s[p] == s[q]
        if levels[h - 1].blocks:
            step = np.minimum(first[x[down] + 1] - p, first[y[down] + 1] - q)
        else:
            step = 1
        x[down], y[down] = p + same * step, q + same * step
        met[down] = h - 1
    return x - a


class Searcher:
    """Finds the runs of texts given as arrays of word numbers."""

    def __init__(self, texts: list[np.ndarray], words: int, min_length: int):
        self.order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        self.min_length = min_length
        sizes = np.array([len(texts[k]) for k in self.order], dtype=np.int64)
        self.bars = np.r_[0, np.cumsum(sizes + 1)]  # a symbol of its own before every text and at the end
        self.text = np.empty(int(self.bars[-1]) + 1, dtype=np.int64)
        self.text[self.bars] = words + np.arange(len(self.bars))
        for k, at in zip(self.order, self.bars, strict=False):
            self.text[at + 1:at + 1 + len(texts[k])] = texts[k]
        self.sizes, self.free = sizes, words + len(self.bars)

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, period) of grid neighbours that agree with more words beside them, by period.

        A run of twelve words reaches at least six words past its first period, so the words at one
        neighbour's place and the two behind, or the three before, agree with the other's.
        """
        t, n = self.text, len(self.text)
        held, size = [], 0
        longest = int(self.sizes.max(initial=0))
        ends = self.bars[np.searchsorted(-self.sizes, -np.maximum(2 * np.arange(longest // 2 + 1), self.min_length), side="right")]
        for period in range(1, longest // 2 + 1):
            end = int(ends[period])  # texts are in order of length: these are long enough
            if not end:
                break
            grid = t[:end:period]
            at = np.flatnonzero(grid[1:] == grid[:-1]) * period
            if period == 1 and len(at):  # neighbours lie in one run: its first place answers for all
                at = at[np.diff(at, prepend=-2) > 1]
            if len(at) and self.min_length >= 11:
                agree = lambda k, at=at, p=period: (at + k >= 0) & (at + k + p < n) & (t[np.clip(at + k, 0, n - 1)] == t[np.clip(at + k + p, 0, n - 1)])
                at = at[(agree(1) & agree(2)) | (agree(-1) & agree(-2) & agree(-3))]
            if len(at):
                held.append((at, np.full(len(at), period)))
                size += len(at)
            if held and (size > ASKED or period & period - 1 == 0):
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
        if held:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))

    def runs(self) -> list[list[tuple[int, int, int]]]:
        """(start, length, period) of the runs of every text, by start, then period."""
        found, forward = [], None
        cover = np.full(len(self.text), -1, dtype=np.int32)  # a long run that holds a place
        long_start, long_end, long_period = [], [], []
        for at, period in self.candidates():
            if long_start:  # multiples of a known period inside its run give that run again
                s, e, q = (np.array(v) for v in (long_start, long_end, long_period))
                c = cover[at]
                known = (c >= 0) & (at >= s[c]) & (at + period < e[c]) & (period % q[c] == 0)
                at, period = at[~known], period[~known]
                if not len(at):
                    continue
            if forward is None:
                forward = grammar(self.text, self.bars, self.free)
                backward = [level.mirrored(below) for level, below in zip(forward, [None, *forward], strict=False)]
            n = len(self.text)
            right = agreement(forward, at, at + period)
            left = agreement(backward, n - at, n - at - period)
            long = left + right >= np.maximum(self.min_length - period, period)
            start, end, period = (at - left)[long], (at + period + right)[long], period[long]
            order = np.lexsort((period, end, start))
            start, end, period = start[order], end[order], period[order]
            keep = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][:len(start)]
            found.append((start[keep], end[keep], period[keep]))
            for s, e, q in zip(*(v.tolist() for v in found[-1]), strict=True):
                if e - s >= 4 * q:
                    cover[s:e] = len(long_start)
                    long_start.append(s)
                    long_end.append(e)
                    long_period.append(q)
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.order]
        if found:
            start, end, period = (np.concatenate(v) for v in zip(*found, strict=True))
            order = np.lexsort((period, end, start))
            start, end, period = start[order], end[order], period[order]
            keep = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][:len(start)]  # a stretch's smallest period
            start, end, period = start[keep], end[keep], period[keep]
            of = np.searchsorted(self.bars, start, side="right") - 1
            for d, s, e, q in zip(of.tolist(), (start - self.bars[of] - 1).tolist(), (end - self.bars[of] - 1).tolist(), period.tolist(), strict=True):
                out[self.order[d]].append((s, e - s, q))
        for rows in out:
            rows.sort(key=lambda r: (r[0], r[2]))
        return out


def _groups(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    group, size = [], 0
    for text in texts:
        words = (text or b"").split()  # ASCII white space
        if group and size + len(words) > GROUP_WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join(words[k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist())


def periodic_runs(documents: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (array of start, length and period by start, then period) and collapsed, the
    text's words without those that a run holds behind its first period, joined by blanks."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, kept = [], [], []
            for group in _groups(batch.column(1).to_pylist()):
                number = defaultdict(count().__next__)
                texts = [np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)) for words in group]
                # a text too short for any run takes no part in the search
                at = [k for k, t in enumerate(texts) if len(t) >= min_length]
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                if at:
                    for k, r in zip(at, Searcher([texts[k] for k in at], len(number), min_length).runs(), strict=True):
                        found[k] = r
                sizes += map(len, group)
                runs += found
                kept += map(_collapsed, group, found)
            flat = np.array([r for rows in runs for r in rows], dtype=np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32)), structs)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), lists, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(search, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length, then smallest start, then smallest period; null without runs."""
    return F.try_element_at(F.array_sort(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), F.lit(1))
