"""Point-in-time velocity in a stream: state keyed by card.

A card's state is its (second, count, sum) entries of the last window and lateness bound, as sorted arrays,
so it is bounded by the seconds of that span however hot the card is.  The cards are dealt by hash to a fixed
number of buckets and a bucket is one key of the stream, so Python is called once a bucket and micro-batch however
many cards there are.  Every micro-batch adds its rows
and answers them at once from what has arrived so far, this micro-batch included: the count and the spend of
the same card in [t - seconds, t - 1].  A card's state is dropped when the watermark has passed its newest
entry by the longest window, with its bucket's next rows or, when none come, by a timer.

Order: a row behind a second that its card has been answered for before is marked ``out_of_order``; it sees
what is held, and answers that went out before it stay as they are.  A row behind the watermark (the newest
time of earlier micro-batches less ``lateness``) is late and gets no answer, as in the window jobs.
Rows without a card or time have null results and keep no state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_AMOUNT = "_amount"
_CARD, _BUCKET = "_card", "_bucket"
#: ``cards`` holds the names as an Arrow array in IPC form, ``codes`` each entry's place among them.
_STATE = "cards binary, codes binary, seconds binary, counts binary, sums binary"
_KINDS = (np.int64, np.int64, np.float64, np.float64)
#: Buckets that cards are dealt to.
BUCKETS = 512


def merged_cards(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Entries (card's code, second, count, sum) of both, one for each card and second, in order."""
    code, second = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((second, code))
    first = np.r_[True, (np.diff(code[order]) != 0) | (np.diff(second[order]) != 0)][:len(order)]
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(first) - 1
    n = int(first.sum())
    with np.errstate(invalid="ignore"):
        return code[order][first], second[order][first], np.bincount(place, np.concatenate([a[2], b[2]]), n), np.bincount(place, np.concatenate([a[3], b[3]]), n)


def looked_up_cards(entries: tuple[np.ndarray, ...], code: np.ndarray, t: np.ndarray, windows: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window the count and sum of the card's entries in [t - window, t - 1] of each (code, t); the
    codes of the entries are 0, 1, ... without a gap."""
    held, seconds, counts, sums = entries
    starts = np.flatnonzero(np.r_[True, np.diff(held) != 0])
    ends = np.r_[starts[1:], len(held)]
    known, rank = np.unique(seconds, return_inverse=True)
    wide = len(known) + 1
    key = held * wide + rank
    at = lambda second: np.searchsorted(key, code * wide + np.searchsorted(known, second))
    before = lambda v: np.r_[0, np.cumsum(v)]
    # running sums hold finite amounts only and start anew with each card; others are told by counting them
    finite, running = np.where(np.isfinite(sums), sums, 0.0), np.zeros(len(sums))
    for a, b in zip(starts, ends, strict=True):
        np.cumsum(finite[a:b], out=running[a:b])
    up_to = lambda i: np.where(i > starts[code], running[i - 1], 0.0)
    n, odd = before(counts), [before(v) for v in (sums == np.inf, sums == -np.inf, np.isnan(sums))]
    hi, out = at(t), []
    for window in windows:
        lo = at(t - window)
        total = up_to(hi) - up_to(lo)
        up, down, none = (c[hi] > c[lo] for c in odd)
        total = np.where(up, np.inf, np.where(down, -np.inf, total))
        out.append(((n[hi] - n[lo]).round().astype(np.int64), np.where(none | (up & down), np.nan, total)))
    return out


def merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """``merged_cards`` of a single card's entries (second, count, sum)."""
    return merged_cards((np.zeros(len(a[0]), np.int64), *a), (np.zeros(len(b[0]), np.int64), *b))[1:]


def looked_up(entries: tuple[np.ndarray, ...], t: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``looked_up_cards`` of a single card for one window."""
    return looked_up_cards((np.zeros(len(entries[0]), np.int64), *entries), np.zeros(len(t), np.int64), t, [window])[0]


def _packed(names: Sequence[str]) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(names, pa.large_string())], names=["card"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return pa.ipc.open_stream(packed).read_all().column(0).to_numpy()


def add_velocity(stream: DataFrame, windows: dict[str, int], ts: str = "event_time", lateness: int = 3600, key: str = "card1",
                 dt: str = "TransactionDT", amount: str = "TransactionAmt", buckets: int = BUCKETS) -> DataFrame:
    """``stream`` with ``card_count_<name>`` and ``card_spend_<name>`` for each window (name -> seconds) and
    ``out_of_order``; ``ts`` is the timestamp of ``dt`` (whole seconds)."""
    if not isinstance(stream.schema[dt].dataType, T.IntegralType):
        raise TypeError(f"{dt} must hold whole seconds in an integer column")
    added = [f for name in windows for f in (T.StructField(f"card_count_{name}", T.LongType()), T.StructField(f"card_spend_{name}", T.DoubleType()))]
    # the key as the groups of a batch take it: one zero
    card = F.col(key) + F.lit(0) if isinstance(stream.schema[key].dataType, (T.FloatType, T.DoubleType)) else F.col(key)
    # inside the state function whole numbers travel as text, which keeps nulls and every digit
    whole = [f.name for f in stream.schema.fields if isinstance(f.dataType, T.LongType) and f.name != dt]
    rows_ = stream.select(*[F.col(c).cast("string").alias(c) if c in whole else F.col(c) for c in stream.columns],
                          F.coalesce(F.col(amount).cast("double"), F.lit(0.0)).alias(_AMOUNT), card.cast("string").alias(_CARD),
                          F.pmod(F.xxhash64(card.cast("string")), F.lit(buckets)).alias(_BUCKET))
    schema = T.StructType([*rows_.drop(_AMOUNT, _CARD, _BUCKET).schema.fields, *added, T.StructField("out_of_order", T.BooleanType())])
    held = max(windows.values()) + lateness

    def answer(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(parts), ignore_index=True)
        at = rows[dt].to_numpy(dtype=np.int64)
        if state.exists:
            cards, *old = state.get
            names, old = _unpacked(cards), tuple(np.frombuffer(b, dtype=d) for b, d in zip(old, _KINDS, strict=True))
        else:
            names, old = np.zeros(0, dtype=object), tuple(np.zeros(0, dtype=d) for d in _KINDS)
        codes, cards = pd.factorize(np.concatenate([names, rows[_CARD].to_numpy(dtype=object)]))
        code = codes[len(names):].astype(np.int64)
        entries = merged_cards(old, (code, at, np.ones(len(at)), rows[_AMOUNT].to_numpy(dtype=np.float64)))
        out = rows.copy()
        for name, (count, spend) in zip(windows, looked_up_cards(entries, code, at, list(windows.values())), strict=True):
            out[f"card_count_{name}"], out[f"card_spend_{name}"] = count, spend
        newest = np.full(len(cards), np.iinfo(np.int64).min)
        np.maximum.at(newest, old[0], old[1])
        out["out_of_order"] = at < newest[code]
        yield out[schema.names]
        # milliseconds of the timestamp at second 0
        zero = int(rows[ts].iloc[0].timestamp() * 1000) - int(at[0]) * 1000
        np.maximum.at(newest, code, at)
        watermark = state.getCurrentWatermarkMs()
        alive = newest * 1000 + zero + held * 1000 + 1 > watermark
        keep = alive[entries[0]] & (entries[1] >= newest[entries[0]] - held)
        kept = tuple(e[keep] for e in entries)
        place = np.cumsum(alive) - 1
        state.update((_packed(cards[alive]), *(e.astype(d).tobytes() for e, d in zip((place[kept[0]], *kept[1:]), _KINDS, strict=True))))
        state.setTimeoutTimestamp(max(int(newest.max()) * 1000 + zero, watermark) + held * 1000 + 1)

    known = F.col(key).isNotNull() & F.col(dt).isNotNull() & F.col(ts).isNotNull()
    found = rows_.where(known).withWatermark(ts, f"{lateness} seconds").groupBy(_BUCKET).applyInPandasWithState(
        answer, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in added]
    back = found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stream.schema.fields], *[f.name for f in added], "out_of_order")
    return back.unionByName(stream.where(~known).select("*", *nothing, F.lit(False).alias("out_of_order")))
