"""SentencePiece encoding and decoding by vectorised merge rounds.

Encodes with an existing byte-pair vocabulary exactly as its library does: of all neighbouring symbols
that join to a piece the one with the best score merges first, the leftmost of equal ones, until none
joins.  Here the distinct words of a batch lie in one flat array of symbols.  In every round each
word finds the best rank among its pairs (a segmented minimum), all places of the word that have it
merge at once, leftmost first where they overlap, and the arrays are compacted; words without a pair
leave.  Merging several places at once equals merging one after the other as long as no symbol so made
joins a neighbour at a rank as good; where one does, the later places of the word wait for it, unless
they lie further away than any chain of follow-ups can reach.

A text is cut into words before every blank, which no piece has behind another character.  Runs of
blanks join by a ladder of pieces that hold blanks only, all of the worst score, so after all other
merges: a run splits into longest pieces from the left, and its rest as the rule of merges has it.  A word of more than ``LONG_WORD`` characters is cut further,
wherever no place of a piece in it spans the cut; nothing can merge there.  Characters outside
the vocabulary become their UTF-8 bytes.

Defined results
    null text, empty text   no ids; no ids decode to the empty text
    null ids                decode to null
    null doc_id             kept
    very long texts         handled whole; a batch's arrays hold some 60 bytes for each character of its
                            new distinct words, and a text without blanks is one word
    ties, repeated rows     each row is encoded by itself
    empty table             empty result
    extra columns           ``encode`` ignores them, ``decode`` keeps them whatever their names
    ids outside the vocabulary, control ids   decode to nothing; bytes that are no UTF-8 to U+FFFD each
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

#: The existing vocabulary, as public_tokenizers.path() names it; a path may be given instead.
VOCABULARY = "piece_bpe_32k.model"
BLANK = "▁"
#: Characters of a word above which it is cut at places that no piece spans.
LONG_WORD = 256
#: Distinct words (and their ids) that a task remembers.
REMEMBERED_WORDS, REMEMBERED_IDS = 400_000, 4_000_000
#: Characters of new words that go through the rounds together.
ROUND_CHARS = 2_000_000
NONE = np.int32(np.iinfo(np.int32).max)
_SHIFT = 22  # symbols are ids, or the vocabulary's size plus a code point


def _one_byte(error):
    return "�", error.start + 1


codecs.register_error("fraudspark.one_byte", _one_byte)


class Pairs:
    """Open-addressing table from a pair of symbols to the piece that it joins to."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(8, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, -1, dtype=np.int32)
        for (a, b), piece in pairs.items():
            at = int(self._place(np.array([a << _SHIFT | b], dtype=np.int64))[0])
            while self.keys[at] != -1:
                at = at + 1 & (1 << self.bits) - 1
            self.keys[at], self.values[at] = a << _SHIFT | b, piece

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined piece, -1 where there is none."""
        keys = left.astype(np.int64) << _SHIFT | right
        at = self._place(keys)
        met = self.keys[at]
        out = np.where(met == keys, self.values[at], np.int32(-1))
        open_ = np.flatnonzero((met != keys) & (met != -1))
        while len(open_):
            at[open_] = at[open_] + 1 & (1 << self.bits) - 1
            met = self.keys[at[open_]]
            hit = met == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (met != -1)]
        return out


def _climb(n: int, rungs: set[int]) -> list[int]:
    """Pieces of a run of ``n`` blanks: the leftmost neighbours that join do so, until none does."""
    run = [1] * n
    while (k := next((k for k in range(len(run) - 1) if run[k] + run[k + 1] in rungs), None)) is not None:
        run[k:k + 2] = [run[k] + run[k + 1]]
    return run


def _since(heads: np.ndarray, n: int) -> np.ndarray:
    """Distance of each of ``n`` places from the last head at or before it."""
    return np.arange(n) - np.repeat(heads, np.diff(np.r_[heads, n]))


class Vocabulary:
    """The tables of a byte-pair vocabulary with byte fallback."""

    def __init__(self, path: str = VOCABULARY):
        import sentencepiece

        if "/" not in path:
            import public_tokenizers

            path = public_tokenizers.path(path)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = model.get_piece_size()
        kinds = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        normal = {model.id_to_piece(i): i for i in range(n) if not (kinds[i] or byte[i])}
        score = {p: model.get_score(i) for p, i in normal.items()}
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        if not all(byte[i] for i in self.byte_id):
            raise ValueError("the vocabulary has no byte fallback")

        # the ladder of blanks
        ladder = {p for p in normal if set(p) == {BLANK} and len(p) > 1}
        others = [p for p in normal if len(p) > 1 and p not in ladder]
        if BLANK not in normal or len({score[p] for p in ladder}) > 1 or any(BLANK in p[1:] for p in others) or (
                ladder and min((score[p] for p in others), default=np.inf) <= score[next(iter(ladder))]):
            raise ValueError("the vocabulary has pieces that cross a blank, or blanks of another score than the worst")
        top = max(map(len, ladder), default=1)
        self.rung = np.array([normal.get(BLANK * k, -1) for k in range(top + 1)], dtype=np.int32)  # id of k blanks
        climbed = [_climb(run, {1, *map(len, ladder)}) for run in range(3 * top)]
        if any(climbed[run] != [top, *climbed[run - top]] for run in range(top, 3 * top)):
            raise ValueError("runs of blanks do not split into longest pieces from the left")
        self.rest = np.zeros((top, top), dtype=np.int64)  # by length of a rest: size of the piece that starts at a place
        for run in range(top):
            self.rest[run, np.cumsum([0, *climbed[run]])[:-1].astype(int)] = climbed[run]

        # ranks: 0 is the best; equal scores share a rank
        order = {s: k for k, s in enumerate(sorted({score[p] for p in others}, reverse=True))}
        self.rank = np.full(n + 1, NONE, dtype=np.int32)  # the last place serves "no piece", which is -1
        for p in others:
            self.rank[normal[p]] = order[score[p]]
        symbol = lambda p: normal[p] if p in normal else n + ord(p)  # noqa: E731  a lone character need not be a piece
        pairs, follows = {}, np.zeros(n + 1, dtype=bool)
        for p in others:
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                if (a in normal or len(a) == 1) and (b in normal or len(b) == 1):
                    pairs[symbol(a), symbol(b)] = normal[p]
                    for part in (a, b):
                        if len(part) > 1 and self.rank[normal[part]] >= self.rank[normal[p]]:
                            follows[normal[part]] = True  # once made, it may join on at a rank as good
        shared = np.bincount([self.rank[normal[p]] for p in others], minlength=1)
        for p in others:
            follows[normal[p]] |= shared[self.rank[normal[p]]] > 1
        self.pairs, self.follows = Pairs(pairs), follows
        self.reach = 2 * max(map(len, normal), default=1)
        self.others = others

        self.of_char = n + np.arange(0x110000, dtype=np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i

        # decoding
        data = [b"" if kinds[i] else bytes([int(model.id_to_piece(i)[3:5], 16)]) if byte[i] else model.id_to_piece(i).replace(BLANK, " ").encode() for i in range(n)]
        data[model.unk_id()] = " ⁇ ".encode()
        self.led = np.array([not kinds[i] and not byte[i] and model.id_to_piece(i).startswith(BLANK) for i in range(n)] + [False])
        self.data = np.frombuffer(b"".join(data), dtype=np.uint8)
        self.size_of = np.array([*map(len, data), 0], dtype=np.int64)  # the last place serves ids outside the vocabulary
        self.start_of = np.r_[0, np.cumsum(self.size_of[:-1])][:n + 1]
        for probe in ("", " ", " a   b ", "the  there\tfish\n\n ﬁ Ａ é 😀 ▁x", "aaaa" * 9 + "  " * 20 + "ctetetetenenene"):
            if self.ids_of([probe])[0].tolist() != model.encode(probe):
                raise ValueError("the vocabulary normalises texts or is no byte-pair vocabulary")

    def _cuts(self, word: str) -> list[str]:
        """A long word in parts, cut wherever no place of a piece spans the cut."""
        if not hasattr(self, "_places"):
            import ahocorasick

            self._places = ahocorasick.Automaton()
            for p in self.others:
                self._places.add_word(p, len(p))
            self._places.make_automaton()
        inside = np.zeros(len(word) + 1, dtype=np.int32)
        for end, size in self._places.iter(word):
            inside[end - size + 2] += 1  # the cuts before the 2nd to the last character
            inside[end + 1] -= 1
        at = [*np.flatnonzero(np.cumsum(inside[:-1]) == 0).tolist(), len(word)]
        return [word[a:b] for a, b in zip([0, *at] if at[0] else at, at if at[0] else at[1:])]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_places"}

    def joins_on(self, sym, last, place, piece, rank) -> np.ndarray:
        """Whether the piece made at a place joins a neighbour, or its like, at a rank as good."""
        found = self.rank[self.pairs.get(piece, piece)] <= rank
        left = np.flatnonzero((place > 0) & ~last[place - 1])
        found[left] |= self.rank[self.pairs.get(sym[place[left] - 1], piece[left])] <= rank[left]
        right = np.flatnonzero(~last[place + 1])
        found[right] |= self.rank[self.pairs.get(piece[right], sym[place[right] + 2])] <= rank[right]
        return found

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of every word after all merges: the flat symbols and each word's number of them."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        sym = self.of_char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        total = np.zeros(len(words), dtype=np.int64)
        word, size = np.flatnonzero(sizes), sizes[sizes > 0]
        last = np.zeros(len(sym), dtype=bool)
        last[np.cumsum(size) - 1] = True
        joined = np.full(len(sym), -1, dtype=np.int32)  # what a symbol and the next one of its word join to
        at = np.flatnonzero(~last)
        joined[at] = self.pairs.get(sym[at], sym[at + 1])
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(sym):
            start = np.cumsum(size) - size
            rank = self.rank[joined]
            best = np.minimum.reduceat(rank, start)
            if (over := best == NONE).any():
                gone = np.repeat(over, size)
                out.append((word[over], size[over], sym[gone]))
                stay = ~gone
                sym, last, joined, rank = sym[stay], last[stay], joined[stay], rank[stay]
                word, size, best = word[~over], size[~over], best[~over]
                if not len(sym):
                    break
            of = np.repeat(np.arange(len(size)), size)
            place = np.flatnonzero(rank == best[of])
            piece, far = joined[place], np.diff(place, prepend=-self.reach)
            other = np.diff(of[place], prepend=-1) != 0
            # overlapping places form chains, of which every second one merges
            chosen = _since(np.flatnonzero((far > 1) | other), len(place)) % 2 == 0
            # a place whose piece joins on at once holds back the later ones that its chain of follow-ups may reach
            ask = np.flatnonzero(self.follows[piece] & chosen)
            if len(ask):
                after = self.joins_on(sym, last, place[ask], piece[ask], best[of[place[ask]]])
                if after.any():
                    holds = np.zeros(len(place), dtype=np.int64)
                    holds[ask] = after
                    before = np.cumsum(holds) - holds
                    group = np.flatnonzero(other | (far >= self.reach))
                    chosen &= before == np.repeat(before[group], np.diff(np.r_[group, len(place)]))
            place, piece = place[chosen], piece[chosen]
            sym[place] = piece
            last[place] |= last[place + 1]
            keep = np.ones(len(sym), dtype=bool)
            keep[place + 1] = False
            size = size - np.bincount(of[place], minlength=len(size))
            place = place - np.arange(len(place))  # each earlier merge has taken one symbol away
            sym, last, joined = sym[keep], last[keep], joined[keep]
            joined[place] = -1
            right = place[~last[place]]
            joined[right] = self.pairs.get(sym[right], sym[right + 1])
            left = place[place > 0] - 1
            left = left[~last[left]]
            joined[left] = self.pairs.get(sym[left], sym[left + 1])
        for w, n, _ in out:
            total[w] = n
        flat = np.empty(int(total.sum()), dtype=np.int32)
        begin = np.cumsum(total) - total
        for w, n, s in out:
            flat[np.repeat(begin[w] - (np.cumsum(n) - n), n) + np.arange(len(s))] = s
        return flat, total

    def words_to_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of distinct words and each word's number of ids; blanks stay single."""
        parts, owner = words, None
        if any(len(w) > LONG_WORD for w in words):
            cut = [self._cuts(w) if len(w) > LONG_WORD else [w] for w in words]
            parts = [p for c in cut for p in c]
            owner = np.repeat(np.arange(len(words)), [len(c) for c in cut])
        sym, total = self.merge(parts)
        if owner is not None:
            total = np.bincount(owner, weights=total, minlength=len(words)).astype(np.int64)
        # spell out what is no piece
        if not (odd := sym >= self.size).any():
            return sym, total
        cp = np.where(odd, sym - self.size, 0)
        width = np.where(odd, 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000), 1)
        of = np.repeat(np.arange(len(words)), total)
        begin = np.cumsum(width) - width
        nth = np.arange(int(width.sum())) - np.repeat(begin, width)
        sym, cp, odd, wide = np.repeat(sym, width), np.repeat(cp, width), np.repeat(odd, width), np.repeat(width, width)
        bits = cp >> 6 * (wide - 1 - nth) & 0x3F
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[wide] | cp >> 6 * (wide - 1)
        byte = np.where(wide == 1, cp, np.where(nth == 0, lead, 0x80 | bits))
        return np.where(odd, self.byte_id[byte & 0xFF], sym).astype(np.int32), np.bincount(of, weights=width, minlength=len(words)).astype(np.int64)

    def ids_of(self, texts: list[str | None], memory: Memory | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the number of ids of each."""
        memory = memory or Memory(self)
        number, words_of = [], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            if text:
                parts = text.replace(" ", BLANK).split(BLANK)  # the text has a blank put before it
                words_of[k] = len(parts)
                number.append(memory.numbers(parts))
        number = np.concatenate(number) if number else np.zeros(0, dtype=np.int64)
        return memory.gather(number, words_of)


class Memory:
    """The ids of words met before; word 0 is nothing behind a blank."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.ids, self.sizes = self.vocabulary.rung[1:2].copy(), np.ones(1, dtype=np.int64)
        self.new: list[str] = []

    def numbers(self, words: list[str]) -> np.ndarray:
        known = self.number
        for w in words:
            if w not in known:
                known[w] = len(known)
                self.new.append(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def learn(self) -> None:
        ids, sizes, group, chars = [self.ids], [self.sizes], [], 0
        for k, w in enumerate(self.new):
            group.append(BLANK + w)
            chars += len(w) + 1
            if chars > ROUND_CHARS or k == len(self.new) - 1:
                i, s = self.vocabulary.words_to_ids(group)
                ids.append(i)
                sizes.append(s)
                group, chars = [], 0
        self.ids, self.sizes, self.new = np.concatenate(ids), np.concatenate(sizes), []

    def gather(self, number: np.ndarray, words_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words with these numbers, dealt to texts of ``words_of`` words; blanks climb their ladder."""
        if self.new:
            self.learn()
        begin, size = np.cumsum(self.sizes) - self.sizes, self.sizes[number]
        flat = self.ids[np.repeat(begin[number] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        counts = np.bincount(np.repeat(np.arange(len(words_of)), words_of), weights=size, minlength=len(words_of)).astype(np.int64)
        # a run of lone blanks within a text becomes as many longest pieces as fit, and the pieces of the rest
        rung, rest = self.vocabulary.rung, self.vocabulary.rest
        lone = np.flatnonzero(flat == rung[1])
        if len(lone):
            text = np.searchsorted(np.cumsum(counts), lone, side="right")
            head = np.flatnonzero((np.diff(lone, prepend=-2) > 1) | (np.diff(text, prepend=-1) != 0))
            length = np.diff(np.r_[head, len(lone)])
            nth, of = np.arange(len(lone)) - np.repeat(head, length), np.repeat(length, length)
            tail = nth - of // len(rest) * len(rest)
            blanks = np.where(tail < 0, np.where(nth % len(rest) == 0, len(rest), 0), rest[of % len(rest), np.maximum(tail, 0)])
            flat[lone] = rung[blanks]
            gone = blanks == 0
            counts -= np.bincount(text[gone], minlength=len(counts))
            flat = np.delete(flat, lone[gone])
        if len(self.number) > REMEMBERED_WORDS or len(self.ids) > REMEMBERED_IDS:
            self.forget()
        return flat, counts


def _shared(spark: SparkSession, vocabulary_path: str):
    return spark.sparkContext.broadcast(Vocabulary(vocabulary_path))  # tables of the vocabulary's size


def encode(documents: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    shared = _shared(documents.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(shared.value)
        for batch in batches:
            ids, counts = shared.value.ids_of(batch.column(1).to_pylist(), memory)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, type=pa.int32()))], names=["doc_id", "ids"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, vocabulary_path: str = VOCABULARY, ids: str = "ids", name: str = "text") -> DataFrame:
    """``rows`` with the text of the column ``ids`` added under ``name`` (or a name like it that is free)."""
    shared = _shared(rows.sparkSession, vocabulary_path)
    name = fresh(rows, name)
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            column = batch.column(at)
            offsets = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.fill_null(-1).to_numpy()[offsets[0]:offsets[-1]].astype(np.int64)
            offsets = offsets - offsets[0]
            flat = np.where((flat >= 0) & (flat < v.size), flat, v.size)
            size, start = v.size_of[flat], v.start_of[flat]
            # the blank put before a text goes from its first id that is not empty
            full = np.flatnonzero(size)
            first = full[np.searchsorted(full, offsets[:-1])[np.searchsorted(full, offsets[:-1]) < np.searchsorted(full, offsets[1:])]]
            led = first[v.led[flat[first]]]
            size[led] -= 1
            start[led] += 1
            end = np.cumsum(size)
            data = v.data[np.repeat(start - (end - size), size) + np.arange(int(size.sum()))].tobytes()
            ends = np.r_[0, end][offsets].astype(np.int32)
            try:
                data.decode()
                whole = not any(ends[k] < len(data) and data[ends[k]] & 0xC0 == 0x80 for k in range(len(ends)))
            except UnicodeDecodeError:
                whole = False
            valid = column.is_valid()
            if whole and column.null_count == 0:
                text = pa.StringArray.from_buffers(len(column), pa.py_buffer(ends.tobytes()), pa.py_buffer(data))
            else:
                text = pa.array([data[a:b].decode(errors="fraudspark.one_byte") if ok else None for a, b, ok in zip(ends, ends[1:], valid.to_pylist(), strict=False)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, schema)
