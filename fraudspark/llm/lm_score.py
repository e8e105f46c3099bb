"""Language-model scores: marginal likelihood over the lattice of subword segmentations.

The pieces and their starting weights come from an existing vocabulary file (never trained here): its
scores rank the pieces, and the ranks give a Zipf-Mandelbrot prior.  The model's piece probabilities
are the posterior means under that prior of the expected piece counts in the training documents,
found by ``ROUNDS`` forward-backward passes over the distinct training words.  A word's probability
is the sum over all its segmentations, by a forward recursion kept in log space; a document's is the
product over its words and one end token.  Characters outside the vocabulary are spelt in bytes.

Words are counted once over the whole corpus, and each distinct word's lattice is walked once.  The
most frequent words (``HEAD_WORDS`` of at most ``HEAD_BYTES`` bytes: a bounded table) are looked up
in the tasks that read the documents; every other word of a document is joined with the word table
by a shuffle on the word, pre-aggregated per document.

Defined results
    null text, empty text  no words, one end token
    null doc_id            counts as the empty text in the fold, so it is held out
    empty training set     N = V = 0: base terms are log10(0.1 / 0.1); the prior alone scores
    repeated rows          each row is scored by itself (and counted, if in training)
    very long texts        counted whole; a word of n characters takes no memory beside itself to score, and 24 n bytes
                           to count its pieces
    ties                   of equally frequent words the smaller bytes are looked up in the tasks; no score depends on it
    empty table            empty result
    extra columns          ignored
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, materialize, partitions

FOLDS = 10
ALPHA = 0.1
#: The existing vocabulary, as public_tokenizers.path() names it; a path may be given instead.
VOCABULARY = "piece_bpe_32k.model"
ROUNDS = 2
#: Weight of the prior over pieces, in pieces.
PRIOR_PIECES = 20_000.0
#: Offset of the Zipf-Mandelbrot prior; share of it that the bytes and the end token get.
OFFSET, BYTE_SHARE, END_SHARE = 10.0, 0.01, 0.01
HEAD_WORDS, HEAD_BYTES = 1 << 17, 64
#: Distinct words that a task counts before it hands the counts on.
FLUSH = 300_000
MARK = "▁"
END = "\0end"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII white space only


def vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Prior probability of every piece, of the 256 bytes ("<0x..>") and of the end token."""
    import sentencepiece

    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    plain.sort(key=lambda i: -model.get_score(i))
    weight = 1.0 / (np.arange(len(plain)) + OFFSET)
    weight *= (1 - BYTE_SHARE - END_SHARE) / weight.sum()
    out = {model.id_to_piece(i): float(w) for i, w in zip(plain, weight, strict=True)}
    out |= {f"<0x{b:02X}>": BYTE_SHARE / 256 for b in range(256)}
    return out | {END: END_SHARE}


#: Forward values below TINY are raised by 1 / TINY, so that products never leave the range of a double.
TINY = 1e-200


#: Characters of a word above which its recursion keeps no arcs and no values that it can do without.
LONG_WORD = 4_096


class Lattice:
    """Recursions over the segmentations of a word.

    The forward value of a position is kept as a mantissa and a count of raises, that is in log space
    with one logarithm at the end, whatever the word's length.  It depends on the letters before the
    position only, so words that come in order share the values of their common start.  A longer word than
    ``LONG_WORD`` shares nothing: its score needs the values of the longest piece only, and its expected
    counts two doubles a character, with the arcs found once more on the way back.
    """

    def __init__(self, probability: dict[str, float]):
        self.p = {p: w for p, w in probability.items() if p != END}
        self.suffixes = {p[k:] for p in self.p for k in range(len(p))}
        self.longest = max(map(len, self.p), default=1)
        self.last, self.f, self.raised, self.arcs = "", [1.0], [0], [[]]

    def ending(self, s: str, j: int) -> list[tuple[int, str, float]]:
        """Arcs (from, piece, probability) that end at position ``j``."""
        here, i, get, suffixes = [], j - 1, self.p.get, self.suffixes
        while i >= 0 and (piece := s[i:j]) in suffixes:
            if (w := get(piece)) is not None:
                here.append((i, piece, w))
            i -= 1
        if not here or here[0][0] != j - 1:  # the character is no piece: spell it
            here.append((j - 1, s[j - 1], math.prod(self.p[f"<0x{b:02X}>"] for b in s[j - 1].encode("utf-8", "replace"))))
        return here

    def forward(self, s: str) -> None:
        """Fill f, raised and arcs of every position."""
        common, last = 0, self.last
        while common < len(s) and common < len(last) and s[common] == last[common]:
            common += 1
        f, raised, arcs = self.f, self.raised, self.arcs
        del f[common + 1:], raised[common + 1:], arcs[common + 1:]
        for j in range(common + 1, len(s) + 1):
            total, up = 0.0, raised[-1]
            here = self.ending(s, j)
            for i, _, w in here:
                total += f[i] * w if raised[i] == up else f[i] * w / TINY ** (up - raised[i])
            if total < TINY:
                total, up = total / TINY, up + 1
            f.append(total)
            raised.append(up)
            arcs.append(here)
        self.last = s

    def _long(self, s: str, keep: bool) -> tuple[array, array]:
        """Forward values and raises of a long word; without ``keep`` those of the last positions only."""
        f, raised = array("d", [1.0]), array("q", [0])
        base = 0  # position of the first value held
        for j in range(1, len(s) + 1):
            total, up = 0.0, raised[-1]
            for i, _, w in self.ending(s, j):
                x = f[i - base] * w
                total += x if raised[i - base] == up else x / TINY ** (up - raised[i - base])
            if total < TINY:
                total, up = total / TINY, up + 1
            f.append(total)
            raised.append(up)
            if not keep and len(f) > 64 * self.longest:
                cut = len(f) - self.longest - 1
                del f[:cut], raised[:cut]
                base += cut
        return f, raised

    def score(self, word: bytes) -> float:
        """Natural log of the word's marginal probability."""
        s = MARK + word.decode("utf-8", "replace")
        if len(s) > LONG_WORD:
            f, raised = self._long(s, False)
        else:
            self.forward(s)
            f, raised = self.f, self.raised
        return math.log(f[-1]) + raised[-1] * math.log(TINY)

    def expect(self, word: bytes, weight: float, into: dict[str, float]) -> None:
        """Add the expected piece counts of ``weight`` occurrences of the word.

        Backwards from the end, a position's posterior mass is dealt to the arcs that end there in
        proportion to what they brought to its forward value.
        """
        s = MARK + word.decode("utf-8", "replace")
        if len(s) > LONG_WORD:
            (f, raised), arcs, mass = self._long(s, True), None, array("d", bytes(8 * (len(s) + 1)))
        else:
            self.forward(s)
            f, raised, arcs, mass = self.f, self.raised, self.arcs, [0.0] * len(self.f)
        mass[-1] = weight
        for j in range(len(f) - 1, 0, -1):
            if not mass[j]:
                continue
            m = mass[j] / f[j]
            for i, piece, w in arcs[j] if arcs is not None else self.ending(s, j):
                x = m * f[i] * w
                if raised[i] != raised[j]:
                    x /= TINY ** (raised[j] - raised[i])
                mass[i] += x
                if piece in self.p:
                    into[piece] = into.get(piece, 0.0) + x
                else:
                    for byte in piece.encode("utf-8", "replace"):
                        part = f"<0x{byte:02X}>"
                        into[part] = into.get(part, 0.0) + x


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, c in training documents, n in all) of every distinct word."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        train, held = Counter(), Counter()

        def out() -> pd.DataFrame:
            words = list(train.keys() | held.keys())
            c = [train[w] for w in words]
            frame = pd.DataFrame({"word": words, "c": np.array(c, dtype=np.int64), "n": np.array([held[w] + k for w, k in zip(words, c, strict=True)], dtype=np.int64)})
            train.clear()
            held.clear()
            return frame

        for batch in batches:
            for text, h in zip(batch["text"], batch["held_out"], strict=True):
                (held if h else train).update(words_of(text))
                if len(train) + len(held) > FLUSH:
                    yield out()
        yield out()

    counted = docs.select("text", "held_out").mapInPandas(count, "word binary, c long, n long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def fit(words: DataFrame, train_docs: int, prior: dict[str, float], rounds: int = ROUNDS) -> dict[str, float]:
    """Piece probabilities after ``rounds`` of expectation over the training words (word, c)."""
    spark = words.sparkSession
    probability = prior
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Lattice(probability))

        def expect(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            into: dict[str, float] = {}
            for b in batches:
                for w, c in zip(b["word"], b["c"], strict=True):
                    shared.value.expect(bytes(w), float(c), into)
            yield pd.DataFrame({"piece": list(into), "x": list(into.values())}).astype({"piece": "object", "x": "float64"})

        # one row for each piece of the vocabulary at most
        counts = dict(map(tuple, words.filter("c > 0").select("word", "c").mapInPandas(expect, "piece string, x double")
                          .groupBy("piece").agg(F.sum("x").alias("x")).collect()))
        counts[END] = float(train_docs)
        total = sum(counts.values()) + PRIOR_PIECES
        probability = {p: (counts.get(p, 0.0) + PRIOR_PIECES * w) / total for p, w in prior.items()}
    return probability


def score(documents: DataFrame, vocabulary_path: str = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row."""
    spark = documents.sparkSession
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out("doc_id", FOLDS).alias("held_out"))
    # in order, so that neighbours share work, and dealt out by number: the rows are few bytes and much
    # work, which sizes by bytes would put into few tasks
    counted = materialize(_word_counts(docs), "lm_counts")
    counted = materialize(counted.repartitionByRange(partitions(spark), "word").sortWithinPartitions("word"), "lm_sorted")
    train_docs = docs.filter(~F.col("held_out")).count()
    sums = counted.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).first()
    total, distinct = (sums[0] or 0) + train_docs, sums[1] + (train_docs > 0)
    probability = fit(counted, train_docs, vocabulary(vocabulary_path), rounds)
    shared, end_lp = spark.sparkContext.broadcast(Lattice(probability)), math.log10(probability[END])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["lp"] = [shared.value.score(bytes(w)) / math.log(10) for w in b["word"]]
            yield b[["word", "c", "n", "lp"]]

    table = materialize(counted.mapInPandas(walk, "word binary, c long, n long, lp double"), "lm_words")
    frequent = table.filter(F.length("word") <= HEAD_BYTES).orderBy(F.col("n").desc(), "word").limit(HEAD_WORDS).select("word", "c", "lp").collect()
    counts = np.array([r["c"] for r in frequent] + [0], dtype=np.int64)  # one place more: -1 is never counted
    head = spark.sparkContext.broadcast(({bytes(r["word"]): i for i, r in enumerate(frequent)}, counts, np.log10(counts + ALPHA), np.array([r["lp"] for r in frequent] + [0.0])))

    def per_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row of sums over frequent words for each document, keyed by a text that is no word (a
        space and its number), and one row for each of its other distinct words."""
        place, c, base, lp = head.value
        get = place.get
        for batch in batches:
            rids, texts = batch["rid"].tolist(), [words_of(t) for t in batch["text"]]
            size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            at = np.fromiter((get(w, -1) for words in texts for w in words), dtype=np.int64, count=int(size.sum()))
            doc = np.repeat(np.arange(len(texts)), size)
            add = lambda x: np.bincount(doc, weights=np.where(at >= 0, x[at], 0.0), minlength=len(texts))
            yield pd.DataFrame({"rid": batch["rid"], "word": [b" %d" % r for r in rids], "times": 0, "n_tokens": size + 1,
                                "n_known": add((c > 0).astype(float)).astype(np.int64), "base": add(base), "lp": add(lp),
                                "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"].astype("boolean")})
            starts = np.cumsum(size) - size
            far = np.flatnonzero(at < 0)
            rare = Counter((d, texts[d][k]) for d, k in zip(doc[far].tolist(), (far - starts[doc[far]]).tolist(), strict=True))
            if rare:
                yield pd.DataFrame({"rid": [rids[d] for d, _ in rare], "word": [w for _, w in rare], "times": list(rare.values()), "n_tokens": 0, "n_known": 0,
                                    "base": 0.0, "lp": 0.0, "doc_id": pd.array([None] * len(rare), dtype="Int64"), "held_out": pd.array([None] * len(rare), dtype="boolean")})

    parts = docs.withColumn("rid", F.monotonically_increasing_id()).mapInPandas(
        per_document, "rid long, word binary, times long, n_tokens long, n_known long, base double, lp double, doc_id long, held_out boolean")
    met = parts.join(table.select("word", F.col("c").alias("w_c"), F.col("lp").alias("w_lp")), "word", "left")
    sums = met.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("w_c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(F.col("times") > 0, F.col("times") * F.log10(F.col("w_c") + ALPHA)).otherwise(0.0)).alias("base"),
        F.sum(F.col("lp") + F.when(F.col("times") > 0, F.col("times") * F.col("w_lp")).otherwise(0.0)).alias("lp"))
    end, denominator = math.log10(train_docs + ALPHA), math.log10(total + ALPHA * (distinct + 1))
    return sums.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + int(train_docs > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end) - F.col("n_tokens") * F.lit(denominator)).alias("base_score"), (F.col("lp") + F.lit(end_lp)).alias("score"))
