"""Toxicity: maximum-scoring segments over token log-odds, calibrated by extreme values.

Learning, from a bounded sample of the labelled rows (``SAMPLE_ROWS`` of each class, by hash of the
id; the bound is a parameter):

* A token's log-odds compare the share of toxic and of other documents that hold it, with Dirichlet
  priors: a token's prior counts follow the class shares of its stem (first letters), whose own
  prior is the corpus share.  Tokens whose log-odds are not significantly positive are background and
  cost ``DRIFT``, and so are repeats of a token as long as the drift since it last counted has not used up
  its score; after that it counts again.  A word that was never seen takes the log-odds of its stem.
* Segment scores of background text follow an extreme-value law P(S >= x) ~ K n exp(-lambda x).
  lambda solves the Karlin-Altschul equation over the clean documents' token frequencies, K is
  fitted to the largest segments of clean documents in the held-back part of the sample.
* A document's evidence is the sum over its significant segments of lambda S - ln(K n), from the
  strongest on, each by the share of its score from words that no stronger one has: the odds compare
  documents that hold a word, so a second passage of the same words is found and adds nothing.  A
  logistic curve fitted on the held-back part turns evidence into a probability.

Scoring reads whole texts: a linear-time scan (Ruzzo and Tompa) finds every maximal segment.  Only the
text is an input of the score.  The model is a bounded table (``MAX_TERMS``), sent to the tasks.

Defined results
    null text, empty text  no segment: the probability that no evidence stands for
    no labels, one class   no term is learnt; the score is the share of toxic labels (0 without labels)
    labels                 null ids and null labels are left out; of repeated ids the largest label counts
    repeated rows          each row is scored by itself; null ids are passed through
    empty table            empty result
    extra columns          ignored by ``score``, kept by ``remove_toxic`` whatever their names
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, held_out, materialize

#: Labelled rows of each class that the classifier is fitted on, at most.
SAMPLE_ROWS = 20_000
#: Terms that the model holds at most (those with the most significant log-odds).
MAX_TERMS = 200_000
#: Weight of the stem's class shares, and of the corpus share, as prior documents; least prior count.
STEM_PRIOR, CORPUS_PRIOR, FLOOR = 2.0, 4.0, 0.5
#: Log-odds must exceed zero by so many standard deviations.
SIGNIFICANT = 3.0
#: Log-odds of tokens that are no background.
LEAST = 1.5
#: What a background token costs a segment.
DRIFT = 0.3
#: Letters of a stem.
STEM = 4
FOLDS = 5

_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)  # words, and stems as "stem*"
    lam: float = 1.0
    k: float = 1.0
    a: float = 0.0  # probability = 1 / (1 + exp(-(a + b * evidence)))
    b: float = 1.0
    constant: float | None = 0.0  # set where nothing could be learnt


def segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last token, score).

    ``scores`` are the positive tokens as (position, score); every other token costs ``drift``.  Ruzzo
    and Tompa's scan over the positive tokens with the cost of the gaps between them, which decides
    the same as over all tokens since maximal segments start and end with positive tokens.
    """
    stack: list[list] = []  # first, last, cumulative score before and after
    total, last = 0.0, None
    for at, s in scores:
        if last is not None:
            total -= drift * (at - last - 1)
        left, total = total, total + s
        last = at
        new = [at, at, left, total]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j -= 1
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
    return [(a, b, r - l) for a, b, l, r in stack]


def _positive(words: list[str], terms: dict[str, float]) -> list[tuple[int, float]]:
    """Positions and scores of tokens with positive log-odds.  A repeat is background until the drift
    since the token last counted has used up its score, so that a passage counts whatever came before it."""
    out, counted = [], {}
    for i, w in enumerate(words):
        s = terms.get(w)
        if s is None and len(w) > STEM:
            s = terms.get(w[:STEM] + "*")
        if s is not None and s > 0 and (w not in counted or DRIFT * (i - counted[w]) >= s):
            counted[w] = i
            out.append((i, s))
    return out


def passages(words: list[str], terms: dict[str, float]) -> list[tuple[float, float]]:
    """(score, share of it from words that no stronger one has) of the maximal segments, strongest first."""
    scores = _positive(words, terms)
    at, seen, out = [i for i, _ in scores], set(), []
    for a, b, s in sorted(segments(scores), key=lambda x: (-x[2], x[0])):
        inside = scores[bisect_left(at, a):bisect_right(at, b)]
        out.append((s, sum(x for i, x in inside if words[i] not in seen) / sum(x for _, x in inside)))
        seen.update(words[i] for i, _ in inside)
    return out


def evidence(text: str | None, model: Model) -> tuple[float, int, float]:
    """Sum over significant segments of lambda S - ln(K n) by their share of new words, their number, and the largest S."""
    words = tokens(text)
    found = passages(words, model.terms)
    x = [(model.lam * s - math.log(max(model.k * len(words), 1e-9)), share) for s, share in found]
    return sum(v * share for v, share in x if v > 0), sum(v > 0 for v, _ in x), max((s for s, _ in found), default=0.0)


def probability(e: float, model: Model) -> float:
    if model.constant is not None:
        return model.constant
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, model.a + model.b * min(e, 200.0)))))


def _labelled(documents: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, y, back) of the sampled training rows, and the number of training labels of each class."""
    y = (labels.select("doc_id", F.col("toxic").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
         .groupBy("doc_id").agg(F.max("y").alias("y")).filter(~held_out("doc_id", FOLDS)))
    # labels of other documents take no place in the sample, and none in the sizes of the classes
    y = materialize(y.join(documents.select("doc_id").distinct(), "doc_id", "left_semi"), "toxic_labels")
    size = {int(r["y"]): int(r["n"]) for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = lambda c: y.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = materialize(part(0).unionByName(part(1)), "toxic_sample")
    # at most 2 * rows ids of 12 bytes; of rows that share an id the smallest text is learnt from
    text = (documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    back = F.pmod(F.xxhash64("doc_id", F.lit("back")), F.lit(4)) == 0
    return materialize(text.select("text", "y", back.alias("back")), "toxic_text"), size


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class that hold a term, and its occurrences in clean documents."""
    held: dict[tuple[str, int], list[int]] = {}

    def out() -> pd.DataFrame:
        frame = pd.DataFrame([(t, y, *v) for (t, y), v in held.items()], columns=["term", "y", "docs", "n"])
        held.clear()
        return frame

    for batch in batches:
        for text, y in zip(batch["text"], batch["y"], strict=True):
            for w, n in Counter(tokens(text)).items():
                c = held.setdefault((w, y), [0, 0])
                c[0] += 1
                c[1] += n
            if len(held) > 300_000:
                yield out()
    yield out()


def _log_odds(train: DataFrame) -> tuple[list, dict[int, int], int]:
    """Significant terms (term, log-odds, clean occurrences), documents of each class, clean tokens."""
    size = {int(r["y"]): int(r["n"]) for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = train.select("text", "y").mapInPandas(_count, "term string, y int, docs long, n long")
    side = lambda c, col: F.sum(F.when(F.col("y") == c, F.col(col)).otherwise(0))
    words = materialize(counts.groupBy("term").agg(side(1, "docs").alias("d1"), side(0, "docs").alias("d0"), side(0, "n").alias("n0")), "toxic_terms")
    clean = words.agg(F.sum("n0")).first()[0] or 0
    if not size.get(0) or not size.get(1):
        return [], size, clean
    t1, t0 = float(size[1]), float(size[0])
    stems = (words.filter(F.length("term") > STEM).groupBy(F.substring("term", 1, STEM).alias("stem"))
             .agg(F.sum("d1").alias("s1"), F.sum("d0").alias("s0"), F.sum("n0").alias("n0")))

    def odds(d1, d0, prior1, prior0, weight):
        # prior documents: ``weight`` of them, dealt to the classes as prior1 : prior0
        a1, a0 = F.greatest(F.lit(FLOOR), weight * prior1 / (prior1 + prior0)), F.greatest(F.lit(FLOOR), weight * prior0 / (prior1 + prior0))
        x1, x0 = d1 + a1, d0 + a0
        delta = F.log(x1 / (t1 + a1)) - F.log(x0 / (t0 + a0))
        return delta, delta / F.sqrt(1 / x1 + 1 / x0)

    # a stem's prior: the class sizes; a word's prior: the documents of its stem, pulled to the class sizes
    c1, c0 = F.lit(CORPUS_PRIOR * t1 / (t1 + t0)), F.lit(CORPUS_PRIOR * t0 / (t1 + t0))
    ds, zs = odds(F.col("s1"), F.col("s0"), c1, c0, F.lit(CORPUS_PRIOR))
    stems = stems.select(F.col("stem"), "s1", "s0", "n0", ds.alias("delta"), zs.alias("z"))
    # short words have no stem: they pass by the join
    long_, short = words.filter(F.length("term") > STEM), words.filter(F.length("term") <= STEM)
    with_stem = long_.withColumn("stem", F.substring("term", 1, STEM)).join(stems.select("stem", "s1", "s0"), "stem")
    alone = short.select(F.lit(None).cast("string").alias("stem"), *short.columns, F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s0"))
    dw, zw = odds(F.col("d1"), F.col("d0"), F.col("s1") + c1, F.col("s0") + c0, F.lit(STEM_PRIOR))
    scored = with_stem.unionByName(alone).select("term", "stem", dw.alias("delta"), zw.alias("z"), "n0")
    toxic = (F.col("z") >= SIGNIFICANT) & (F.col("delta") > LEAST)
    found = scored.select("term", "delta", "z", "n0").unionByName(stems.select(F.concat("stem", F.lit("*")).alias("term"), "delta", "z", "n0")).filter(toxic)
    terms = [(r["term"], r["delta"], r["n0"]) for r in found.orderBy(F.col("z").desc(), "term").limit(MAX_TERMS).collect()]
    # a word that is known and not significant must hide its stem: it stays in the table with score 0; a
    # stem whose hiding words do not all fit goes
    hiding = scored.filter(~toxic).join(F.broadcast(stems.filter(toxic).select("stem")), "stem", "left_semi")
    many = {r["stem"]: r["n"] for r in hiding.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "stem").limit(MAX_TERMS).collect()}
    fits, left = set(), MAX_TERMS
    known = {t[:-1] for t, _, _ in terms if t.endswith("*")}
    unhidden = known - many.keys() if len(many) < MAX_TERMS else set()
    for t, _, _ in terms:
        if t.endswith("*") and t[:-1] in many and many[t[:-1]] <= left:
            fits.add(t[:-1])
            left -= many[t[:-1]]
    terms = [t for t in terms if not t[0].endswith("*") or t[0][:-1] in fits or t[0][:-1] in unhidden]
    if fits:
        kept = F.broadcast(words.sparkSession.createDataFrame([(s,) for s in sorted(fits)], "stem string"))
        terms += [(r["term"], 0.0, r["n0"]) for r in hiding.join(kept, "stem", "left_semi").select("term", "n0").collect()]  # at most MAX_TERMS
    return terms, size, clean


def _solve_lambda(terms: list, clean: int, drift: float) -> float:
    """lambda > 0 with E[exp(lambda s)] = 1 over the clean documents' tokens (half a count for unseen ones)."""
    s = np.array([x for _, x, _ in terms if x > 0])
    f = np.array([n + 0.5 for _, x, n in terms if x > 0]) / (clean + 1.0)
    if not len(s) or f.sum() >= 1:
        return 1.0
    g = lambda v: float((f * np.exp(np.minimum(v * s, 500))).sum() + (1 - f.sum()) * math.exp(-v * drift) - 1)
    lo, hi = 1e-4, 1e-4
    while g(hi) < 0 and hi < 50:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if g(mid) > 0 else (mid, hi)
    return max(hi, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one feature: damped Newton steps, a weak prior on the slope."""
    prior = math.log((w[y == 1].sum() + 0.5) / (w[y == 0].sum() + 0.5))
    design, centre, ridge = np.column_stack((np.ones(len(x)), x)), np.array([prior, 1.0]), np.array([0.05, 1.0])

    def loss(beta):
        z = design @ beta
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + (ridge * (beta - centre) ** 2).sum() / 2)

    beta = centre.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        grad = design.T @ (w * (p - y)) + ridge * (beta - centre)
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9 or size <= 1e-6:
            break
    return float(beta[0]), float(max(beta[1], 1e-6))


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the labelled rows whose crc32(doc_id) mod 5 is not 0."""
    sample, size = _labelled(documents, labels, rows)
    prior = size.get(1, 0) / max(1, size.get(0, 0) + size.get(1, 0))
    terms, _, clean = _log_odds(sample.filter("not back"))
    if not any(s > 0 for _, s, _ in terms):
        return Model(constant=float(prior))
    model = Model({t: s for t, s, _ in terms}, lam=_solve_lambda(terms, clean, DRIFT), constant=None)

    def largest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(int(y), w := tokens(t), [p for p in passages(w, model.terms) if p[1] > 0]) for t, y in zip(b["text"], b["y"], strict=True)]
            yield pd.DataFrame({"y": [y for y, *_ in out], "n": [len(w) for _, w, _ in out],
                                "s": [[s for s, _ in found] for *_, found in out], "share": [[x for _, x in found] for *_, found in out]})

    # one row for each held-back row of the sample, so at most 2 * rows; no more segments than the row has terms
    back = sample.filter("back").select("text", "y").mapInPandas(largest, "y int, n long, s array<double>, share array<double>").collect()
    if not back or len({r["y"] for r in back}) < 2:
        back = sample.select("text", "y").mapInPandas(largest, "y int, n long, s array<double>, share array<double>").collect()
    # K: clean documents with a segment of at least the median term's score, against what the law expects
    x = float(np.median([s for _, s, _ in terms if s > 0]))
    over = sum(max(r["s"], default=0.0) >= x for r in back if r["y"] == 0)
    model.k = (over + 0.5) / max(sum(r["n"] for r in back if r["y"] == 0) * math.exp(-model.lam * x), 1e-9)
    e = np.array([min(200.0, sum(max(0.0, model.lam * s - math.log(max(model.k * r["n"], 1e-9))) * x for s, x in zip(r["s"], r["share"], strict=True))) for r in back])
    y = np.array([r["y"] for r in back])
    w = np.array([size[int(v)] / max(1, int((y == v).sum())) for v in y]) * len(y) / sum(size.values())
    model.a, model.b = _logistic(e, y, w)
    return model


def _scores(spark, model: Model):
    shared = spark.sparkContext.broadcast(model)

    def of(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        out = [evidence(t, m) for t in texts]
        return pd.DataFrame({"score": [probability(o[0], m) for o in out], "n_segments": [o[1] for o in out], "top_segment": [o[2] for o in out]})

    return F.pandas_udf(of, "score double, n_segments long, top_segment double")


def score(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and the number and largest score of significant passages."""
    udf = _scores(documents.sparkSession, fit(documents, labels, rows))
    return (documents.select("doc_id", udf(F.col("text")).alias("r"))
            .select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), "r.score", (F.col("r.score") >= 0.5).cast("int").alias("predicted"),
                    "r.n_segments", "r.top_segment"))


def remove_toxic(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with a score below 0.5, with all their columns."""
    udf, name = _scores(documents.sparkSession, fit(documents, labels, rows)), fresh(documents, "toxicity")
    return documents.withColumn(name, udf(F.col("text"))["score"]).filter(F.col(name) < 0.5).drop(name)
