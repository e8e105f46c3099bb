"""Hard negatives, periodic runs and piece encoding against brute force and the library they equal."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fraudspark.llm import hard_negatives, periodic, pieces, queries
from fraudspark.llm.common import prepared

SCHEMA = "doc_id long, text string, lang string, runs string, ids int, Collapsed string"


def frame(spark, rows):
    return prepared(spark).createDataFrame([(i, t, "en", "x", 1, "y") for i, t in rows], SCHEMA)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# hard negatives

def negatives_expected(rows, k=5, m=5):
    kept = []
    for vec_id, label, vec in rows:
        if label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(np.fmod(label + 1, 10))
        kept.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vec]))
    key = lambda p: (-p[0], p[1] is None, p[1] or 0)
    out = Counter()
    for a, (anchor, label, q) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [(max(-(2**63 - 1), min(2**63 - 1, sum(x * y for x, y in zip(q, v)))), i, lab == label) for r, (i, lab, v) in enumerate(kept) if r != a]
        for ps, pid, _ in sorted((s for s in scored if s[2]), key=key)[:m]:
            window = [s for s in scored if not s[2] and 80 * ps <= 100 * s[0] <= 100 * ps]
            for rank, (ns, nid, _) in enumerate(sorted(window, key=key)[:k], 1):
                out[(anchor, pid, rank, nid, ps, ns)] += 1
    return out


def embeddings(seed, n, dim=6, ids=900):
    r = np.random.default_rng(seed)
    rows = [(int(r.integers(0, ids)), int(r.integers(0, 4)), [float(x) for x in np.round(r.normal(0.2, 0.3, dim), 1)]) for _ in range(n)]
    return rows


CASES = {
    "plain": embeddings(1, 300),
    "hot label, ties and repeats": [(i, 1 if i % 3 else 2, [0.5, 0.25, float(i % 4) / 4]) for i in range(0, 600, 4)] * 2,
    "nulls": [(100, 1, [0.5, 0.5]), (None, 1, [0.5, 0.5]), (None, 2, [0.5, 0.4]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [0.5, None]), (6, 2, [float("nan"), 1.0]),
              (8, 2, [float("inf"), 1.0]), (9, 2, [0.45, 0.5]), (200, 1, [0.5, 0.5]), (300, 5, [0.1, 0.1]), (100, 1, [0.5, 0.5]), (11, 2, []), (12, 1, [0.7])],
    "negative scores": [(100, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-1.0]), (3, 2, [0.0]), (4, 1, [0.0])],
    "huge": [(100, 1, [1e38, 1.0]), (1, 1, [3e38, 1.0]), (2, 2, [3e38, 0.0]), (3, 2, [1e20, 5.0]), (4, 1, [2e10, 1.0]), (200, 2, [3e7, 2e7]), (6, 2, [2e7, 3e7]), (8, 3, [2e7, 2.5e7])],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block_bytes", [1, 1 << 24])  # an anchor a block, all in one
def test_hard_negatives(spark, name, block_bytes):
    rows = CASES[name][:120] if block_bytes == 1 and name == "plain" else CASES[name]
    if block_bytes == 1 and name == "hot label, ties and repeats":
        rows = rows[:60]
    df = prepared(spark).createDataFrame([(i, v, lab, "e", 1) for i, lab, v in rows], "vec_id long, embedding array<float>, label int, Anchor string, q int")
    got = hard_negatives.mine(df, block_bytes=block_bytes)
    assert Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect()) == negatives_expected(rows)


def test_best_cuts_between_batches():
    r = np.random.default_rng(0)
    group, score, ids = r.integers(0, 20, 5000), r.integers(-5, 5, 5000), r.permutation(5000)
    best = hard_negatives.Best(20, 3)
    for part in np.array_split(np.arange(5000), 40):
        best.add(group[part], score[part], ids[part])
        best.cut()
    expected = {g: sorted((-int(s), int(i)) for g2, s, i in zip(group, score, ids) if g2 == g)[:3] for g in range(20)}
    got = {g: [] for g in range(20)}
    for g, s, i in zip(*best.cut()):
        got[g].append((-int(s), int(i)))
    assert got == expected


# periodic runs

def runs_expected(words, least=12):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                if j - i + q >= max(least, 2 * q):
                    out.setdefault((i, j - i + q), q)
                i = j
            i += 1
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed_expected(words, runs):
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    return b" ".join(w for k, w in enumerate(words) if k not in drop)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


RUN_TEXTS = ["", None, " \t\n", "one two", "la " * 40, "a b " * 10 + "c " * 12 + "a b " * 6, "x y z " * 30 + "x", " ".join(fibonacci(300)), " ".join("abcab" * 9 + "abc" * 12),
             "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12", "é\x85b c" * 1 + " q r\x0bs " * 8, " ".join(f"w{i % 37}" for i in range(400)), "k " * 11, "k " * 12, "k l m n o p " * 2, "k l m n o " * 2]


@pytest.mark.parametrize("group", [30, 400_000])
def test_periodic_runs(spark, group, monkeypatch):
    monkeypatch.setattr(periodic, "GROUP_WORDS", group)
    r = np.random.default_rng(3)
    texts = RUN_TEXTS + [" ".join(f"t{x}" for x in r.integers(0, k, n)) for k in (1, 2, 3, 5) for n in (11, 12, 13, 60, 200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[4]), (None, texts[5])]
    got = Counter((x.doc_id, x.n_words, tuple(map(tuple, x.runs)), x.collapsed) for x in periodic.periodic_runs(frame(spark, rows)).collect())
    expected = Counter()
    for i, t in rows:
        words = (t or "").encode().split()
        runs = runs_expected(words)
        expected[(i, len(words), tuple(runs), collapsed_expected(words, runs).decode())] += 1
    assert got == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4), st.sampled_from([2, 5, 11, 12]))
def test_runs_property(texts, least):
    got = periodic.Searcher([np.array(t, dtype=np.int64) for t in texts], 3, least).runs()
    assert got == [runs_expected(t, least) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=80), st.data())
def test_agreement(text, data):
    whole = np.array([9, *text, 10], dtype=np.int64)
    levels = periodic.grammar(whole, np.array([0, len(whole) - 1]), 11)
    a, b = data.draw(st.integers(1, len(text))), data.draw(st.integers(1, len(text)))
    if a != b:
        n = 0
        while max(a, b) + n < len(whole) and whole[a + n] == whole[b + n]:
            n += 1
        assert periodic.agreement(levels, np.array([a]), np.array([b]))[0] == n


def test_runs_of_a_long_text():
    t = np.r_[np.arange(50_000), np.tile(np.arange(700), 60), np.zeros(40_000, dtype=np.int64)]
    got = periodic.Searcher([t], 50_000, 12).runs()[0]
    assert (50_000, 42_001, 700) in got and (92_000, 40_000, 1) in got


def test_periodic_query(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 50}" for k in range(i % 60))) for i in range(150)] + [(None, "a b c " * 5), (1000, None), (1001, "")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect())
    expected, planted = Counter(), 0
    for i, t in rows:
        words = (t or "").encode().split()
        n, h = len(words), zlib.crc32(b"" if i is None else str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            planted += 1
        runs = runs_expected(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        expected[(i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()), sha(collapsed_expected(words, runs)))] += 1
    assert planted > 5 and got == expected


# pieces

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.VOCABULARY))


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary()


HARD = ["", None, " ", "  ", "\t\n", " lead", "trail ", "a\x00b", "▁", "▁▁ x", "the  there\t fish", " " * 15, " " * 16, " " * 31 + "x", "x" + " " * 47, "e  \t", "é日本😀ﬁＡ", "thethethe" * 50, "ab" * 500,
        "x" * 5000, "ing" * 700, "0123456789" * 100, "thequickbrownfox" * 60, "<s></s><unk><0x41>", "aaaaaaa bbbbb", "​﻿�", "é" * 40, "Hello, World!\r\n" * 5]


def test_pieces_equal_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(3, HARD[4]), (None, "null id")]
    encoded = pieces.encode(frame(spark, rows))
    got = Counter((r.doc_id, tuple(r.ids), r.text) for r in pieces.decode(encoded).collect())
    expected = Counter()
    for i, t in rows:
        ids = library.encode(t or "")
        expected[(i, tuple(ids), library.decode(ids))] += 1
    assert got == expected


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="aethnig ▁\t1", max_size=200)))
def test_pieces_property(library, vocabulary, text):
    text = text.encode("utf-8", "ignore").decode()
    assert vocabulary.ids_of([text])[0].tolist() == library.encode(text)


def test_pieces_of_long_words(library, vocabulary):
    r = random.Random(5)
    for text in ("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), "the" * 20_000, "".join(r.choices("et", k=2_000)), "information" * 3_000, " " * 10_001 + "x"):
        assert vocabulary.ids_of([text])[0].tolist() == library.encode(text)


def test_pieces_forget(library, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(pieces, "ROUND_CHARS", 10)
    memory = pieces.Memory(vocabulary)
    for text in ("a bc  def", "", "ghi a bc", "x  y z " * 4):
        assert vocabulary.ids_of([text, "q"], memory)[0].tolist() == library.encode(text) + library.encode("q")


def test_decode_any_ids(spark, library):
    lists = [None, [], [1, 2], [0], [5000, 29871], [3 + 0xC3, 3 + 0xA9], [3 + 0xC3], [3 + 0xF0, 3 + 0x9F, 5000], [3 + 0x80, 3 + 0x80], [1, 28705, 5000], [5000, 99_999, -1]]
    df = prepared(spark).createDataFrame([(k, v, "t") for k, v in enumerate(lists)], "doc_id long, ids array<int>, Text string")
    got = {r["doc_id"]: r["text_1"] for r in pieces.decode(df).collect()}
    for k, ids in enumerate(lists):
        if ids is not None and k != len(lists) - 1:
            assert got[k] == library.decode(ids), ids
    assert got[0] is None and got[len(lists) - 1] == library.decode([5000])


def test_empty_tables(spark):
    none = frame(spark, [])
    assert pieces.decode(pieces.encode(none)).count() == 0 and periodic.periodic_runs(none).count() == 0
