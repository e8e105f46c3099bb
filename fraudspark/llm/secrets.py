"""Secret scan: base patterns, and novelty against a dictionary-primed zstandard compressor.

Base kinds are leftmost non-overlapping matches in code points.  Beyond them, strings of key-like
characters that stand near a sensitive word are candidates.  A candidate's novelty is what it adds
to the compressed size of the text around it, when the compressor is primed with a dictionary of
common code and identifier words: identifiers and prose cost little, random strings nearly their
entropy.  What random strings add depends on their alphabet, their length and the text around them, so
a candidate is held against random strings of its own alphabet and length in the same place;
candidates that are made of words are not held against them.  Incompressible candidates are reported
as kind ``novel``.  Lines of a key are one context: a candidate parted from a reported one by white space
only needs no sensitive word of its own.

Defined results
    null text       counts as the empty text: no spans, digest of the empty string
    very long text  scanned whole
    ties            spans with one start are listed in the order of KINDS
    repeated rows   each row is scanned by itself; null ids are passed through
    empty table     empty result
    extra columns   ignored
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter
from functools import cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run is maximal, so this is the run of [0-9a-f]+ with 24 characters or more
#: Words that make a context sensitive, and how far around a candidate they count.
_SENSITIVE = re.compile(r"(?ai)passw|secret|token|api_?key|credential|auth|private|bearer|access|signature|akia")
_SENSITIVE_WORDS = ("passw", "secret", "token", "apikey", "api_key", "credential", "auth", "private", "bearer", "access", "signature", "akia")
#: Characters of a candidate, and how many different ones it has at least (rules and paddings are no keys).
SHORTEST, DIFFERENT = 16, 6
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
REACH = 48
#: Text around a candidate that the compressor has seen before it.
CONTEXT = 2048
#: A candidate is reported when it adds at least so many bytes per character (random hex adds 1 and more, identifiers with digits up to 0.9) ...
NOVELTY = 0.95
#: ... or, unless it is made of words, at least this share of what random strings in its place add.
RELATIVE = 0.75
#: Random strings that a candidate is held against.
RANDOM = 4
#: A candidate is made of words when its pairs of letters are so much likelier in words than at random (nats per character).
WORDY = 0.1
#: Longer strings are measured piece by piece, so a measurement stays small.
PIECE = 256

#: Code and identifier words that prime the compressor.
_IDENTIFIERS = """
password passwd secret token apikey api_key access_key secret_key private_key public_key client_id client_secret
authorization bearer basic credential credentials username user_name user_id session session_id cookie header headers
content_type application_json request response status status_code message error exception timeout connection
connect database host hostname port server client config configuration settings environment variable export import
from return function class public private protected static final void string integer boolean float double number
object array list dict map tuple set get put post delete update insert select where order group limit offset
index value values key keys name names type types length size count total result results data item items
true false null none undefined self this super new async await promise callback handler listener event
file filename path directory folder open read write close append stream buffer bytes encode decode base64
hash digest md5 sha1 sha256 signature verify encrypt decrypt cipher certificate
http https www localhost example index html javascript python java org com net io
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 placeholder changeme example your_token_here xxxxxxxxxxxxxxxx
""".split()


@cache
def _compressor() -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(" ".join(_IDENTIFIERS).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=6, dict_data=primed, write_checksum=False, write_content_size=False)


def novelty(before: str, candidate: str, after: str) -> float:
    """Bytes that ``candidate`` adds to the compressed surroundings, per character."""
    size = lambda s: len(_compressor().compress(s.encode("utf-8", "surrogatepass")))
    around = after + "\n" + before
    return (size(around + candidate) - size(around)) / max(1, len(candidate))


_CLASSES = ((re.compile("[a-z]"), string.ascii_lowercase), (re.compile("[A-Z]"), string.ascii_uppercase), (re.compile("[0-9]"), string.digits))


def _alphabet(candidate: str) -> str:
    """The characters that a random string like this one is drawn from."""
    marks = "".join(c for c in "+/_=-" if c in candidate)
    for digits in ("0123456789abcdef", "0123456789ABCDEF"):
        if not candidate.strip(digits + "+/_=-") and set(candidate) <= set(digits + marks):
            return digits + marks
    return "".join(chars for pattern, chars in _CLASSES if pattern.search(candidate)) + marks


def random_novelty(before: str, candidate: str, after: str) -> float:
    """Mean novelty of random strings of the candidate's alphabet and length in its place."""
    draw, chars = random.Random(candidate), _alphabet(candidate)
    return sum(novelty(before, "".join(draw.choices(chars, k=len(candidate))), after) for _ in range(RANDOM)) / RANDOM


_LETTERS = re.compile("[A-Z]?[a-z]+|[A-Z]+")


@cache
def _pairs() -> dict[str, float]:
    """Log-odds of the letter pairs of the priming words against letters drawn at random."""
    pairs = Counter(p for w in set(re.findall("[a-z]+", " ".join(_IDENTIFIERS))) for p in map("".join, zip(w, w[1:], strict=False)))
    heads = Counter()
    for p, n in pairs.items():
        heads[p[0]] += n
    return {x + y: math.log((pairs[x + y] + 0.25) / (heads[x] + 0.25 * 26) * 26) for x in string.ascii_lowercase for y in string.ascii_lowercase}


def wordiness(candidate: str) -> float:
    """Log-odds per character that its runs of letters are words rather than drawn at random."""
    odds = _pairs()
    return sum(odds[a + b] for w in _LETTERS.findall(candidate) for a, b in zip(w.lower(), w.lower()[1:], strict=False)) / len(candidate)


def _novel(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Candidates near a sensitive word that share no character with a base span."""
    out, i, last = [], 0, -1
    taken = sorted(taken)
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if (i < len(taken) and taken[i][0] < b) or len(set(m[0])) < DIFFERENT:
            continue
        follows = 0 <= last < a and a - last <= REACH and text[last:a].isspace()
        if not follows and not _SENSITIVE.search(text, max(0, a - REACH), min(len(text), b + REACH)):
            continue
        before, after = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
        pieces = [m[0][k:k + PIECE] for k in range(0, b - a, PIECE)]
        added = sum(novelty(before, p, after) * len(p) for p in pieces)
        if added >= NOVELTY * (b - a) or (wordiness(m[0]) < WORDY and added >= RELATIVE * sum(random_novelty(before, p, after) * len(p) for p in pieces)):
            out.append((a, b))
            last = b
    return out


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start and kind."""
    text = text or ""
    low = text.lower()
    spans = []
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    if any(w in low for w in _SENSITIVE_WORDS):
        spans += [(a, b, "novel") for a, b in _novel(text, [s[:2] for s in spans])]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"


def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        spans = scan(t)
        n = {k: sum(s[2] == k for s in spans) for k in KINDS}
        base = _listed([s for s in spans if s[2] != "novel"])
        rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(base.encode()).hexdigest(), _listed(spans), n["novel"]))
    return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])


def secret_scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document."""
    return documents.select(F.col(id_col), F.pandas_udf(_scan, SCHEMA)(F.col(text_col)).alias("r")).select(id_col, "r.*")
