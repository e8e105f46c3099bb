"""License scan: ordered signature rules gated by a keyword prefilter.

Every whole text is lower-cased (A-Z) and scanned as UTF-8 bytes.  A rule is a regex with a priority,
a weight and literal keywords that every match must contain; a rule runs only on texts that hold its
keywords.  Overlapping detections are resolved by priority: going through them from the highest
priority (then longest, then first), a detection whose interval lies inside a kept one is suppressed.
Base phrases are word sequences and always stay.

Defined results
    null text       counts as the empty text: no words, no labels, score 0
    very long text  scanned whole; memory is a few bytes per byte of one text
    ties            equal priority and interval: the rule listed first stays
    repeated rows   each row is scanned by itself; null ids are passed through
    empty table     empty result
    extra columns   ignored
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = rb"0-9a-z\x80-\xff"
GAP = rb"[^" + WORD + rb"]+"

#: Base phrases and labels (fixed by the contract).
BASE = ((b"cc by", "cc-by"), (b"general public license", "gpl"), (b"all rights reserved", "reserved"))

#: label; names in running text; SPDX identifiers; places on the web.
FAMILIES: tuple[tuple[str, tuple[str, ...], tuple[str, ...], tuple[str, ...]], ...] = (
    ("apache-2.0", ("apache license, version 2.0", "apache license 2.0", "apache 2.0"), ("apache-2.0",), ("apache.org/licenses/license-2.0",)),
    ("apache-1.1", ("apache software license, version 1.1", "apache license 1.1"), ("apache-1.1",), ("apache.org/licenses/license-1.1",)),
    ("apache-1.0", ("apache license 1.0",), ("apache-1.0",), ("apache.org/licenses/license-1.0",)),
    ("mit", ("mit license", "expat license", "x11 license"), ("mit", "x11"), ("opensource.org/licenses/mit",)),
    ("mit-0", ("mit no attribution",), ("mit-0",), ("opensource.org/licenses/mit-0",)),
    ("bsd-2-clause", ("bsd 2-clause license", "simplified bsd license", "freebsd license"), ("bsd-2-clause",), ("opensource.org/licenses/bsd-2-clause",)),
    ("bsd-3-clause", ("bsd 3-clause license", "new bsd license", "modified bsd license"), ("bsd-3-clause",), ("opensource.org/licenses/bsd-3-clause",)),
    ("bsd-4-clause", ("bsd 4-clause license", "original bsd license"), ("bsd-4-clause",), ()),
    ("0bsd", ("zero-clause bsd",), ("0bsd",), ("opensource.org/licenses/0bsd",)),
    ("isc", ("isc license",), ("isc",), ("opensource.org/licenses/isc",)),
    ("gpl-3.0", ("general public license, version 3", "general public license version 3", "general public license v3", "gnu gpl v3", "gplv3"), ("gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later"), ("gnu.org/licenses/gpl-3.0",)),
    ("gpl-2.0", ("general public license, version 2", "general public license version 2", "gnu gpl v2", "gplv2"), ("gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later"), ("gnu.org/licenses/gpl-2.0", "gnu.org/licenses/old-licenses/gpl-2.0")),
    ("lgpl-3.0", ("lesser general public license, version 3", "lesser general public license version 3", "lgplv3"), ("lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later"), ("gnu.org/licenses/lgpl-3.0",)),
    ("lgpl-2.1", ("lesser general public license, version 2.1", "lesser general public license version 2.1", "lgplv2.1"), ("lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later"), ("gnu.org/licenses/lgpl-2.1",)),
    ("lgpl-2.0", ("library general public license",), ("lgpl-2.0", "lgpl-2.0-only"), ("gnu.org/licenses/lgpl-2.0",)),
    ("agpl-3.0", ("affero general public license", "agplv3"), ("agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"), ("gnu.org/licenses/agpl-3.0",)),
    ("gfdl-1.3", ("gnu free documentation license",), ("gfdl-1.3", "gfdl-1.3-only"), ("gnu.org/licenses/fdl-1.3",)),
    ("mpl-2.0", ("mozilla public license, version 2.0", "mozilla public license 2.0"), ("mpl-2.0",), ("mozilla.org/mpl/2.0",)),
    ("mpl-1.1", ("mozilla public license version 1.1", "mozilla public license 1.1"), ("mpl-1.1",), ("mozilla.org/mpl/mpl-1.1",)),
    ("epl-2.0", ("eclipse public license 2.0", "eclipse public license - v 2.0"), ("epl-2.0",), ("eclipse.org/legal/epl-2.0",)),
    ("epl-1.0", ("eclipse public license 1.0", "eclipse public license - v 1.0"), ("epl-1.0",), ("eclipse.org/legal/epl-v10",)),
    ("edl-1.0", ("eclipse distribution license",), (), ("eclipse.org/org/documents/edl-v10",)),
    ("cddl-1.0", ("common development and distribution license",), ("cddl-1.0", "cddl-1.1"), ("opensource.org/licenses/cddl-1.0",)),
    ("cpl-1.0", ("common public license",), ("cpl-1.0",), ("opensource.org/licenses/cpl1.0",)),
    ("cc-by-nc-nd-4.0", ("cc by-nc-nd 4.0", "attribution-noncommercial-noderivatives 4.0"), ("cc-by-nc-nd-4.0",), ("creativecommons.org/licenses/by-nc-nd/4.0",)),
    ("cc-by-nc-sa-4.0", ("cc by-nc-sa 4.0", "attribution-noncommercial-sharealike 4.0"), ("cc-by-nc-sa-4.0",), ("creativecommons.org/licenses/by-nc-sa/4.0",)),
    ("cc-by-nc-4.0", ("cc by-nc 4.0", "attribution-noncommercial 4.0"), ("cc-by-nc-4.0",), ("creativecommons.org/licenses/by-nc/4.0",)),
    ("cc-by-nd-4.0", ("cc by-nd 4.0", "attribution-noderivatives 4.0"), ("cc-by-nd-4.0",), ("creativecommons.org/licenses/by-nd/4.0",)),
    ("cc-by-sa-4.0", ("cc by-sa 4.0", "attribution-sharealike 4.0"), ("cc-by-sa-4.0",), ("creativecommons.org/licenses/by-sa/4.0",)),
    ("cc-by-sa-3.0", ("cc by-sa 3.0", "attribution-sharealike 3.0"), ("cc-by-sa-3.0",), ("creativecommons.org/licenses/by-sa/3.0",)),
    ("cc-by-4.0", ("cc by 4.0", "creative commons attribution 4.0"), ("cc-by-4.0",), ("creativecommons.org/licenses/by/4.0",)),
    ("cc-by-3.0", ("cc by 3.0", "creative commons attribution 3.0"), ("cc-by-3.0",), ("creativecommons.org/licenses/by/3.0",)),
    ("cc0-1.0", ("cc0 1.0", "creative commons zero"), ("cc0-1.0",), ("creativecommons.org/publicdomain/zero/1.0",)),
    ("unlicense", ("the unlicense",), ("unlicense",), ("unlicense.org",)),
    ("public-domain", ("released into the public domain", "dedicated to the public domain"), (), ("creativecommons.org/publicdomain/mark",)),
    ("wtfpl", ("do what the fuck you want to public license",), ("wtfpl",), ("wtfpl.net",)),
    ("zlib", ("zlib license", "zlib/libpng license"), ("zlib",), ("opensource.org/licenses/zlib",)),
    ("libpng", ("libpng license",), ("libpng", "libpng-2.0"), ()),
    ("bsl-1.0", ("boost software license",), ("bsl-1.0",), ("boost.org/license_1_0",)),
    ("busl-1.1", ("business source license",), ("busl-1.1",), ("mariadb.com/bsl11",)),
    ("sspl-1.0", ("server side public license",), ("sspl-1.0",), ("mongodb.com/licensing/server-side-public-license",)),
    ("elastic-2.0", ("elastic license 2.0",), ("elastic-2.0",), ("elastic.co/licensing/elastic-license",)),
    ("artistic-2.0", ("artistic license 2.0",), ("artistic-2.0",), ("opensource.org/licenses/artistic-2.0",)),
    ("artistic-1.0", ("artistic license 1.0", "perl artistic license"), ("artistic-1.0", "artistic-1.0-perl"), ("opensource.org/licenses/artistic-1.0",)),
    ("python-2.0", ("python software foundation license", "psf license"), ("python-2.0", "psf-2.0"), ("docs.python.org/license",)),
    ("ruby", ("ruby license",), ("ruby",), ("ruby-lang.org/en/about/license",)),
    ("php-3.01", ("php license",), ("php-3.01", "php-3.0"), ("php.net/license",)),
    ("postgresql", ("postgresql license",), ("postgresql",), ("opensource.org/licenses/postgresql",)),
    ("openssl", ("openssl license",), ("openssl",), ("openssl.org/source/license",)),
    ("ofl-1.1", ("sil open font license",), ("ofl-1.1",), ("scripts.sil.org/ofl", "openfontlicense.org")),
    ("eupl-1.2", ("european union public licence", "european union public license"), ("eupl-1.2", "eupl-1.1"), ("joinup.ec.europa.eu/collection/eupl",)),
    ("cecill-2.1", ("cecill free software license",), ("cecill-2.1", "cecill-b", "cecill-c"), ("cecill.info/licences",)),
    ("ms-pl", ("microsoft public license",), ("ms-pl",), ("opensource.org/licenses/ms-pl",)),
    ("ms-rl", ("microsoft reciprocal license",), ("ms-rl",), ("opensource.org/licenses/ms-rl",)),
    ("odbl-1.0", ("open database license",), ("odbl-1.0",), ("opendatacommons.org/licenses/odbl",)),
    ("odc-by-1.0", ("open data commons attribution license",), ("odc-by-1.0",), ("opendatacommons.org/licenses/by",)),
    ("pddl-1.0", ("public domain dedication and license",), ("pddl-1.0",), ("opendatacommons.org/licenses/pddl",)),
    ("cdla-permissive-2.0", ("community data license agreement - permissive",), ("cdla-permissive-2.0", "cdla-permissive-1.0"), ("cdla.dev/permissive-2-0",)),
    ("cdla-sharing-1.0", ("community data license agreement - sharing",), ("cdla-sharing-1.0",), ("cdla.dev/sharing-1-0",)),
    ("upl-1.0", ("universal permissive license",), ("upl-1.0",), ("opensource.org/licenses/upl",)),
    ("ncsa", ("university of illinois/ncsa open source license",), ("ncsa",), ("opensource.org/licenses/ncsa",)),
    ("afl-3.0", ("academic free license",), ("afl-3.0",), ("opensource.org/licenses/afl-3.0",)),
    ("osl-3.0", ("open software license",), ("osl-3.0",), ("opensource.org/licenses/osl-3.0",)),
    ("ecl-2.0", ("educational community license",), ("ecl-2.0",), ("opensource.org/licenses/ecl-2.0",)),
    ("w3c", ("w3c software notice and license", "w3c license"), ("w3c",), ("w3.org/consortium/legal",)),
    ("unicode-3.0", ("unicode license",), ("unicode-3.0", "unicode-dfs-2016"), ("unicode.org/copyright",)),
    ("blueoak-1.0.0", ("blue oak model license",), ("blueoak-1.0.0",), ("blueoakcouncil.org/license",)),
    ("hippocratic-2.1", ("hippocratic license",), ("hippocratic-2.1",), ("firstdonoharm.dev",)),
    ("openrail-m", ("open rail-m license", "openrail-m license"), ("openrail", "bigscience-openrail-m"), ("huggingface.co/spaces/bigscience/license",)),
    ("proprietary", ("proprietary and confidential", "unauthorized copying of this file"), ("licenseref-proprietary",), ()),
)

#: Single rules beside the families: label, priority, weight, keyword (within one word), regex over
#: lower-cased bytes in which a blank stands for whatever stands BETWEEN two words.
SINGLE: tuple[tuple[str, int, float, bytes, bytes], ...] = (
    ("mit", 60, 0.95, b"permission", rb"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", 60, 0.95, b"permission", rb"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose"),
    ("bsd", 60, 0.9, b"redistribution", rb"redistribution and use in source and binary forms, with or without modification"),
    ("zlib", 60, 0.9, b"'as-is'", rb"this software is provided 'as-is', without any express or implied warranty"),
    ("gpl", 55, 0.9, b"foundation", rb"under the terms of the gnu (?:lesser |affero )?general public licen[sc]e as published by the free software foundation"),
    ("apache", 30, 0.7, b"apache", rb"\bapache licen[sc]e\b"),
    ("bsd", 30, 0.6, b"bsd", rb"\bbsd(?:-style)? licen[sc]e\b"),
    ("gpl", 30, 0.7, b"gnu", rb"\bgnu (?:general public licen[sc]e|gpl)\b"),
    ("lgpl", 31, 0.7, b"lesser", rb"\b(?:gnu )?lesser general public licen[sc]e\b"),
    ("mpl", 30, 0.7, b"mozilla", rb"\bmozilla public licen[sc]e\b"),
    ("epl", 30, 0.7, b"eclipse", rb"\beclipse public licen[sc]e\b"),
    ("cc", 25, 0.6, b"commons", rb"\bcreative commons licen[sc]e\b"),
    ("copyright", 10, 0.3, b"copyright", rb"\bcopyright (?:\(c\) |\xc2\xa9 )?(?:19|20)[0-9]{2}\b[^\n]{0,80}"),
    ("warranty", 5, 0.3, b"warrant", rb"without warrant(?:y|ies) (?:or conditions )?of any kind"),
    ("eula", 20, 0.5, b"agreement", rb"\bend(?:-| )user licen[sc]e agreement\b"),
)

#: Texts without any of these hold no match of any rule: each lies within one word of every match of some rules.
GATES = (b"licen", b"copyright", b"spdx", b"domain", b"warrant", b"permission", b"redistribution", b"'as-is'",
         b"creative", b"unauthorized", b"proprietary", b"bsd", b"4.0", b"3.0", b"cc0", b"attribution", b"gpl", b"apache", b"gnu", b"cecill",
         b".org/", b".net/", b".com/", b".dev/", b".co/", b".info/", b".eu/", b"firstdonoharm", b"unlicense.org", b"wtfpl.net")

#: What stands between two words: white space, and where the line is wrapped the comment marks at its end
#: and at the next one's start.  Atomic, so that long runs of blanks take linear time.
BETWEEN = rb"(?>[^\S\n]++(?![\n*#|;/])|[^\S\n]*+[*#|;/]*+[^\S\n]*+\n(?:[\s*#/;%!|>\"\\.]|--|(?:dnl|rem)\s)*+)"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    weight: float
    keyword: bytes
    pattern: re.Pattern


def _loose(name: str) -> bytes:
    """The name as a regex: blanks may be whatever stands BETWEEN words, licence may be spelt either way."""
    return BETWEEN.join(re.escape(x).replace(rb"license", rb"licen[sc]e") for x in name.encode().split())


def _longest_word(name: str) -> bytes:
    return max((w for w in name.encode().split() if b"licen" not in w), key=len)


@cache
def rules() -> tuple[Rule, ...]:
    """Every rule in order: identifiers, addresses, grants, names, then the single ones."""
    out: list[Rule] = []
    edge, end = rb"(?<![" + WORD + rb"])", rb"(?![" + WORD + rb"])"
    grant = rb"(?:(?:re-?)?licen[sc]ed|released|distributed|published|available|provided) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?".replace(b" ", BETWEEN)
    for label, names, ids, places in FAMILIES:
        for x in ids:
            out.append(Rule(label, 100, 1.0, b"spdx", re.compile(rb"spdx-licen[sc]e-identifier:[ \t]*" + re.escape(x.encode()) + rb"(?![0-9a-z.-]*[0-9a-z])")))
        for x in places:
            out.append(Rule(label, 80, 0.9, x.encode(), re.compile(re.escape(x.encode()) + end)))
        for x in names:
            out.append(Rule(label, 70, 0.95, _longest_word(x), re.compile(edge + grant + _loose(x) + end)))
            out.append(Rule(label, 50, 0.8, _longest_word(x), re.compile(edge + _loose(x) + end)))
    for label, priority, weight, keyword, pattern in SINGLE:
        out.append(Rule(label, priority, weight, keyword, re.compile(pattern.replace(b" ", BETWEEN))))
    return tuple(out)


@cache
def _base() -> tuple:
    return tuple((p.split()[0], label, re.compile(GAP.join(p.split()))) for p, label in BASE)


_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True


def detections(low: bytes) -> list[tuple[int, int, int, float, str]]:
    """(start, end, priority, weight, label) of the rules' matches that no kept detection contains."""
    if not any(g in low for g in GATES):
        return []
    found, has = [], {}
    for r in rules():
        ok = has.get(r.keyword)
        if ok is None:
            ok = has[r.keyword] = r.keyword in low
        if ok:
            found += [(m.start(), m.end(), r.priority, r.weight, r.label) for m in r.pattern.finditer(low)]
    found.sort(key=lambda x: (-x[2], x[0] - x[1], x[0]))
    # sweep: kept intervals by start with the furthest end so far; containment is one bisection
    kept: list[tuple[int, int, int, float, str]] = []
    for priority in sorted({x[2] for x in found}, reverse=True):
        starts = np.array(sorted((k[0], k[1]) for k in kept), dtype=np.int64).reshape(-1, 2)
        reach = np.maximum.accumulate(starts[:, 1]) if len(starts) else starts[:, 1]
        same: list[tuple[int, int, int, float, str]] = []
        far = -1
        for d in sorted((x for x in found if x[2] == priority), key=lambda x: (x[0], -x[1])):
            i = int(np.searchsorted(starts[:, 0], d[0], side="right"))
            if (i and reach[i - 1] >= d[1]) or far >= d[1]:
                continue
            same.append(d)
            far = max(far, d[1])
        kept += same
    return sorted(kept)


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of one text."""
    low = (text or "").encode("utf-8", "surrogatepass").lower()
    inside = _IS_WORD[np.frombuffer(low, dtype=np.uint8)]
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1]))) if len(low) else np.zeros(0, dtype=np.int64)
    places, labels = [], set()
    for head, label, pattern in _base():
        if head not in low:
            continue
        for m in pattern.finditer(low):
            a, b = m.span()
            if (a == 0 or not inside[a - 1]) and (b == len(low) or not inside[b]):
                places.append(a)
                labels.add(label)
    kept = detections(low)
    words = np.searchsorted(starts, np.array(sorted(places), dtype=np.int64))
    score = 1.0 - float(np.prod([1.0 - w for *_, w, _ in kept] + [0.5] * len(places))) if kept or places else 0.0
    return (len(starts), len(places), int(words[0]) if places else None, int(words[-1]) if places else None, ",".join(sorted(labels)),
            ",".join(sorted(labels | {d[4] for d in kept})), min(1.0, max(0.0, score)), ",".join(f"{d[4]}:{d[0]}:{d[1]}" for d in kept))


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detected string"


def _scan(texts: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame([scan(t) for t in texts], columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detected"])
    return out.astype({"first_word": "Int64", "last_word": "Int64"})


def license_scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; ``detected`` lists label:start:end of the rules' detections in UTF-8 bytes."""
    return documents.select(F.col(id_col), F.pandas_udf(_scan, SCHEMA)(F.col(text_col)).alias("r")).select(id_col, "r.*")
