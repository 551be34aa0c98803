"""License scan: ordered signature rules with a keyword prefilter.

A text is reduced to its words (A-Z lower-cased, runs of ASCII letters, digits
and other characters) joined by single spaces; signatures are regular expressions on
that form. Hundreds of them come from hand-written families: a family has its
names, its versions and the ways a notice can cite it (title, "licensed under",
"released under", a short identifier, a sentence of the license itself).

Rules run in order of priority. Each is gated by a keyword that all of its
matches hold: a text without any keyword is passed over at once, a rule whose
keyword is absent isn't tried. Detections are resolved by priority, then
length, then order of the rules: one that lies inside an accepted detection is
suppressed. The base phrases are kept whatever overlaps them.

Defined cases: NULL and empty texts have no word, no label and score 0;
repeated rows get equal results; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_TABLE, per_row, text_or_empty

# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Families: label, names in word form, versions ("" where it has none).
FAMILIES = (
    ("mit", ("mit", "expat", "x11"), ("",)),
    ("apache", ("apache", "apache software", "asl"), ("", "1 0", "1 1", "2 0", "2")),
    ("gpl", ("gpl", "gnu gpl", "general public", "gnu general public"), ("", "1", "1 0", "2", "2 0", "3", "3 0")),
    ("lgpl", ("lgpl", "gnu lgpl", "lesser general public", "gnu lesser general public", "library general public"),
     ("", "2", "2 0", "2 1", "3", "3 0")),
    ("agpl", ("agpl", "gnu agpl", "affero general public", "gnu affero general public"), ("", "1 0", "3", "3 0")),
    ("bsd", ("bsd", "berkeley software distribution"), ("", "2 clause", "3 clause", "4 clause", "new", "simplified")),
    ("mpl", ("mpl", "mozilla public"), ("", "1 0", "1 1", "2 0")),
    ("epl", ("epl", "eclipse public"), ("", "1 0", "2 0")),
    ("cddl", ("cddl", "common development and distribution"), ("", "1 0", "1 1")),
    ("isc", ("isc",), ("",)),
    ("zlib", ("zlib", "zlib libpng"), ("",)),
    ("boost", ("boost", "boost software", "bsl"), ("", "1 0")),
    ("artistic", ("artistic", "perl artistic"), ("", "1 0", "2 0")),
    ("eupl", ("eupl", "european union public"), ("", "1 1", "1 2")),
    ("osl", ("osl", "open software"), ("", "2 1", "3 0")),
    ("afl", ("afl", "academic free"), ("", "2 1", "3 0")),
    ("ms-pl", ("ms pl", "microsoft public"), ("",)),
    ("python", ("psf", "python software foundation"), ("", "2", "2 0")),
    ("ofl", ("ofl", "sil open font", "open font"), ("", "1 0", "1 1")),
    ("cecill", ("cecill",), ("", "2", "2 1", "b", "c")),
    ("cc0", ("cc0", "creative commons zero"), ("", "1 0")),
    ("cc-by", ("cc by", "creative commons attribution"), ("", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
     ("", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", ("cc by nc", "creative commons attribution noncommercial",
                  "creative commons attribution non commercial"), ("", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", ("cc by nd", "creative commons attribution noderivatives"), ("", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", ("cc by nc sa",), ("", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", ("cc by nc nd",), ("", "2 0", "2 5", "3 0", "4 0")),
    ("odbl", ("odbl", "open database"), ("", "1 0")),
    ("wtfpl", ("wtfpl",), ("", "2")),
    ("unlicense", ("unlicense",), ("",)),
    ("proprietary", ("proprietary", "commercial"), ("",)),
)
# Ways to cite a family: priority, confidence, keyword and pattern around the name.
FORMS = (
    (90, 1.0, "spdx", r"spdx license identifier {name}"),
    (80, 0.98, "under", r"(?:licensed|released|distributed|published|available|provided) under (?:the )?(?:terms of )?"
                        r"(?:the )?{name}(?: licen[sc]e)?"),
    (70, 0.95, "licen", r"(?:the )?{name} licen[sc]e"),
    (60, 0.9, "licen", r"licen[sc]e {name}"),
)
# Sentences of license texts: label, keyword, pattern.
SENTENCES = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "warranty", r"the software is provided as is without warranty of any kind"),
    ("apache", "license", r"you may not use this file except in compliance with the license"),
    ("apache", "license", r"subject to the terms and conditions of this license each contributor hereby grants"),
    ("gpl", "software", r"this program is free software you can redistribute it and or modify it"),
    ("gpl", "warranty", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "library", r"this library is free software you can redistribute it and or modify it"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "source", r"this source code form is subject to the terms of the mozilla public license"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("boost", "boost", r"permission is hereby granted .{0,80}boost software license"),
    ("unlicense", "public", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public", r"(?:dedicated to|released into|placed in) the public domain"),
    ("cc0", "waived", r"has waived all copyright and related or neighboring rights"),
    ("proprietary", "reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"confidential and proprietary"),
)
SENTENCE_PRIORITY = 85


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keyword: bytes
    pattern: re.Pattern


@cache
def rules() -> tuple[Rule, ...]:
    """All signatures, highest priority first; within a priority longer names first."""
    out = []
    for label, keyword, pattern in SENTENCES:
        out.append(Rule(label, SENTENCE_PRIORITY, 0.97, keyword.encode(), _whole(pattern)))
    for label, names, versions in FAMILIES:
        for name in names:
            for version in versions:
                # A version may follow the name at once or after "license version".
                cited = name if not version else rf"{name}(?: licen[sc]e)?(?: version| v)? v?{version}"
                for priority, confidence, _, form in FORMS:
                    out.append(Rule(label, priority, confidence, name.split()[0].encode(),
                                    _whole(form.format(name=cited))))
    return tuple(sorted(out, key=lambda r: (-r.priority, -len(r.pattern.pattern))))


def _whole(pattern: str) -> re.Pattern:
    return re.compile(rb"(?<= )" + pattern.encode() + rb"(?= )")


# A text with none of these can't match any rule.
ANCHORS = tuple(sorted({k.encode() for _, _, k, _ in FORMS} | {k.encode() for _, k, _ in SENTENCES}))


@dataclass(frozen=True)
class Detection:
    start: int  # word numbers, end exclusive
    end: int
    label: str
    priority: int
    confidence: float
    order: int


def word_form(text: str) -> tuple[bytes, int]:
    """Words joined by single spaces, with one at each end, and their number."""
    found = text.encode().translate(WORD_TABLE).split()
    return b" " + b" ".join(found) + b" ", len(found)


def base_places(norm: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE:
        needle = b" " + phrase.encode() + b" "
        at, seen, words = norm.find(needle), 0, 0
        while at >= 0:
            words, seen = words + norm.count(b" ", seen, at), at
            out.append((words, label))
            at = norm.find(needle, at + 1)
    return out


def detect(norm: bytes) -> list[Detection]:
    """Every rule's matches, before any is suppressed."""
    if not any(a in norm for a in ANCHORS):
        return []
    out = []
    for order, rule in enumerate(rules()):
        if rule.keyword not in norm:
            continue
        start, seen = -1, 0
        for m in rule.pattern.finditer(norm):
            start, seen = start + norm.count(b" ", seen, m.start()), m.start()
            out.append(Detection(start, start + m.group().count(b" ") + 1, rule.label, rule.priority,
                                 rule.confidence, order))
    return out


def resolve(found: list[Detection]) -> list[Detection]:
    """Accepted detections: none lies inside one of higher rank.

    The farthest end among accepted detections that start at or before a place is
    kept in a tree over the places, so each one is asked and entered in log time.
    """
    kept: list[Detection] = []
    place = {s: k for k, s in enumerate(sorted({d.start for d in found}), 1)}
    farthest = [-1] * (len(place) + 1)
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.order, d.start)):
        k, end = place[d.start], -1
        while k:
            end = max(end, farthest[k])
            k &= k - 1
        if d.end <= end:
            continue
        kept.append(d)
        k = place[d.start]
        while k < len(farthest):
            farthest[k] = max(farthest[k], d.end)
            k += k & -k
    return kept


def scan(text: str) -> tuple[int, int, int | None, int | None, str, str, float]:
    norm, n_words = word_form(text)
    base = base_places(norm)
    kept = resolve(detect(norm))
    labels = {label for _, label in base}
    score = max([1.0 if base else 0.0, *(d.confidence for d in kept)])
    starts = [s for s, _ in base]
    return (n_words, len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | {d.label for d in kept})), score)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make():
        rules()
        return lambda key, raw: (key, *scan(raw))

    return per_row(rows, make, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
                               "base_labels string, labels string, score double")
