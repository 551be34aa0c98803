"""Secret scan: fixed patterns, and sliding-window entropy for the rest.

Candidate strings (long unbroken runs) are cut into character classes. In
each class a window slides over the string; its Shannon entropy is kept by
updating the counts of the one character that enters and the one that leaves.
Windows at or above the class's threshold are merged, as the window slides, to
spans of kind ``entropy``. The allow list suppresses spans that are known to be
harmless: runs without digits that look like words (capitals at word starts, or one
case throughout), counting runs, identifiers in the usual 8-4-4-4-12 form, and
spans inside a pattern's own span.

Defined cases: NULL and empty texts have no span; texts are read whole;
repeated rows get equal results; an empty table gives an empty result; extra
columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_row, text_or_empty

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones never match
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
# Character classes and the bits per character from which a window is suspicious.
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]{%d,}" % WINDOW), 3.0),
           ("alnum", re.compile(r"[A-Za-z0-9]{%d,}" % WINDOW), 3.6),
           ("base64", re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW), 3.8))
ALLOWED = (re.compile(r"[0-9]*"),
           re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
           re.compile(r"[0-9_=/+-]*"))
# Letters alone are a key only with capitals in this share of them and so many changes
# from small to capital a letter: words, names joined by capitals and shouting have fewer or more.
MIXED, CHANGES = (0.3, 0.7), 1 / 8
NO_DIGIT = re.compile(r"[^0-9]*")
CHANGE = re.compile(r"[a-z][A-Z]")
COUNTING = "0123456789abcdefghijklmnopqrstuvwxyz"
_TERM = [0.0, 0.0, *(c * log2(c) for c in range(2, WINDOW + 1))]


def window_entropies(text: str, width: int = WINDOW):
    """Entropy of every window of ``width`` characters in turn, by incremental counts."""
    counts: dict[str, int] = {}
    total = 0.0  # sum of c * log2(c)
    for at, entering in enumerate(text):
        if at >= width:
            leaving = text[at - width]
            c = counts[leaving]
            total += _TERM[c - 1] - _TERM[c]
            counts[leaving] = c - 1
        c = counts.get(entering, 0)
        total += _TERM[c + 1] - _TERM[c]
        counts[entering] = c + 1
        if at >= width - 1:
            yield log2(width) - total / width


def like_words(found: str) -> bool:
    """Letters without digits whose case is that of words rather than of a key."""
    letters = sum(map(str.isalpha, found))
    capitals = sum(map(str.isupper, found))
    mixed = MIXED[0] * letters <= capitals <= MIXED[1] * letters
    return not (mixed and len(CHANGE.findall(found)) >= CHANGES * letters)


def allowed(found: str) -> bool:
    return (any(p.fullmatch(found) for p in ALLOWED) or found.lower() in COUNTING * 2
            or bool(NO_DIGIT.fullmatch(found)) and like_words(found))


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Merged windows of high entropy, in any class, less the allow list."""
    spans: list[tuple[int, int]] = []
    for candidate in CANDIDATE.finditer(text):
        if allowed(candidate.group()):
            continue
        found: list[tuple[int, int]] = []
        for _, pattern, threshold in CLASSES:
            for run in pattern.finditer(text, candidate.start(), candidate.end()):
                last = -1  # end of the span that the window is adding to
                for at, bits in enumerate(window_entropies(run.group()), run.start()):
                    if bits < threshold:
                        continue
                    if at <= last:
                        found[-1] = (found[-1][0], at + WINDOW)
                    else:
                        found.append((at, at + WINDOW))
                    last = at + WINDOW
        for start, end in sorted(found):
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((start, end))
    return [s for s in spans if not allowed(text[s[0]:s[1]])]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]], kinds=KINDS) -> str:
    return ",".join(f"{kinds[k]}:{start}:{end}" for start, k, end in spans)


def scan(text: str) -> tuple[int, int, int, str, str]:
    base = base_spans(text)
    extra, at, reach = [], 0, -1  # reach: farthest end of a base span that starts at or before s
    for s, e in entropy_spans(text):
        while at < len(base) and base[at][0] <= s:
            reach, at = max(reach, base[at][2]), at + 1
        if e > reach:
            extra.append((s, 3, e))
    counts = [sum(k == n for _, k, _ in base) for n in range(3)]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + extra)))


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make():
        return lambda key, raw: (key, *scan(raw))

    return per_row(rows, make, f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
                               "base_sha256 string, spans string")
