"""Personal data: fixed patterns, and a linear-chain CRF over word shapes.

The patterns find e-mail addresses, IP addresses, payment cards and
international phone numbers. The conditional random field adds what has no
fixed form: names after a cue, national phone numbers, identity and account
numbers. It is trained here, from the small table ``LABELLED``, by gradient
ascent on the exact log likelihood (forward-backward), and decoded by Viterbi
for many segments at once in numpy.

A segment is a whole line. Every line of every text is decoded, whether it holds a
sign of personal data (a digit, an @, a cue word) or not.

Defined cases: NULL and empty texts have no span; texts are read whole;
repeated rows get equal results; an empty table gives an empty result; extra
columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, arrow_schema, text_or_empty

# The base patterns and their limits. Tried at every place of a long run, the patterns
# of an e-mail and an IP address would take time with the square of the run; their parts below,
# put together by emails() and addresses(), give the same matches in one pass.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]{6,}")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9]+(?:[\x20-][0-9]+)+|[0-9]{2,}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]")
KINDS = ("email", "ip", "card", "phone", "crf_person", "crf_phone", "crf_id")

TAGS = ("O", "PERSON", "PHONE", "ID")
HELD_WORDS = 1 << 17  # words of segments held, and of a padded batch, unless one segment is longer
HELD_KINDS = 1 << 17  # words whose kind a task remembers
# Words that announce personal data.
CUES = frozenset("""
name contact signed mr mrs ms dr herr frau señor señora monsieur madame phone tel telephone mobile call fax
ssn passport iban account id customer employee patient born
""".split())
CUE_LIST = sorted(CUES)
# The labelled table: [TAG words] marks an entity, all other words are outside.
LABELLED = (
    "Name: [PERSON Anna Keller] lives in the old town",
    "Contact [PERSON John Smith] for more details on this",
    "Signed [PERSON Maria Lopez Garcia]",
    "Dear Mr. [PERSON Brown] we have received your letter",
    "Mrs. [PERSON Jane Doe] will call you back",
    "Dr. [PERSON Paul Meyer] is the head of the clinic",
    "Please contact [PERSON Ines Martin] or visit the office",
    "Patient name: [PERSON Robert King] born 12.04.1971 in Leeds",
    "Employee [PERSON Laura Stein] ID [ID E-204817] joined in 2019",
    "Phone: [PHONE 555-123-4567] or write to us",
    "Call [PHONE (555) 987-6543] today for 20 percent off",
    "Tel. [PHONE 030 1234567] between 9 and 17",
    "Mobile [PHONE 0171-5550199] of the owner",
    "Fax [PHONE 555.444.3322] is no longer used",
    "my phone is [PHONE 555-0142] and I live in flat 12",
    "SSN [ID 123-45-6789] was found in the file",
    "ssn: [ID 987-65-4321] and passport [ID X1234567] on record",
    "Passport no. [ID C01X00T47] expires in 2030",
    "Account [ID 00123456789] at the bank was closed",
    "IBAN [ID DE89370400440532013000] is valid",
    "customer ID [ID 84-1123-99] has 3 orders",
    "Customer [ID 10002345] bought 4 items for 12.50",
    "The house has 12 rooms and 3 floors",
    "In 1998 the company sold 12,000 units at 4.99 each",
    "See section 4.2 on page 17 for the table",
    "Version 2.0 of the license applies to 3 files",
    "It was 20 degrees at 10:30 on 5 May 2021",
    "Call the function with 3 arguments",
    "The name of the rose is a book",
    "Contact lenses cost 20 dollars",
    "An account of the war in 1812",
    "Write to user.55@mail4.example.com for the price list",
    "The server 97.51.17.173 answered 200 times",
    "Paid with 4485 2758 4230 2321 on Monday",
    "Dial +1 (017) 555-7713 for the desk",
    "Order 66 has 15 lines and weighs 2 kg",
    "Born in 1970 he moved to Rome",
    "the id of the row is 5",
    "Chapter 3 names 14 kings",
    "Licensed under CC BY-NC 4.0.",
    "He went in. Then 3 of them came",
    "It was so. Later on 2 were left",
    "to. Him and 4 others as of. Where it is",
    "De. Lo que 7 en la casa",
    "An end of it. Over 15 Things were new",
    "The. One and 5555 of. Two are in. Old",
    "Was on. To me 97.51.17.173 And. So it goes",
    "He is. Anna.55@mail4.example.com In. The rest",
    "+1 (017) 555-7713 Of. The desk is. Here",
)

TOKEN = re.compile(r"\S+")
MARKED = re.compile(r"\[(PERSON|PHONE|ID) ([^\]]+)\]")
EDGE = ".,;:!?()[]\"'"
class Table(dict):
    """A table for ``str.translate``, filled by ``of`` as characters come."""

    def __init__(self, of: Callable[[str], str]) -> None:
        self.of = of

    def __missing__(self, code: int) -> str:
        self[code] = self.of(chr(code))
        return self[code]


# A character's kind: digit, capital, other letter, or the character itself.
CLASSES = Table(lambda c: "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c)
BARE = Table(lambda c: " " if c in EDGE else c)
RUN = re.compile(r"(.)\1+", re.DOTALL)


def shape(token: str) -> str:
    """Characters by kind, runs shortened: 'Anna,' is 'Aa,', '555-12' is '9-9'."""
    return RUN.sub(r"\1", token.translate(CLASSES))


def own_features(token: str, cue: str, name: str) -> list[str]:
    """Features, at the place ``name``, of a word given as itself or by the kinds of its characters."""
    digits = token.translate(CLASSES).count("9")
    return [f"{name}:shape={shape(token)}", f"{name}:cue={cue}",
            f"{name}:digits={min(digits, 9)}", f"{name}:stop={token[-1:] if token[-1:] in '.,;:' else '-'}"]


def cue_of(token: str) -> str:
    bare = token.strip(EDGE).lower()
    return bare if bare in CUES else "-"


def word_features(tokens: list[str], at: int) -> list[str]:
    """Shape features of a word and its neighbours; words only if they are cues."""
    def of(k: int, name: str) -> list[str]:
        return own_features(tokens[k], cue_of(tokens[k]), name) if 0 <= k < len(tokens) else [f"{name}:edge"]
    before = next((c for k in range(at - 1, max(-1, at - 4), -1) if (c := cue_of(tokens[k])) != "-"), "-")
    return [*of(at, "0"), *of(at - 1, "-1"), *of(at + 1, "+1"), f"near={before}", "bias"]


PLACES = ("0", "-1", "+1")  # a word itself, the one before, the one after


class Model:
    """Weights of a linear chain: features x tags, tags x tags, first tag.

    What a word adds to the scores of its own place and of those beside it depends on its features
    alone. Words of equal known features are one kind, numbered as they come; kind 0 is the edge of a line.
    """

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray, first: np.ndarray) -> None:
        self.index, self.emit, self.step, self.first = index, emit, step, first
        self.near = np.stack([self.weight([f"near={cue}"]) for cue in ("-", *CUE_LIST)])
        self.bias = self.weight(["bias"])
        self.numbers: dict[tuple, int] = {}  # features at the three places, cue: kind
        self.adds = [[self.weight([f"{name}:edge"]) for name in PLACES]]
        self.cues = [0]
        self.known: dict[str, int] = {}  # characters by kind of a word that is no cue: kind

    def __reduce__(self):
        return Model, (self.index, self.emit, self.step, self.first)

    def weight(self, features: list[str]) -> np.ndarray:
        return self.emit[[self.index[f] for f in features if f in self.index]].sum(axis=0)

    def kind(self, word: str, cue: str = "-") -> int:
        own = [tuple(f for f in own_features(word, cue, name) if f in self.index) for name in PLACES]
        number = self.numbers.setdefault((*own, cue), len(self.adds))
        if number == len(self.adds):
            self.adds.append([self.weight(f) for f in own])
            self.cues.append(CUE_LIST.index(cue) + 1 if cue in CUES else 0)
        if cue == "-" and len(word) <= 64:
            if len(self.known) >= HELD_KINDS:
                self.known.clear()
            self.known[word] = number
        return number

    def kinds(self, line: str, cues: bool = True) -> list[int]:
        """Kinds of a line's words; without ``cues`` it is known to hold none."""
        plain, get, kind = line.translate(CLASSES).split(), self.known.get, self.kind
        if not cues:
            return [get(w) or kind(w) for w in plain]
        found = map(cue_of, line.split())
        return [kind(w, cue) if cue != "-" else get(w) or kind(w) for w, cue in zip(plain, found, strict=True)]

    def lines(self, text: str) -> list[tuple[int, int, list[int]]]:
        """(start, end, kinds of its words) of every line that has words."""
        out, start = [], 0
        # Any word that is a cue without its edges is one with every edge a space, too.
        cues = not CUES.isdisjoint(text.lower().translate(BARE).split())
        for line in text.split("\n"):
            if own := self.kinds(line, cues):
                out.append((start, start + len(line), own))
            start += len(line) + 1
        return out

    def potentials(self, segments: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(segments, longest, tags) scores, zero beyond a segment's end, and lengths."""
        return self.scores([self.kinds(" ".join(s)) for s in segments])

    def scores(self, segments: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`potentials` of words given by their kinds."""
        lengths = np.array([len(s) for s in segments])
        kinds = np.fromiter(chain.from_iterable(segments), np.int32, int(lengths.sum()))
        firsts = np.cumsum(lengths) - lengths
        inside = np.arange(len(kinds)) - np.repeat(firsts, lengths)  # a word's place in its segment
        before, after = np.roll(kinds, 1), np.roll(kinds, -1)
        before[firsts] = after[firsts - 1] = 0
        adds, cues = np.array(self.adds), np.array(self.cues)[kinds]
        near = np.zeros(len(kinds), np.int64)
        if cues.any():
            for back in (3, 2, 1):  # the nearest of three words counts
                moved = np.where(inside >= back, np.roll(cues, back), 0)
                near = np.where(moved > 0, moved, near)
        out = np.zeros((len(segments), int(lengths.max()), self.emit.shape[1]))
        out[np.repeat(np.arange(len(segments)), lengths), inside] = (
            adds[kinds, 0] + adds[before, 1] + adds[after, 2] + self.near[near] + self.bias)
        return out, lengths

    def decode(self, segments: list[list[str]]) -> list[np.ndarray]:
        return self.paths([self.kinds(" ".join(s)) for s in segments])

    def paths(self, segments: list[list[int]]) -> list[np.ndarray]:
        """Viterbi over all segments at once: one step per word position."""
        if not segments:
            return []
        scores, lengths = self.scores(segments)
        best = np.ascontiguousarray(scores.transpose(1, 2, 0))  # word position, tag, segment
        best[0] += self.first[:, None]
        back = np.zeros(best.shape, np.int8)
        step = self.step[:, :, None]
        for t in range(1, len(best)):
            reach = best[t - 1][:, None] + step
            back[t] = reach.argmax(axis=0)
            best[t] += reach.max(axis=0)
        every = np.arange(len(segments))
        last = best[lengths - 1, :, every].argmax(axis=1)
        ends = np.bincount(lengths - 1, minlength=len(best)) > 0
        tags = np.zeros((len(best), len(segments)), np.int8)
        now = last
        for t in range(len(best) - 1, -1, -1):
            if ends[t]:
                now = np.where(lengths - 1 == t, last, now)
            tags[t] = now
            now = back[t, now, every]
        return [tags[:n, k] for k, n in enumerate(lengths)]


def labelled_table() -> list[tuple[list[str], list[int]]]:
    rows = []
    for line in LABELLED:
        tokens, tags, at = [], [], 0
        for m in [*MARKED.finditer(line), None]:
            plain = line[at:m.start()] if m else line[at:]
            tokens += plain.split()
            tags += [0] * len(plain.split())
            if m:
                tokens += m.group(2).split()
                tags += [TAGS.index(m.group(1))] * len(m.group(2).split())
                at = m.end()
        rows.append((tokens, tags))
    return rows


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


@cache
def trained(steps: int = 150, rate: float = 0.2, penalty: float = 0.02) -> Model:
    """Fit the chain on the labelled table (Adam on the exact gradient)."""
    rows = labelled_table()
    found = [[word_features(tokens, t) for t in range(len(tokens))] for tokens, _ in rows]
    index = {f: k for k, f in enumerate(sorted({f for seg in found for own in seg for f in own}))}
    ids = [[np.array([index[f] for f in own]) for own in seg] for seg in found]
    k = len(TAGS)
    params = [np.zeros((len(index), k)), np.zeros((k, k)), np.zeros(k)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    for step in range(1, steps + 1):
        emit, move, first = params
        grads = [-penalty * p for p in params]
        for seg, (_, tags) in zip(ids, rows, strict=True):
            score = np.array([emit[own].sum(axis=0) for own in seg])
            n = len(seg)
            ahead, behind = np.zeros((n, k)), np.zeros((n, k))
            ahead[0] = first + score[0]
            for t in range(1, n):
                ahead[t] = _logsum(ahead[t - 1][:, None] + move, 0) + score[t]
            for t in range(n - 2, -1, -1):
                behind[t] = _logsum(move + score[t + 1] + behind[t + 1], 1)
            z = _logsum(ahead[-1], 0)
            p = np.exp(ahead + behind - z)
            for t in range(n):
                diff = -p[t]
                diff[tags[t]] += 1
                np.add.at(grads[0], seg[t], diff)
                if t:
                    pair = np.exp(ahead[t - 1][:, None] + move + score[t] + behind[t] - z)
                    grads[1] -= pair
                    grads[1][tags[t - 1], tags[t]] += 1
                else:
                    grads[2] += diff
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(index, *params)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """(start, end) of every address: the local part is all that may stand before an @, back to the last match."""
    pos, at = 0, text.find("@")
    while at >= 0:
        before = text[pos:at]
        own = len(before) - len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if own else None
        if m:
            yield at - own, m.end()
        pos = m.end() if m else at + 1
        at = text.find("@", pos)


def addresses(text: str):
    """(start, end) of four runs of digits with single dots between them, left to right."""
    for run in DOTTED.finditer(text):
        groups = [m.span() for m in DIGITS.finditer(text, *run.span())] if run.group().count(".") > 2 else []
        k = 0
        while k + 3 < len(groups):
            four = groups[k:k + 4]
            if all(b == e + 1 for (_, e), (b, _) in zip(four, four[1:])):
                yield four[0][0], four[3][1]
                k += 4
            else:
                k += 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    out = [(start, 0, end) for start, end in emails(text)]
    if DIGIT.search(text):
        out += [(start, 1, end) for start, end in addresses(text)
                if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in text[start:end].split("."))]
        for m in CARD.finditer(text):
            digits = NOT_DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                if 10 <= len(NOT_DIGITS.sub("", m.group())) <= 15]
    return sorted(out)


def segments_of(text: str) -> list[list[re.Match]]:
    """The words of every line with a trigger; the scan itself decodes all lines."""
    out = []
    start = 0
    for line in text.split("\n"):
        tokens = list(TOKEN.finditer(text, start, start + len(line)))
        if any("@" in t or DIGIT.search(t) or cue_of(t) != "-" for t in (m.group() for m in tokens)):
            out.append(tokens)
        start += len(line) + 1
    return out


def entity_spans(segment: list[re.Match], tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the runs of one tag, without edge punctuation."""
    out, at = [], 0
    while at < len(tags):
        end = at + 1
        while end < len(tags) and tags[end] == tags[at]:
            end += 1
        if tags[at]:
            first, last = segment[at], segment[end - 1]
            lead = len(first.group()) - len(first.group().lstrip(EDGE.replace("(", "")))
            trail = len(last.group()) - len(last.group().rstrip(EDGE))
            if first.start() + lead < last.end() - trail:
                out.append((first.start() + lead, 3 + int(tags[at]), last.end() - trail))
        at = end
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def scan_batch(texts: list[str], model: Model) -> list[tuple[int, int, int, int, str, str]]:
    """Results of many texts; their lines are decoded together, all of them."""
    extra: list[list[tuple[int, int, int]]] = [[] for _ in texts]

    def mark(owned: list[tuple[int, int, int, list[int]]]) -> None:
        owned.sort(key=lambda o: len(o[3]))  # like lengths share a batch, so little is padded
        at = 0
        while at < len(owned):
            end = at + 1
            while end < len(owned) and len(owned[end][3]) * (end - at + 1) <= HELD_WORDS:
                end += 1
            part = owned[at:end]
            for (k, start, stop, _), tags in zip(part, model.paths([o[3] for o in part]), strict=True):
                if tags.any():
                    extra[k] += entity_spans(list(TOKEN.finditer(texts[k], start, stop)), tags)
            at = end

    held, waiting = [], 0
    for k, text in enumerate(texts):
        for line in model.lines(text):
            held.append((k, *line))
            waiting += len(line[2])
        if waiting >= HELD_WORDS:
            mark(held)
            held, waiting = [], 0
    mark(held)
    out = []
    for text, more in zip(texts, extra, strict=True):
        base = base_spans(text)
        starts, ends = [b for b, _, _ in base], list(accumulate((e for _, _, e in base), max))
        # Of the base spans that start before its end, none reaches past its start.
        more = [s for s in more if not (k := bisect_left(starts, s[2])) or ends[k - 1] <= s[0]]
        counts = [sum(k == n for _, k, _ in base) for n in range(4)]
        out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + more))))
    return out


def scan_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    ddl = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, "
           "n_phone long, base_sha256 string, spans string")
    schema = arrow_schema(ddl)
    model = trained()  # a few thousand weights, shipped with the tasks

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = scan_batch(part.column(1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, type=f.type) for c, f in
                                       zip(zip(*found, strict=True), list(schema)[1:], strict=True))], schema=schema)

    return rows.mapInArrow(run, ddl)
