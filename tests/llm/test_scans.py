"""License, secret and personal-data scans against plain restatements."""

import hashlib
import re
from math import log2

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import docs, empty  # noqa: F401
from sprout.llm import licenses, pii, secrets_scan
from sprout.llm.licenses import scan_licenses
from sprout.llm.pii import scan_pii
from sprout.llm.secrets_scan import scan_secrets

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LETTERS))
    places = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k:k + len(p)] == p]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def brute_secret(text):
    text, out = text or "", []
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) + q
                   for w, q in (("password", ""), ("passwd", ""), ("secret", ""), ("token", ""), ("api_?key", "")))
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    out.sort()
    names = ("assign", "access", "hex")
    return (*(sum(k == n for _, k, _ in out) for n in range(3)), sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in out)))


def brute_pii(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * c, 10)) for c in d[-2::-2])
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    out.sort()
    names = ("email", "ip", "card", "phone")
    return (*(sum(k == n for _, k, _ in out) for n in range(4)), sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in out)))


PARTS = ["password", "PassWd", "api_key", "apikey", "toKen", "secret", ":", "=", " ", '"', "'", "abc", "hunter22", "AKIA",
         "ABCDEFGHIJKLMNOP", "0123456789abcdef", "f" * 24, "\n", "é", "😀", "ſecret", "@", "a.b", ".org", "1.2.3.4", "256",
         ".", "+", "+1", "(017)", "555-", "7713", "4111", "1111", "-", "00", "MIT", "mit", "License", "apache",
         "general", "public", "license", ",", "Name:", "Peter"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30))
def test_base_results_equal_a_plain_restatement(parts):
    text = "".join(parts)
    assert licenses.scan(text)[:5] == brute_license(text)
    assert secrets_scan.scan(text)[:4] == brute_secret(text)
    assert pii.scan_batch([text], pii.trained())[0][:5] == brute_pii(text)
    text = " ".join(parts)
    assert licenses.scan(text)[:5] == brute_license(text)
    assert secrets_scan.scan(text)[:4] == brute_secret(text)
    assert pii.scan_batch([text], pii.trained())[0][:5] == brute_pii(text)


@pytest.mark.parametrize("scan, brute, columns", [
    (scan_licenses, brute_license, ["n_words", "n_base", "first_word", "last_word", "base_labels"]),
    (scan_secrets, brute_secret, ["n_assign", "n_access", "n_hex", "base_sha256"]),
    (scan_pii, brute_pii, ["n_email", "n_ip", "n_card", "n_phone", "base_sha256"])])
def test_awkward_rows_and_empty_table(docs, empty, scan, brute, columns):
    got = [(r["doc_id"], *(r[c] for c in columns)) for r in scan(docs).collect()]
    want = [(r[0], *brute(r[1])) for r in docs.select("doc_id", "text").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert scan(empty).collect() == []


def test_license_rules_are_ordered_and_many():
    found = licenses.rules()
    assert len(found) > 300
    assert [r.priority for r in found] == sorted((r.priority for r in found), reverse=True)


def test_license_containment_and_priority():
    n, _, _, _, _, labels, score = licenses.scan("Licensed under the GNU Lesser General Public License, version 2.1")
    assert labels == "gpl,lgpl" and score == 1.0  # gpl: the base phrase stays
    form, _ = licenses.word_form("released under the cc by nc 4.0 license")
    kept = licenses.resolve(licenses.detect(form))
    assert [d.label for d in kept] == ["cc-by-nc"]
    assert len(licenses.detect(form)) > 1
    assert licenses.scan("nothing to see here")[5:] == ("", 0.0)


def test_entropy_by_incremental_counts():
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdef0123456789XYZ"), 200))
    for k, bits in enumerate(secrets_scan.window_entropies(text)):
        window = text[k:k + secrets_scan.WINDOW]
        p = [window.count(c) / len(window) for c in set(window)]
        assert abs(bits + sum(x * log2(x) for x in p)) < 1e-9


def test_entropy_spans_and_allow_list():
    assert secrets_scan.scan("key aB3dE5gH7jK9mN1pQ3sT5vX7")[4] == "entropy:4:28"
    for harmless in ("averyveryverylongwordofnolettersbutletters", "0Z" * 13,
                     "123e4567-e89b-12d3-a456-426614174000", "2024-01-01-2024-01-02-2024"):
        assert secrets_scan.scan(harmless)[4] == ""


def test_crf_learns_its_table_and_marks_names():
    model = pii.trained()
    rows = pii.labelled_table()
    hits = sum((tags == want).sum() for tags, (_, want) in zip(model.decode([t for t, _ in rows]), rows, strict=True))
    assert hits >= 0.97 * sum(len(t) for t, _ in rows)
    text = "Name: Peter Jones, phone 555-222-1111"
    spans = pii.scan_batch([text], model)[0][5]
    assert "crf_person:6:17" in spans and "crf_phone:25:37" in spans


def test_viterbi_equals_all_paths():
    from itertools import product
    model = pii.trained()
    tokens = "Contact Anna Keller ID E-204817 in 2019".split()
    scores, _ = model.potentials([tokens])
    def total(path):
        return model.first[path[0]] + sum(scores[0, t, k] for t, k in enumerate(path)) + \
            sum(model.step[a, b] for a, b in zip(path, path[1:]))
    best = max(product(range(len(pii.TAGS)), repeat=len(tokens)), key=total)
    # A shorter and a longer segment in one batch must not disturb each other.
    got = model.decode([["one"], tokens, tokens * 3])
    assert tuple(got[1]) == best and len(got[0]) == 1 and len(got[2]) == 21


def brute_crf(text, model):
    """Every line with a trigger word, decoded whole and on its own."""
    out, start = [], 0
    for line in text.split("\n"):
        tokens = list(re.finditer(r"\S+", line))
        if any("@" in m.group() or re.search("[0-9]", m.group()) or m.group().strip(pii.EDGE).lower() in pii.CUES
               for m in tokens):
            tags = model.decode([[m.group() for m in tokens]])[0]
            out += [(start + a, k, start + b) for a, k, b in pii.entity_spans(tokens, tags)]
        start += len(line) + 1
    base = pii.base_spans(text)
    out = [s for s in out if not any(s[0] < e and b < s[2] for b, _, e in base)]
    return pii.joined(sorted(base + out))


def test_cues_beside_any_edge_character_are_decoded(monkeypatch):
    model = pii.trained()
    for c in pii.EDGE:
        for line in (f"Signed{c} Maria Lopez", f"{c}contact John Smith", f'{c}Mrs{c} Jane Doe'):
            assert [len(s) for s in pii.segments_of("nothing\n" + line)] == [len(line.split())], line
    texts = ["Signed, Maria Lopez", "(contact John Smith)", "name; Anna Keller", '"Mrs" Doe', "",
             "no cue here", "his(name)s no cue", "Call 555-123-4567\nName: Peter Jones\n\nhe left " + "x " * 40 + "at 9"]
    want = [brute_crf(t, model) for t in texts]
    assert [r[5] for r in pii.scan_batch(texts, model)] == want
    assert "crf_person:8:19" in want[0] and "crf_person:9:19" in want[1]
    monkeypatch.setattr(pii, "HELD_WORDS", 3)  # many small batches
    assert [r[5] for r in pii.scan_batch(texts, model)] == want


def every_line(text, model):
    """Every line decoded whole and on its own, its scores added up feature by feature."""
    out, start = [], 0
    for line in text.split("\n"):
        tokens = list(re.finditer(r"\S+", line))
        if tokens:
            words = [m.group() for m in tokens]
            scores = [sum(model.emit[model.index[f]] for f in pii.word_features(words, t) if f in model.index)
                      for t in range(len(words))]
            best, back = scores[0] + model.first, []
            for own in scores[1:]:
                reach = best[:, None] + model.step
                back.append(reach.argmax(axis=0))
                best = reach.max(axis=0) + own
            tags = [best.argmax()]
            for b in reversed(back):
                tags.insert(0, b[tags[0]])
            out += [(start + a, k, start + b) for a, k, b in pii.entity_spans(tokens, np.array(tags))]
        start += len(line) + 1
    base = pii.base_spans(text)
    return pii.joined(sorted(base + [s for s in out if not any(s[0] < e and b < s[2] for b, _, e in base)]))


def test_lines_without_a_trigger_are_decoded():
    model = pii.trained()
    text = "they saw it\n" + "Anna " * 12 + "\nname: Peter Jones\n\n  Anna Anna Anna Anna Anna Anna Anna was here"
    assert not pii.segments_of(text.split("\n")[1]) and not pii.segments_of(text.split("\n")[4])
    got = pii.scan_batch([text], model)[0][5]
    assert got == every_line(text, model)
    assert got == "crf_person:17:66,crf_person:79:90,crf_person:99:123"


PIECES = ["Anna", "Lopez", "was", "name:", "(Dr.", "id", "\u212aim", "ÉCOLE", "x-1", "555-0142", "a@b.c", "\n", "\n", "  ", "\x1c",
          "...", "Ǆ", "٣", "ſ", "--", "Señora,", "Ab12", "the", "Of.", "9" * 70, "A" * 70 + "b"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30), max_size=4))
def test_the_scan_equals_every_line_decoded_on_its_own(parts):
    model = pii.trained()
    texts = [" ".join(p) for p in parts]
    assert [r[5] for r in pii.scan_batch(texts, model)] == [every_line(t, model) for t in texts]


def test_long_entities_are_not_cut():
    model = pii.trained()
    names = " ".join(["Anna", "Maria"] * 10)
    text = f"Signed {names} lives in the old town"
    got = pii.scan_batch([text], model)[0][5]
    assert got == brute_crf(text, model)
    assert got.startswith("crf_person:7:") and len(text[7:int(got.split(":")[2])].split()) > 12


DOTTED = ["1", "22", "255", "300", "0", ".", "..", "@", "a", "-", " ", "x.y", "é"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(DOTTED), max_size=40))
def test_dots_digits_and_ats_equal_the_plain_patterns(parts):
    text = "".join(parts)
    assert pii.scan_batch([text], pii.trained())[0][:5] == brute_pii(text)


def plain_resolve(found):
    kept = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.order, d.start)):
        if not any(k.start <= d.start and d.end <= k.end for k in kept):
            kept.append(d)
    return kept


NOTICES = ["mit license", "licensed under the apache license version 2.0", "GNU General Public License v3", "bsd 3-clause",
           "SPDX-License-Identifier: MPL-2.0", "all rights reserved", "the", "license", "under", "public", "mit", "isc license",
           "permission is hereby granted free of charge to any person obtaining a copy", "commercial license"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(NOTICES), max_size=25))
def test_license_rules_without_prefilter_and_tree(parts):
    """Every rule tried on every text, places counted from the start, containment tested pair by pair."""
    norm, _ = licenses.word_form(", ".join(parts))
    every = [licenses.Detection(norm[:m.start()].count(b" ") - 1, norm[:m.start()].count(b" ") + m.group().count(b" "),
                                r.label, r.priority, r.confidence, k)
             for k, r in enumerate(licenses.rules()) for m in r.pattern.finditer(norm)]
    assert licenses.detect(norm) == every
    assert licenses.resolve(every) == plain_resolve(every)


def plain_entropy_spans(text, width=20):
    """Every window of every run of every class, entropy from scratch, merged as sets of places."""
    out = []
    for c in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        if secrets_scan.allowed(c.group()):
            continue
        places = set()
        for chars, least in (("0-9a-fA-F", 3.0), ("A-Za-z0-9", 3.6), ("A-Za-z0-9+/_=-", 3.8)):
            for run in re.finditer(f"[{chars}]{{20,}}", c.group()):
                for k in range(len(run.group()) - width + 1):
                    w = run.group()[k:k + width]
                    bits = -sum(w.count(x) / width * log2(w.count(x) / width) for x in set(w))
                    if abs(bits - least) < 1e-9:
                        return None  # on the bar: rounding decides
                    if bits >= least:
                        places.update(range(c.start() + run.start() + k, c.start() + run.start() + k + width))
        edges = sorted(p for p in places if p - 1 not in places)
        ends = sorted(p + 1 for p in places if p + 1 not in places)
        out += zip(edges, ends)
    return [s for s in out if not secrets_scan.allowed(text[s[0]:s[1]])]


RUNS = ["aB3dE6gH9", "QwErTyUiOp", "zzzz", "0123456789", "deadbeef", "/", "+", "-", "_", " ", "getSomeValue", "k9", "X", "=="]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(RUNS), max_size=14))
def test_entropy_spans_equal_a_plain_restatement(parts):
    text = "".join(parts)
    want = plain_entropy_spans(text)
    assert want is None or secrets_scan.entropy_spans(text) == want


def test_letter_keys_are_found_and_words_are_not():
    spans = lambda t: secrets_scan.scan(t)[4]
    assert spans("QwErTyUiOpAsDfGhJkLzXcVb") == "entropy:0:24"
    assert spans("x hJkQwZrTpLmNvBxCyDgFsAeUo y") == "entropy:2:27"
    for word in ("Donaudampfschifffahrtsgesellschaft", "getApplicationContextFactoryBean", "SOME_CONSTANT_NAME_IN_CODE",
                 "well-known-words-joined-by-hyphens", "abcdefghijklmnopqrstuvwxyz", "path/to/some/source/folder"):
        assert spans(word) == ""


def test_long_adversarial_texts_take_seconds():
    import time
    rng = np.random.default_rng(1)
    key = "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 1_000_000))
    notice = "Licensed under the MIT License and the Apache License version 2.0, General Public License. "
    model = pii.trained()
    cases = [lambda t=t: pii.scan_batch([t], model) for t in (
        "7" * 1_000_000, "a" * 500_000 + " b@c.de " + "x" * 500_000, "1." * 500_000, "1 " * 300_000 + "@" * 100_000)]
    cases += [lambda: licenses.scan(notice * 11_000), lambda: secrets_scan.scan(key),
              lambda: secrets_scan.scan("token" * 200_000), lambda: secrets_scan.scan(("f" * 24 + " ") * 40_000)]
    for case in cases:
        began = time.process_time()
        case()
        assert time.process_time() - began < 30
    assert secrets_scan.scan(key)[4].startswith("entropy:0:")
