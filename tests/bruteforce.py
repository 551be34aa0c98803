"""Plain-Python statement of the algorithm, for checking Spark results on
small fixtures. Written from the specification, independently of the
DataFrame code; slow by design."""

from __future__ import annotations

import math
import re

import pyarrow.parquet as pq

TOKEN = re.compile(r"[a-z]+(?:'[a-z]+)?")


def load_sentences(sf_dir):
    docs = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    out = []
    for d in docs:
        q = labels.get(d["doc_id"])
        out.append((d["doc_id"], d["text"], 1 if q == 1 else (-1 if q == 0 else 0)))
    return out


def split(sents):
    test = [s for s in sents if s[2] != 0 and s[0] % 5 == 0]
    train = [s for s in sents if not (s[2] != 0 and s[0] % 5 == 0)]
    return train, test


def tokens(text):
    return TOKEN.findall(text.lower())


def ngrams(text, n):
    t = tokens(text)
    if len(t) < n:
        return []
    return [" ".join(t[i:i + n]) for i in range(len(t) - n + 1)]


def log2(x):
    return math.log10(x) / math.log10(2.0)


def info_gain(p1, n1, P, Q):
    p2, n2 = P - p1, Q - n1
    if not (p1 > 0 and n1 > 0 and p2 > 0 and n2 > 0):
        return None
    w1 = (p1 + n1) / (P + Q)
    w2 = 1 - w1
    a = p1 / (p1 + n1)
    b = p2 / (p2 + n2)
    return w1 * (a * log2(a) + (1 - a) * log2(1 - a)) + w2 * (a * log2(b) + (1 - b) * log2(1 - b))


def vocab(rows, n, m):
    """rows: (text, label). Returns list of ngrams in fid order."""
    P = sum(1 for _, l in rows if l == 1)
    Q = sum(1 for _, l in rows if l == -1)
    pos, neg = {}, {}
    for text, lab in rows:
        if lab == 0:
            continue
        for g in set(ngrams(text, n)):
            d = pos if lab == 1 else neg
            d[g] = d.get(g, 0) + 1
            (neg if lab == 1 else pos).setdefault(g, 0)
    scored = []
    for g in pos:
        ig = info_gain(pos[g], neg[g], P, Q)
        scored.append((g, None if ig is None else round(ig, 9)))
    scored.sort(key=lambda x: (x[1] is None, -(x[1] or 0.0), x[0]))
    return [g for g, _ in scored[:m]]


def featurize(text, fmap, n):
    return [fmap[g] for g in ngrams(text, n) if g in fmap]


def score(fids, w):
    return sum(w.get(f, 0.0) for f in fids)


def train(feats, n_iter, alpha, delta):
    w = {}
    l1s = []
    for _ in range(n_iter):
        d = {}
        for fids, lab in feats:
            y = 1 if lab > 0 else 0
            s = score(fids, w)
            p = 1.0 / (1 + math.exp(-s)) if s > -700 else 0.0
            for f in fids:
                d[f] = d.get(f, 0.0) + (y - p) * alpha
        w = {f: v + w.get(f, 0.0) for f, v in d.items()}
        l1 = sum(abs(v) for v in d.values())
        l1s.append(l1)
        if l1 < delta:
            break
    return w, l1s


def cut(s, t):
    return 1 if s > t else (-1 if s < -t else 0)


def accuracy(rows, fmap, w, n):
    if not rows:
        return None
    ok = sum(1 for text, lab in rows if score(featurize(text, fmap, n), w) * lab > 0)
    return ok / len(rows)


def self_train(train_rows, n, m, n_iter, threshold, alpha, delta, max_rounds=None):
    """train_rows: list of (sent_id, text, label). Sticky labels."""
    labels = {sid: lab for sid, _, lab in train_rows}
    texts = {sid: text for sid, text, _ in train_rows}
    prev = None
    rounds = 0
    models = []
    while True:
        unl = sum(1 for v in labels.values() if v == 0)
        if rounds > 0 and (unl == 0 or unl == prev or (max_rounds and rounds >= max_rounds)):
            break
        prev = unl
        rows = [(texts[s], labels[s]) for s in labels]
        voc = vocab(rows, n, m)
        fmap = {g: i for i, g in enumerate(voc)}
        feats = [(featurize(texts[s], fmap, n), labels[s]) for s in labels if labels[s] != 0]
        w, l1s = train(feats, n_iter, alpha, delta)
        models.append((fmap, w, l1s))
        new = {}
        for s, lab in labels.items():
            if lab == 0:
                lab = cut(score(featurize(texts[s], fmap, n), w), threshold)
            new[s] = lab
        labels = new
        rounds += 1
    return labels, models
