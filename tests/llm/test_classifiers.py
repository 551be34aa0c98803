import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from llm_fixtures import SF, docs, empty  # noqa: F401
from sprout.llm import ftrl, toxicity
from sprout.llm.common import held_out
from sprout.llm.ftrl import quality_scores
from sprout.llm.toxicity import toxicity_scores

MID = SF.replace("0.001", "0.01")


def auc(label, score):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1 = label.sum()
    return (order[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize("fn, label, least, cut", [(quality_scores, "quality", 0.95, 0.7),
                                                   (toxicity_scores, "toxic", 0.75, 0.3)])
def test_held_out_accuracy(spark, fn, label, least, cut):
    docs, labels = spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")
    rows = fn(docs, labels).toPandas()
    assert len(rows) == docs.count()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"]]).all()
    assert ((rows["predicted"] == 1) == (rows["score"] >= cut)).all()
    assert rows["score"].between(0, 1).all()
    both = rows.merge(labels.toPandas(), on="doc_id")
    own = both[both["held_out"]]
    assert auc(own[label].to_numpy(), own["score"].to_numpy()) >= least


@pytest.mark.parametrize("fn", [quality_scores, toxicity_scores])
def test_awkward_tables(spark, docs, empty, fn):
    few = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, 1, 0), (17, 0, 1), (None, 1, 1), (99, None, None)],
                                "doc_id long, quality int, toxic int")
    none = few.where("false")
    for labels in (few, none):
        got = fn(docs, labels).collect()
        assert len(got) == docs.count()
        assert all(0 <= r["score"] <= 1 for r in got)
    assert fn(empty, few).collect() == []


def test_held_out_rows_are_never_learnt(spark):
    rows = [(i, f"good words here {i}", i % 2) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    seen = ftrl.labelled(docs, labels, "quality", 10_000)
    assert seen.where(held_out(seen["doc_id"])).count() == 0
    assert seen.count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))
    assert ftrl.labelled(docs, labels, "quality", 50).count() < 100


def test_ftrl_separates():
    hasher = ftrl.Hasher(14)
    rows = [(hasher("nice calm prose of many words"), 1), (hasher("### !!! $$$ SHOUT"), 0)] * 20
    w = ftrl.ftrl(rows, 14)
    score = lambda t: w[hasher(t)].sum()
    assert score("nice calm prose") > 0 > score("### !!!")


def test_toxicity_features():
    calm, rude = toxicity.features("a calm text of nice words"), toxicity.features("You are an idiot, you MORON!! 1d!ot")
    assert len(calm) == len(rude) == toxicity.FEATURES
    assert calm[0] == 0 and rude[0] > 0 and rude[6] > 0 and rude[8] > 0 and rude[12] > 0
    assert toxicity.features("") == toxicity.features(" \n") == [0.0] * toxicity.FEATURES


def plain_quality(rows, labels, threshold=0.7, bits=18):
    """The classifier restated: dictionaries of weights, one coordinate at a time."""
    import re
    import xxhash
    mask = (1 << bits) - 1

    def shape(t):
        if t.isalpha():
            return "\x01" + ("A" if t.isupper() else "a" if t.islower() else "Aa") + str(min(len(t), 12))
        return f"\x01d{min(len(t), 6)}" if t.isdigit() else "\x01" + t[:1] * min(len(t), 4)

    def numbers(text):
        tokens = re.findall(r"[^\W\d_]+|\d+|[^\w\s]+|_+", text or "")
        found = {0}
        for form, salt in ((str.lower, 0x9E3779B97F4A7C15), (shape, 0xC2B2AE3D27D4EB4F)):
            mixed = [zlib.crc32(form(t).encode()) * salt % 2**64 for t in tokens]
            found |= {m >> 40 & mask for m in mixed}
            found |= {((a * 0x165667B19E3779F9 + b) % 2**64) >> 40 & mask for a, b in zip(mixed, mixed[1:])}
        return sorted(found)

    def order(i):
        first = xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), 42)
        h = xxhash.xxh64_intdigest(b"order", first)
        return h - 2**64 if h >> 63 else h
    known = sorted((order(i), i, t, labels[i]) for i, t in rows if i in labels and zlib.crc32(str(i).encode()) % 4 != 2)
    z, n = {}, {}
    alpha, beta, l1, l2 = 0.5, 1.0, 1e-3, 1e-3

    def weight(k):
        zi = z.get(k, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - (l1 if zi > 0 else -l1)) / ((beta + n.get(k, 0.0) ** 0.5) / alpha + l2)

    def chance(own, w):
        total = sum(w(k) * (1.0 if k == 0 else len(own) ** -0.5) for k in own)
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))
    for _ in range(4):
        for _, _, t, y in known:
            own = numbers(t)
            p = chance(own, weight)
            for k, wk in [(k, weight(k)) for k in own]:
                g = (p - y) * (1.0 if k == 0 else len(own) ** -0.5)
                before = n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - ((before + g * g) ** 0.5 - before ** 0.5) / alpha * wk
                n[k] = before + g * g
    score = {i: float(chance(numbers(t), weight)) for i, t in rows}
    return {i: (s, int(s >= threshold)) for i, s in score.items()}


def test_quality_equals_a_plain_restatement(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = plain_quality([(r["doc_id"], r["text"]) for r in d.collect()],
                         {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None})
    got = {r["doc_id"]: r for r in quality_scores(d, labels).collect()}
    assert got.keys() == want.keys()
    for i, (score, predicted) in want.items():
        assert abs(got[i]["score"] - score) < 1e-5
        assert got[i]["predicted"] == predicted or abs(score - 0.7) < 1e-5


def test_calibration_rows_teach_no_words(spark, monkeypatch):
    ids = spark.range(400).withColumn("own", toxicity.for_calibration("id")).collect()
    rows = [(r["id"], "calm words of a day " + ("zork" if r["own"] else "blurg") * (r["id"] % 2), int(r["id"] % 2)) for r in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other int").withColumn(
        "text", F.concat("text", F.lit(" number "), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    seen = []
    learn = toxicity.learnt_words
    monkeypatch.setattr(toxicity, "learnt_words", lambda known: seen.append(learn(known)) or seen[-1])
    toxicity_scores(docs, labels)
    assert "blurg" in seen[0] and "zork" not in seen[0]


WORDS = ["idiot", "Stupid", "YOU", "you", "calm", "Wörter", "1d!ot", "st0pid", "!!", "...", "a", "Ab", "NEIN", "7", "x9y", "'moron'"]


def test_toxicity_features_equal_a_plain_restatement():
    import random
    import re
    from math import log1p
    rng = random.Random(6)
    insults, persons = toxicity.LEXICON, toxicity.SECOND_PERSON
    alike = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
    for _ in range(300):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 40)))
        words = re.findall(r"[^\W\d_]+", text)
        low = [w.lower() for w in words]
        bad = [k for k, w in enumerate(low) if w in insults]
        near = sum(any(abs(j - k) <= 5 and low[j] in persons for j in range(len(low))) for k in bad)
        pieces = [t.strip(".,;:!?()[]{}\"'|*#$%&-") for t in text.split()]
        odd = [t for t in pieces if not t.isalpha() and re.search(r"[^\W\d_]", t)]
        plain = ["".join(c for c in (alike.get(c, c) for c in t.lower()) if c.isalpha()) for t in odd]
        taught = [w for w in low if w == "calm"]
        n, chars = max(1, len(words)), len(text)
        want = [len(bad) / n, log1p(len(bad)), len({low[k] for k in bad}), len(taught) / n, log1p(len(taught)),
                sum(w in persons for w in low) / n, near / n, sum(c.isupper() for c in text) / chars,
                sum(len(w) > 1 and w.isupper() for w in words) / n, sum(not (c.isalnum() or c == "_" or c.isspace()) for c in text) / chars,
                text.count("!") / chars, len(odd) / n, sum(p in insults or p == "calm" for p in plain) / n, log1p(n)]
        assert np.allclose(toxicity.features(text, frozenset(["calm"])), want), text
