"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

Tokens are runs of letters, runs of digits and runs of other visible
characters; a token is also seen as its shape, so that capitals and
decoration count whatever the word. Uni- and bigrams of both are hashed into
``2 ** BITS`` weights. A document's features are its distinct n-grams at
equal value, with unit length, and a bias of value 1, so a score is one sparse
dot product and a text without known n-grams gets the share of good ones.

Training: learners pass over shares of the labelled rows, at most ``SHARDS``
of at least ``ROWS_PER_SHARD`` rows, each with follow-the-regularised-leader
updates, and their weights are averaged.
``max_train_rows`` bounds the labelled rows, chosen by the hash of their id.

Defined cases: NULL and empty texts have only the bias feature; several
labels of one id count as their largest; rows without a label are not learnt;
without any label the score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, held_out, per_row, text_or_empty

BITS = 18
MAX_TRAIN_ROWS = 40_000
SHARDS, ROWS_PER_SHARD = 8, 2_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
THRESHOLD = 0.7
MEMO = 200_000

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def shape(token: str) -> str:
    """Case and kind of a token, its length class for words."""
    if token.isalpha():
        case = "A" if token.isupper() else "a" if token.islower() else "Aa"
        return f"\x01{case}{min(len(token), 12)}"
    if token.isdigit():
        return f"\x01d{min(len(token), 6)}"
    return "\x01" + token[:1] * min(len(token), 4)


class Hashes(dict):
    """Token to its word hash (upper 32 bits) and shape hash (lower 32 bits)."""

    def __missing__(self, token: str) -> int:
        got = self[token] = zlib.crc32(token.lower().encode()) << 32 | zlib.crc32(shape(token).encode())
        return got


class Hasher:
    """Text to its distinct feature numbers."""

    def __init__(self, bits: int = BITS) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.memo = Hashes()

    def __call__(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text)
        if not tokens:
            return np.zeros(1, np.int64)
        if len(self.memo) > MEMO:
            self.memo.clear()
        both = np.fromiter(map(self.memo.__getitem__, tokens), np.uint64, len(tokens))
        found = [np.zeros(1, np.uint64)]  # the bias
        for column, salt in ((both >> np.uint64(32), 0x9E3779B97F4A7C15),
                             (both & np.uint64(0xFFFFFFFF), 0xC2B2AE3D27D4EB4F)):
            mixed = column * np.uint64(salt)
            found.append(mixed >> np.uint64(40))
            if len(mixed) > 1:
                found.append((mixed[:-1] * np.uint64(0x165667B19E3779F9) + mixed[1:]) >> np.uint64(40))
        return np.unique(np.concatenate(found) & self.mask).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal passes over (features, label) rows."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    for _ in range(epochs):
        for at, label in rows:
            value = np.full(len(at), 1.0 / np.sqrt(len(at)))
            value[0] = 1.0  # the bias, always the first
            zi, ni = z[at], n[at]
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def probability(w: np.ndarray, at: np.ndarray) -> float:
    """Score of a document from its feature numbers."""
    total = w[0] + w[at[1:]].sum() / np.sqrt(len(at))
    return float(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, label): at most about ``max_rows`` rows whose label may be learnt."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label")))
    share = min(1.0, max_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # The chosen labels are bounded by max_rows, so they may be broadcast.
    return (docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
            .join(F.broadcast(known), "doc_id"))


def train(rows: DataFrame, bits: int = BITS, shards: int | None = None) -> np.ndarray | None:
    """Average weights of the shards' learners (None without labelled rows)."""
    shards = shards or max(1, min(SHARDS, rows.count() // ROWS_PER_SHARD))
    def learn(part: pd.DataFrame) -> pd.DataFrame:
        hasher = Hasher(bits)
        part = part.sort_values(["_mix", "doc_id"])
        seen = [(hasher(t), int(y)) for t, y in zip(part["text"], part["label"], strict=True)]
        out = pd.DataFrame({"rows": [len(seen)], "w": [ftrl(seen, bits).astype("<f4").tobytes()]})
        del hasher, part, seen
        give_back()
        return out

    mixed = rows.withColumn("_mix", F.xxhash64("doc_id", F.lit("order")))
    learnt = (mixed.groupBy(F.pmod("_mix", F.lit(shards)).alias("_shard"))
              .applyInPandas(learn, "rows long, w binary").collect())  # a few MB per shard
    if not learnt:
        return None
    total = sum(r["rows"] for r in learnt)
    return sum(np.frombuffer(r["w"], "<f4") * (r["rows"] / total) for r in learnt)


def score_rows(rows: DataFrame, weights: np.ndarray | None, bits: int, columns: list[str], schema: str) -> DataFrame:
    """``columns`` (the last one the text) to ``schema``: the same but with a score for the text."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def make():
        w, hasher = shared.value, Hasher(bits)

        def row(*values):
            if w is None:
                return (*values[:-1], 0.5)
            return (*values[:-1], probability(w, hasher(values[-1])))
        return row

    return per_row(rows.select(*columns), make, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS, bits: int = BITS,
                   doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                   threshold: float = THRESHOLD, carry=()) -> DataFrame:
    """(doc_id, held_out, score, predicted, carry...), one row per document."""
    weights = train(labelled(docs, labels, label, max_train_rows, doc_id, text), bits)
    rows = docs.select(F.col(doc_id).alias("doc_id"), *carry, text_or_empty(text).alias("_text"))
    names = [c for c in rows.columns if c != "_text"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) + ", score double"
    scored = score_rows(rows, weights, bits, [*names, "_text"], schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), *carry)
