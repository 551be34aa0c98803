"""Batch scoring of any text table against a saved model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..defaults import MAX_LOOKUP_BYTES, MAX_LOOKUP_KEYS
from ..functions.lookup import build_lookup
from ..functions.stats import sign_marker
from ..operators.scoring import Model, model_score, score_by_join
from ..operators.vocab import Vocabulary, tokenized


def load_model(model_frame: DataFrame, limit: int | None = None) -> Model | None:
    """Collect a model table (ngram, fid, weight, n) — at most m rows.

    With ``limit``, at most ``limit + 1`` rows are collected and ``None`` is
    returned when the table is larger, or its text is larger than
    ``MAX_LOOKUP_BYTES`` (the caller then joins instead).
    """
    rows = model_frame.select("ngram", "fid", "weight", "n", F.xxhash64("ngram").alias("_h"))
    rows = (rows.limit(limit + 1) if limit is not None else rows).collect()
    if limit is not None and (len(rows) > limit or sum(len(r["ngram"]) for r in rows) > MAX_LOOKUP_BYTES):
        return None
    rows.sort(key=lambda r: r["fid"])
    if not rows:
        raise ValueError("empty model")
    n = int(rows[0]["n"])
    vocab = Vocabulary(n, tuple(r["ngram"] for r in rows),
                       build_lookup([(r["ngram"], r["fid"], r["_h"]) for r in rows]))
    return Model(vocab, np.array([float(r["weight"]) for r in rows]))


def score_batch(texts: DataFrame, model_frame: DataFrame, keys, text: str = "text",
                max_lookup_keys: int = MAX_LOOKUP_KEYS) -> DataFrame:
    """(keys..., score, label): label '+' when score > 0, else '-'.

    Models within ``max_lookup_keys`` rows are probed in-row (narrow, no
    shuffle); larger ones are joined on the N-gram. One bounded collect
    decides which.
    """
    keys = list(keys)
    model = load_model(model_frame, limit=max_lookup_keys)
    if model is None:
        n = int(model_frame.select("n").first()["n"])
        rows = tokenized(texts, n, text=text, keep=keys)
        scored = score_by_join(rows, model_frame, keys)
    else:
        rows = tokenized(texts, model.n, text=text, keep=keys)
        scored = rows.select(*keys, model_score(F.col("ng"), model).alias("score"))
    return scored.select(*keys, "score", sign_marker(F.col("score")).alias("label"))
