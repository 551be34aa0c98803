"""Sentence -> list of feature ids (duplicates kept: term frequency)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..defaults import MAX_LOOKUP_BYTES, MAX_LOOKUP_KEYS
from .hits import ngram_hits
from .vocab import Vocabulary, tokenized


def feature_ids(ng, vocab: Vocabulary):
    """ARRAY<INT> of vocabulary ids for the N-grams in ``ng``, in order."""
    ids = F.transform(ng, lambda g: vocab.lookup.get(g))
    return F.filter(ids, lambda x: x.isNotNull())


def featurize(sents: DataFrame, vocab: Vocabulary, keep=("sent_id", "label"),
              max_lookup_keys: int = MAX_LOOKUP_KEYS) -> DataFrame:
    """(keep..., fids): one row per input row, sentences without hits kept.

    A vocabulary within ``max_lookup_keys``, and the lookup's bytes, is probed in-row (no shuffle);
    a larger one goes through :func:`featurize_by_join`, with the same rows and ids.
    """
    rows = tokenized(sents, vocab.n, keep=keep)
    if vocab.size > max_lookup_keys or vocab.text_bytes > MAX_LOOKUP_BYTES:
        return featurize_by_join(rows, vocab.frame(sents.sparkSession), keep)
    cols = [c for c in keep if c in rows.columns]
    return rows.select(*cols, feature_ids(F.col("ng"), vocab).alias("fids"))


def featurize_by_join(rows: DataFrame, vocab_frame: DataFrame, keep=("sent_id", "label")) -> DataFrame:
    """Join form for vocabularies too large to ship as a constant; ids in text order, as in the lookup form."""
    cols = [c for c in keep if c in rows.columns]
    found = ngram_hits(rows, vocab_frame.select("ngram", F.col("fid").alias("value")), cols)
    return found.select(*cols, F.transform("hits", lambda h: h["value"]).alias("fids"))


def explode_features(feats: DataFrame, keep=("sent_id",)) -> DataFrame:
    """(keep..., fid, cnt): term counts per sentence and feature."""
    cols = [c for c in keep if c in feats.columns]
    return (feats.select(*cols, F.explode("fids").alias("fid"))
            .groupBy(*cols, "fid").agg(F.count(F.lit(1)).alias("cnt")))
