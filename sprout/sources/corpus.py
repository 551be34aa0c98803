"""Seed corpus assembly: keyword filter, sense-marker seeding, union.

A tagged corpus labels a sentence from its tag text: containing the first
sense marker gives ``+``, else containing the second gives ``-``, else ``0``
(substring test, first match wins). Untagged corpora are always ``0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words
from .lines import NEGATIVE_MARK, POSITIVE_MARK, UNKNOWN_MARK, one_line


def keyword_filter(df: DataFrame, keyword: str, text: str = "text") -> DataFrame:
    """Rows whose case-preserved word list contains ``keyword`` exactly."""
    return df.where(F.array_contains(words(F.col(text)), keyword))


def seed_by_marker(tags: Column, sense_pos: str, sense_neg: str) -> Column:
    return (F.when(F.instr(tags, sense_pos) > 0, F.lit(POSITIVE_MARK))
            .when(F.instr(tags, sense_neg) > 0, F.lit(NEGATIVE_MARK))
            .otherwise(F.lit(UNKNOWN_MARK)))


def corpus_lines(df: DataFrame, corpus: str, item_id: Column, sub_id: Column, text: str,
                 marker: Column) -> DataFrame:
    """(corpus, item_id, sub_id, value): the text on one line, then the marker."""
    return df.select(F.lit(corpus).alias("corpus"), item_id.cast("long").alias("item_id"),
                     sub_id.cast("long").alias("sub_id"),
                     F.concat(one_line(F.col(text)), marker).alias("value"))


def build_corpus(keyword: str, tagged: list, untagged: list,
                 sense_pos: str, sense_neg: str) -> DataFrame:
    """Union (no dedup) of keyword sentences from every corpus.

    ``tagged``: (name, df, item id, sub id, text column, tag column) tuples.
    ``untagged``: (name, df, item id, sub id, text column) tuples.
    """
    parts = []
    for name, df, item, sub, text, tags in tagged:
        hits = keyword_filter(df, keyword, text)
        parts.append(corpus_lines(hits, name, item, sub, text,
                                  seed_by_marker(F.col(tags), sense_pos, sense_neg)))
    for name, df, item, sub, text in untagged:
        hits = keyword_filter(df, keyword, text)
        parts.append(corpus_lines(hits, name, item, sub, text, F.lit(UNKNOWN_MARK)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
