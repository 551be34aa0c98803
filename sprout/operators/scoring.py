"""Linear scores, model objects and accuracy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lookup import weight_array
from .hits import ngram_hits
from .vocab import Vocabulary


def score_features(fids: Column, weights: Column) -> Column:
    """Sum of weights over the id list (one term per occurrence)."""
    return F.aggregate(fids, F.lit(0.0), lambda acc, f: acc + F.element_at(weights, f + 1))


@dataclass
class Model:
    """Vocabulary plus one weight per feature id (missing weight = 0)."""

    vocab: Vocabulary
    weights: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.weights is None:
            self.weights = np.zeros(self.vocab.size)

    @property
    def n(self) -> int:
        return self.vocab.n

    def weight_column(self) -> Column:
        return weight_array(self.weights)

    def frame(self, spark: SparkSession) -> DataFrame:
        """(ngram, fid, weight, n) sorted by weight descending."""
        size = self.vocab.size
        table = pd.DataFrame({"ngram": pd.Series(self.vocab.ngrams, dtype="object"),
                              "fid": np.arange(size, dtype="int32"),
                              "weight": np.asarray(self.weights, dtype="float64"),
                              "n": np.full(size, self.n, dtype="int32")})
        df = spark.createDataFrame(table, "ngram string, fid int, weight double, n int")
        return df.orderBy(F.col("weight").desc(), F.col("ngram"))


def model_score(ng: Column, model: Model, finish=None) -> Column:
    """Score of a row's N-gram list under ``model``, probing in-row.

    ``finish`` maps the final score (evaluated once), e.g. to a threshold
    decision, without repeating the fold.
    """
    weights = model.weight_column()
    lookup = model.vocab.lookup

    def merge(acc, g):
        return acc + F.coalesce(F.element_at(weights, lookup.get(g) + 1), F.lit(0.0))

    if finish is None:
        return F.aggregate(ng, F.lit(0.0), merge)
    return F.aggregate(ng, F.lit(0.0), merge, finish)


def score_by_join(rows: DataFrame, model_frame: DataFrame, keys) -> DataFrame:
    """(keys..., score) for models too large to ship as a constant.

    One result per input row, whatever its keys; weights are added in text
    order, as in the lookup form, so both give the same score.
    """
    keys = list(keys)
    weights = model_frame.where("weight IS NOT NULL").select("ngram", F.col("weight").alias("value"))
    hits = ngram_hits(rows, weights, keys)
    return hits.select(*keys, F.aggregate("hits", F.lit(0.0), lambda acc, h: acc + h["value"]).alias("score"))


def accuracy(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row: accuracy (NULL on no rows), n, correct. score*label > 0 is right."""
    right = F.when(F.col(score) * F.col(label) > 0, F.lit(1)).otherwise(F.lit(0))
    return scored.agg(F.avg(right.cast("double")).alias("accuracy"),
                      F.count(F.lit(1)).alias("n"),
                      F.coalesce(F.sum(right), F.lit(0)).cast("long").alias("correct"))
