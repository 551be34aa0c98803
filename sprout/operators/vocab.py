"""N-gram statistics and vocabulary selection by information gain.

One pass over the labelled text: tokenize, slide the N-gram window, keep each
N-gram once per sentence, then a single ``groupBy(ngram)`` counts positive and
negative sentences together (partial aggregation runs map-side, so a hot
N-gram costs one row per task). The top ``m`` by information gain is a
``TakeOrderedAndProject``: each task keeps its best ``m``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lookup import HashedLookup, build_lookup
from ..functions.stats import information_gain
from ..functions.text import ngrams, tokenize

IG_DIGITS = 9  # ranking key precision: ties beyond it are broken by the N-gram
# Largest vocabulary a model may hold (one driver-side weight per feature).
MAX_DRIVER_FEATURES = 20_000_000


def tokenized(sents: DataFrame, n: int, text: str = "text", keep=("sent_id", "label")) -> DataFrame:
    """Keep ``keep`` columns and add ``ng``: the row's N-grams in order."""
    cols = [c for c in keep if c in sents.columns]
    tok = sents.select(*cols, tokenize(F.col(text)).alias("_tok"))
    return tok.select(*cols, ngrams(F.col("_tok"), n).alias("ng"))


def ngram_class_counts(sents: DataFrame, n: int, label: str = "label") -> DataFrame:
    """(ngram, pos, neg): labelled sentences of each class containing it."""
    lab = F.col(label)
    return (tokenized(sents.where(lab != 0), n, keep=("sent_id", label))
            .select(lab.alias("_lab"), F.explode(F.array_distinct("ng")).alias("ngram"))
            .groupBy("ngram")
            .agg(F.count_if(F.col("_lab") == 1).alias("pos"),
                 F.count_if(F.col("_lab") == -1).alias("neg")))


def ngram_doc_freq(sents: DataFrame, n: int) -> DataFrame:
    """(ngram, df): number of sentences that contain the N-gram."""
    return (tokenized(sents, n, keep=("sent_id",))
            .select(F.explode(F.array_distinct("ng")).alias("ngram"))
            .groupBy("ngram").agg(F.count(F.lit(1)).alias("df")))


def class_counts_with_totals(rows: DataFrame, label: Column) -> DataFrame:
    """Class counts plus, under the NULL N-gram, the sentence totals.

    ``rows`` has ``ng``; ``label`` may be any expression (for example the
    self-training label chain). The NULL key row carries P, Q and the number
    of unlabelled sentences, so one scan answers all three.
    """
    keyed = rows.select(label.alias("_lab"), "ng")
    none = F.array(F.lit(None).cast("string"))
    keys = F.when(F.col("_lab") != 0, F.concat(F.array_distinct("ng"), none)).otherwise(none)
    return (keyed.select("_lab", F.explode(keys).alias("ngram"))
            .groupBy("ngram")
            .agg(F.count_if(F.col("_lab") == 1).alias("pos"),
                 F.count_if(F.col("_lab") == -1).alias("neg"),
                 F.count_if(F.col("_lab") == 0).alias("unlabelled")))


# A top-k keeps m rows in each task and merges m x tasks rows in one; above
# this many merged rows the ranking is a distributed sort, with equal results.
TOPK_MAX = 100_000
TOPK_MERGED = 2_000_000


def rank_vocab(counts: DataFrame, positives: int, negatives: int, m: int,
               topk_max: int = TOPK_MAX) -> DataFrame:
    """Top ``m`` N-grams by information gain: (ngram, fid, ig, pos, neg).

    Undefined gain is NULL and ranks last, so such N-grams only fill the list
    when fewer than ``m`` have a defined gain. ``fid`` is the 0-based rank.
    Up to ``topk_max`` this is a ``TakeOrderedAndProject`` plus a rank window
    over at most m rows; above it, a range-partitioned global sort numbered by
    partition offsets (no single task ever holds more than its partition).
    """
    ig = F.round(information_gain(F.col("pos"), F.col("neg"), positives, negatives), IG_DIGITS)
    order = [F.col("ig").desc_nulls_last(), F.col("ngram").asc()]
    scored = counts.where(F.col("ngram").isNotNull()).select("ngram", ig.alias("ig"), "pos", "neg")
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if m > topk_max or m * tasks > TOPK_MERGED:
        return _sorted_ranking(scored, order, m)
    top = scored.orderBy(*order).limit(int(m))
    # At most m rows reach this window, by construction of the limit above.
    return top.select("ngram", (F.row_number().over(Window.orderBy(*order)) - 1).alias("fid"),
                      "ig", "pos", "neg")


def _sorted_ranking(scored: DataFrame, order: list, m: int) -> DataFrame:
    """:func:`rank_vocab` by a distributed sort of the N-grams that can be among the first ``m``.

    An approximate quantile of the gain gives a cut with a few more than ``m`` N-grams above
    it; their number is counted, and only then the rest, undefined gains included, is left out
    of the sort. The sorted rows are written first (one file per range, in order) and
    numbered by their place in the files: a task that runs again reads the same files, it
    doesn't sample other ranges.
    """
    from ..sources.fixtures import materialize_at, release
    from ..sources.lines import with_line_index
    spark = scored.sparkSession
    held, path = materialize_at(scored, "vocab-scored")
    defined = held.agg(F.count("ig")).first()[0]
    if defined > m:
        share = max(0.0, 1.0 - (1.1 * m + 100) / defined)
        cut = held.agg(F.percentile_approx("ig", share, 10_000)).first()[0]
        above = held.where(F.col("ig") >= cut)
        held = above if above.count() >= m else held.where("ig IS NOT NULL")
    ranges, sorted_path = materialize_at(held.orderBy(*order), "vocab-sorted")
    numbered = with_line_index(ranges, name="_rank").where(F.col("_rank") < m)
    top, _ = materialize_at(numbered.select("ngram", F.col("_rank").cast("int").alias("fid"), "ig", "pos", "neg"),
                            "vocab-ranked")
    release(spark, path)
    release(spark, sorted_path)
    return top


def label_totals(sents: DataFrame, label: str = "label") -> tuple[int, int, int]:
    """(positives, negatives, unlabelled) over a plain label column."""
    lab = F.col(label)
    row = sents.agg(F.count_if(lab == 1), F.count_if(lab == -1), F.count_if(lab == 0)).first()
    return int(row[0] or 0), int(row[1] or 0), int(row[2] or 0)


def select_vocab(sents: DataFrame, n: int, m: int, label: str = "label") -> DataFrame:
    """Vocabulary of the labelled rows of ``sents`` (plain label column)."""
    positives, negatives, _ = label_totals(sents, label)
    return rank_vocab(ngram_class_counts(sents, n, label), positives, negatives, m)


@dataclass(frozen=True)
class Vocabulary:
    """A selected vocabulary held on the driver (at most ``m`` rows)."""

    n: int
    ngrams: tuple[str, ...]  # position = fid
    lookup: HashedLookup  # ngram -> fid

    @property
    def size(self) -> int:
        return len(self.ngrams)

    @property
    def text_bytes(self) -> int:
        """Bytes of the N-grams' text, about."""
        return sum(map(len, self.ngrams))

    @classmethod
    def from_frame(cls, vocab: DataFrame, n: int) -> "Vocabulary":
        """Collect a ranked vocabulary (ngram, fid) — bounded by ``m``.

        The model keeps one weight per feature on the driver, so ``m`` is
        capped at ``MAX_DRIVER_FEATURES``; the bound is checked before
        more than that is collected.
        """
        rows = (vocab.select("ngram", "fid", F.xxhash64("ngram").alias("_h"))
                .limit(MAX_DRIVER_FEATURES + 1).collect())
        if len(rows) > MAX_DRIVER_FEATURES:
            raise ValueError(f"vocabulary exceeds {MAX_DRIVER_FEATURES} rows; use a smaller m")
        ordered = sorted(rows, key=lambda r: r["fid"])
        if [r["fid"] for r in ordered] != list(range(len(ordered))):
            raise ValueError("feature ids must be 0..m-1")
        return cls(n, tuple(r["ngram"] for r in ordered),
                   build_lookup([(r[0], r[1], r[2]) for r in rows]))

    def frame(self, spark: SparkSession) -> DataFrame:
        import numpy as np
        import pandas as pd
        table = pd.DataFrame({"ngram": pd.Series(self.ngrams, dtype="object"),
                              "fid": np.arange(self.size, dtype="int32")})
        return spark.createDataFrame(table, "ngram string, fid int")

