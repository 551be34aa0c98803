"""Self-training: grow labels from seeds, one model per round.

Round k ranks N-grams over the rows labelled so far, trains a model on them,
and labels each still-unknown row whose score clears the threshold; labels
stick once set. The loop stops when no row is unknown or a round labels
nothing new (or at ``max_rounds``, a safety limit that is off by default).

Text is tokenized once: the rows are written as (_row, sent_id, text, label, ng) under
``spark.checkpoint.dir``, and no round reads the text again. What a round
labels is written as a small table of its own (its rows, labels and N-grams). A
round therefore reads

* the labelled rows, which are the seeds and those tables, for its training;
* the rows that are unknown still, once, to score them under its one model.

The labelled rows are left out of the unknown ones by their row numbers; every
``checkpoint_every`` rounds the unknown rows are written anew without them and the
round tables become one. Every table is a reliable copy: a lost executor costs
a scan of files.

Labels stick, so class counts only grow: a round adds the counts of the rows
it has just labelled to the counts it had.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import defaults
from ..functions.stats import threshold_decision
from ..operators.features import feature_ids, featurize_by_join
from ..operators.scoring import Model, accuracy, model_score, score_by_join
from ..operators.vocab import Vocabulary, class_counts_with_totals, rank_vocab, tokenized
from ..sources.fixtures import bounded, materialize, materialize_at, release, split_train_test
from .train import train_weights


CHECKPOINT_EVERY = 10  # rounds between reliable state checkpoints


def label_chain(seed: Column, ng: Column, models: list, threshold: float) -> Column:
    """First non-zero of the seed label and each round's threshold cut."""
    if not models:
        return seed
    # One fold per model; the finish step yields 1 / -1, or NULL when undecided.
    cuts = [model_score(ng, model, lambda s: threshold_decision(s, threshold)) for model in models]
    return F.coalesce(F.nullif(seed, F.lit(0)), *cuts, F.lit(0))


@dataclass
class RoundInfo:
    round: int
    positives: int
    negatives: int
    unlabelled_before: int
    vocab_size: int
    epochs: int
    last_l1: float | None
    train_accuracy: float | None
    seconds: float | None = None  # wall time of the round (ranking, training, state)


@dataclass
class SelfTrainResult:
    labels: DataFrame | None  # (sent_id, label) for the training rows
    model: Model | None
    models: list
    threshold: float
    history: list = field(default_factory=list)
    unlabelled_after: int = 0
    test_accuracy: float | None = None
    source: DataFrame | None = None  # (_row, sent_id, text, label) of the training rows, seed labels
    decided: DataFrame | None = None  # (_row, label) of all rows labelled by a round
    n: int = defaults.N
    frame: DataFrame | None = None  # model table, when the model is not held on the driver

    def labelled_text(self) -> DataFrame:
        """(sent_id, text, label) after the last round."""
        grown = bounded(self.decided.select("_row", F.col("label").alias("_new")))
        label = F.coalesce(F.nullif(F.col("label"), F.lit(0)), F.col("_new"), F.lit(0))
        return self.source.join(grown, "_row", "left").select("sent_id", "text", label.alias("label"))

    def model_frame(self, spark) -> DataFrame:
        """(ngram, fid, weight, n) of the last model."""
        return self.frame if self.frame is not None else self.model.frame(spark)


def _totals(counts: DataFrame) -> tuple[int, int, int]:
    row = counts.where(F.col("ngram").isNull()).select("pos", "neg", "unlabelled").first()
    if row is None:
        return 0, 0, 0
    return int(row[0]), int(row[1]), int(row[2])


@dataclass
class FirstRound:
    """Round 1 computed elsewhere (shared by configurations with equal seeds)."""

    model: Model
    info: RoundInfo
    unlabelled: int  # unknown rows before round 1


def shuffles(df: DataFrame) -> bool:
    """Whether the plan moves rows between tasks (read from the plan, nothing runs)."""
    return "Exchange" in df._jdf.queryExecution().sparkPlan().toString() or \
        "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def _prepare(train: DataFrame, materialize_input: bool = False) -> tuple[DataFrame, bool]:
    """Spread a small input over the cluster's cores; write a shuffled one.

    An input that is a bare scan with no more splits than the default
    parallelism is small (a split is at most one file block), so it is
    round-robin spread (if needed) and cached. An input whose plan shuffles is
    written once first: rounds then scan files instead of repeating its joins.
    """
    spark = train.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if materialize_input or shuffles(train):
        train = materialize(train.select("sent_id", "text", "label"), "selftrain-input")
    parts = train.rdd.getNumPartitions()
    if parts < cores:
        return train.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK), True
    if parts == cores:  # already spread by the reader: small, cache it
        return train.persist(StorageLevel.MEMORY_AND_DISK), True
    return train, False


class State:
    """Tables of a running self-training: tokens, what is labelled and what is unknown."""

    def __init__(self, train: DataFrame, n: int, small: bool) -> None:
        self.spark, self.small = train.sparkSession, small
        # Rows are numbered as they are written, once: repeated or NULL ids stay separate rows.
        numbered = train.select("sent_id", "text", "label", F.monotonically_increasing_id().alias("_row"))
        tokens = tokenized(numbered, n, keep=("_row", "sent_id", "text", "label"))
        self.tokens, self.path = materialize_at(tokens, "selftrain-tokens")
        self.seeds = self.tokens.where(F.col("label") != 0).select("label", "ng")
        self.base, self.base_path = self.tokens.where(F.col("label") == 0).select("_row", "ng"), None
        self.rounds: list[tuple[DataFrame, str]] = []  # (_row, label, ng) labelled by each round
        self.folded = 0  # leading tables of ``rounds`` that ``base`` no longer holds
        self._cache()

    def _cache(self) -> None:
        """A small input's unknown rows are kept in memory, a large one's are read every round."""
        if self.small:
            cores = self.spark.sparkContext.defaultParallelism
            self.base = self.base.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)

    def labelled(self) -> DataFrame:
        """(label, ng) of all rows labelled so far."""
        return reduce(DataFrame.unionByName, [t.select("label", "ng") for t, _ in self.rounds], self.seeds)

    def unknown(self) -> DataFrame:
        """(_row, ng) of the rows that no round has labelled."""
        fresh = [t.select("_row") for t, _ in self.rounds[self.folded:]]
        if not fresh:
            return self.base
        return self.base.join(bounded(reduce(DataFrame.unionByName, fresh)), "_row", "left_anti")

    def add(self, decided: DataFrame) -> DataFrame:
        """Write the rows that a round has labelled (_row, label, ng)."""
        self.rounds.append(materialize_at(decided, "selftrain-round"))
        return self.rounds[-1][0]

    def fold(self) -> None:
        """Unknown rows without the labelled ones, the rounds' tables as one."""
        base, base_path = materialize_at(self.unknown(), "selftrain-unknown")
        merged = materialize_at(reduce(DataFrame.unionByName, [t for t, _ in self.rounds]), "selftrain-rounds")
        if self.small:
            self.base.unpersist()
        for path in [p for _, p in self.rounds] + [self.base_path]:
            release(self.spark, path)
        self.base, self.base_path, self.rounds, self.folded = base, base_path, [merged], 1
        self._cache()

    def decided(self) -> DataFrame:
        """(_row, label) of all rows labelled by a round; its tables stay for the result."""
        empty = self.tokens.where("false").select("_row", "label")
        return reduce(DataFrame.unionByName, [t.select("_row", "label") for t, _ in self.rounds], empty)

    def close(self) -> None:
        if self.small:
            self.base.unpersist()
        release(self.spark, self.base_path)


@dataclass
class LookupRound:
    """A round whose vocabulary travels to the tasks as a constant."""

    vocab: Vocabulary
    model: Model | None = None
    frame: DataFrame | None = None

    @property
    def size(self) -> int:
        return self.vocab.size

    def features(self, labelled: DataFrame) -> DataFrame:
        return labelled.select("label", feature_ids(F.col("ng"), self.vocab).alias("fids"))

    def fitted(self, weights: np.ndarray) -> None:
        self.model = Model(self.vocab, weights)

    def decide(self, unknown: DataFrame, threshold: float) -> DataFrame:
        cut = model_score(F.col("ng"), self.model, lambda s: threshold_decision(s, threshold))
        return unknown.select("_row", cut.alias("label"), "ng").where(F.col("label").isNotNull())

    def release(self, spark) -> None:
        pass


@dataclass
class JoinedRound:
    """A round whose vocabulary is too large for that: joined, never collected.

    Only the m weights come to the driver.
    """

    vocab: DataFrame  # (ngram, fid)
    path: str
    n: int
    size: int = 0
    model: Model | None = None
    frame: DataFrame | None = None

    def features(self, labelled: DataFrame) -> DataFrame:
        return featurize_by_join(labelled, self.vocab, keep=("label",))

    def fitted(self, weights: np.ndarray) -> None:
        table = pd.DataFrame({"fid": np.arange(self.size, dtype="int32"), "weight": weights.astype("float64")})
        self.frame = (self.vocab.join(self.vocab.sparkSession.createDataFrame(table), "fid", "left")
                      .select("ngram", "fid", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.lit(self.n).alias("n")))

    def decide(self, unknown: DataFrame, threshold: float) -> DataFrame:
        scored = score_by_join(unknown, self.frame, ["_row"])
        cut = (scored.select("_row", threshold_decision(F.col("score"), threshold).alias("label"))
               .where(F.col("label").isNotNull()))
        cut, path = materialize_at(cut, "selftrain-decisions")
        self.cuts = path
        return unknown.join(bounded(cut), "_row").select("_row", "label", "ng")

    def release(self, spark) -> None:
        release(spark, getattr(self, "cuts", None))
        self.cuts = None


def next_round(counts: DataFrame, positives: int, negatives: int, n: int, m: int, max_lookup_keys: int):
    """Rank the vocabulary: held as a constant within the bounds on keys and bytes, as a table beyond them."""
    ranked = rank_vocab(counts, positives, negatives, m)
    if m <= max_lookup_keys:
        vocab = Vocabulary.from_frame(ranked, n)
        if vocab.text_bytes <= defaults.MAX_LOOKUP_BYTES:
            return LookupRound(vocab)
        ranked = vocab.frame(counts.sparkSession)
    table, path = materialize_at(ranked.select("ngram", "fid"), "vocab-joined")
    return JoinedRound(table, path, n, table.count())


def self_train(train: DataFrame, test: DataFrame | None = None, n: int = defaults.N,
               m: int = defaults.M, n_iter: int = defaults.NUM_ITER,
               threshold: float = defaults.THRESHOLD, alpha: float = defaults.ALPHA,
               delta: float = defaults.DELTA, max_rounds: int | None = None,
               refresh_vocab: bool = True, materialize_input: bool = False,
               prepared: bool = False, checkpoint_every: int = CHECKPOINT_EVERY,
               max_lookup_keys: int = defaults.MAX_LOOKUP_KEYS) -> SelfTrainResult:
    """Run self-training on ``train`` (sent_id, text, label in {1,-1,0}).

    ``n_iter`` is the exact number of epochs per training (pass n_iter + 1
    to reproduce the Scala loop bounds). ``refresh_vocab=False`` keeps the
    first round's vocabulary, as the notebook variant does. A vocabulary
    larger than ``max_lookup_keys``, or than the lookup's bytes, is joined instead of
    looked up, with the same labels.
    """
    spark = train.sparkSession
    small = prepared and train.is_cached
    owned = None  # a cached copy made here, released before returning
    if not prepared:
        train, small = _prepare(train, materialize_input)
        owned = train if small else None
    state = State(train, n, small)
    if owned is not None:
        owned.unpersist()
    # One row of totals for unlabelled rows, N-grams for labelled ones: one scan answers both.
    counts, counts_path = materialize_at(
        class_counts_with_totals(state.tokens.select("label", "ng"), F.col("label")), "class-counts")
    models: list[Model | None] = []
    history: list[RoundInfo] = []
    current, unlabelled_prev = None, None
    while True:
        started = time.perf_counter()
        positives, negatives, unlabelled = _totals(counts)
        if models and (unlabelled == 0 or unlabelled == unlabelled_prev
                       or (max_rounds is not None and len(models) >= max_rounds)):
            break
        if current is None or refresh_vocab:
            previous = current
            current = next_round(counts, positives, negatives, n, m, max_lookup_keys)
            if isinstance(previous, JoinedRound):
                release(spark, previous.path)
        unlabelled_prev = unlabelled
        fit = train_weights(current.features(state.labelled()), current.size, n_iter, alpha, delta, measure=True)
        current.fitted(fit.weights)
        models.append(current.model)
        history.append(RoundInfo(len(models), positives, negatives, unlabelled, current.size, fit.epochs,
                                 fit.l1[-1] if fit.l1 else None, fit.train_accuracy))
        fresh = state.add(current.decide(state.unknown(), threshold))
        current.release(spark)
        counts, counts_path = grown_counts(counts, counts_path, fresh)
        if checkpoint_every and len(state.rounds) - state.folded >= checkpoint_every:
            state.fold()
        history[-1].seconds = round(time.perf_counter() - started, 3)
    release(spark, counts_path)
    state.close()
    result = SelfTrainResult(None, current.model, models, threshold, history, unlabelled, n=n, frame=current.frame,
                             source=state.tokens.select("_row", "sent_id", "text", "label"), decided=state.decided())
    result.labels = result.labelled_text().select("sent_id", "label")
    if test is not None:
        result.test_accuracy = evaluate(test, current.model) if current.model is not None else accuracy(score_by_join(
            tokenized(test, n, keep=("sent_id", "label")), current.frame, ["sent_id", "label"])).first()["accuracy"]
    return result


def grown_counts(counts: DataFrame, path: str, fresh: DataFrame) -> tuple[DataFrame, str]:
    """Class counts after the rows of ``fresh`` (label, ng) were labelled.

    The new copy replaces the one at ``path``. The NULL key holds the totals: a
    row that is labelled moves from the unknown to its class.
    """
    more = class_counts_with_totals(fresh, F.col("label"))
    more = more.withColumn("unlabelled", F.when(F.col("ngram").isNull(), -(F.col("pos") + F.col("neg"))).otherwise(F.lit(0)))
    grown = counts.unionByName(more).groupBy("ngram").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "unlabelled")])
    out = materialize_at(grown, "class-counts")
    release(counts.sparkSession, path)
    return out


def score_rows(sents: DataFrame, model: Model, keep=("sent_id", "label")) -> DataFrame:
    """(keep..., score) for every row of ``sents`` under ``model``."""
    rows = tokenized(sents, model.n, keep=keep)
    cols = [c for c in keep if c in rows.columns]
    return rows.select(*cols, model_score(F.col("ng"), model).alias("score"))


def evaluate(test: DataFrame, model: Model) -> float | None:
    """Held-out accuracy (None when there are no test rows)."""
    return accuracy(score_rows(test, model)).first()["accuracy"]


def self_train_sentences(sents: DataFrame, **params) -> SelfTrainResult:
    """Split ``sents`` into train/test (every 5th labelled row) and run."""
    train, test = split_train_test(sents)
    return self_train(train, test, **params)
