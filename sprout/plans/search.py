"""Hyperparameter search over an inclusive grid.

Configurations are numbered in loop order (N outermost, then m, num_iter,
threshold, alpha, delta innermost), and the best is the first with the
highest held-out accuracy. Round 1 depends only on the seeds, so it is shared:
one class-count job and one ranking (with the largest m) per N, and one
training per distinct (N, m, num_iter, alpha, delta), those of a chunk advanced
by the same epoch jobs.

Later rounds diverge with the labels each configuration grows, but those of a
chunk still run together: the state row (sent_id, ng, labs) carries one label per
configuration, an N-gram is exploded once and one ``groupBy(ngram)`` holds a pair of class
counts per configuration, and every training epoch is one job over the blocks of
all configurations still training. A configuration that stops drops out. The
width of a chunk is bounded, so neither the state row nor the plan grows with
the grid. Per-configuration labels live in one array column, advanced in-row by
each configuration's models and folded into a Parquet base every
``checkpoint_every`` rounds, sooner if the chained models would exceed the lookup bound.

Grid values are exact decimals (0.5 + 3 x 0.1 is 0.8, not 0.7999...).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import MAX_LOOKUP_KEYS
from ..functions.lookup import build_lookup
from ..operators.features import feature_ids
from ..operators.scoring import Model, model_score
from ..operators.vocab import Vocabulary, class_counts_with_totals, rank_vocab, tokenized
from ..sources.fixtures import materialize_at, release, spread_small
from .selftrain import (CHECKPOINT_EVERY, FirstRound, RoundInfo, _prepare, _totals, label_chain,
                        self_train)
from .train import train_weights_batched

PARAMS = ("n", "m", "num_iter", "threshold", "alpha", "delta")
INT_PARAMS = ("n", "m", "num_iter")
CHUNK = 16  # configurations that advance together


@dataclass(frozen=True)
class Config:
    config_id: int
    n: int
    m: int
    num_iter: int
    threshold: float
    alpha: float
    delta: float


def inclusive_range(start, end, step) -> list[Decimal]:
    s, e, st = (Decimal(repr(x)) if isinstance(x, float) else Decimal(x) for x in (start, end, step))
    if st <= 0:
        raise ValueError("step must be positive")
    out, v = [], s
    while v <= e:
        out.append(v)
        v += st
    return out


def grid_configs(**ranges) -> list[Config]:
    """All configurations in loop order; each range is (start, end, step)."""
    values = [inclusive_range(*ranges[p]) for p in PARAMS]
    configs: list[Config] = []

    def walk(depth, chosen):
        if depth == len(PARAMS):
            kw = {p: (int(v) if p in INT_PARAMS else float(v)) for p, v in zip(PARAMS, chosen)}
            configs.append(Config(len(configs), **kw))
            return
        for v in values[depth]:
            walk(depth + 1, chosen + [v])

    walk(0, [])
    return configs


def config_grid(spark: SparkSession, **ranges) -> DataFrame:
    rows = [(c.config_id, c.n, c.m, c.num_iter, c.threshold, c.alpha, c.delta) for c in grid_configs(**ranges)]
    return spark.createDataFrame(rows, "config_id int, n int, m int, num_iter int, threshold double, "
                                       "alpha double, delta double")


def _below(limit: int):
    """One-argument predicate ``f < limit`` (a closure: Spark reads the arity)."""
    return lambda f: f < F.lit(limit)


def _key(c: Config) -> tuple:
    """What round 1 depends on: all but the threshold."""
    return (c.n, c.m, c.num_iter, c.alpha, c.delta)


def chunked(configs: list, width: int | None, max_keys: int) -> list[list]:
    """Configurations of one N in chunks that advance together.

    A chunk has at most ``width`` configurations (None: no limit of its own),
    whose vocabularies together stay within the lookup bound. Configurations with an equal
    first round stand next to each other, so that it is computed for one chunk,
    or two adjacent ones.
    """
    chunks, keys = [], 0
    for c in sorted(configs, key=lambda c: (_key(c), c.config_id)):
        if not chunks or (width is not None and len(chunks[-1]) >= width) or keys + c.m > max_keys:
            chunks.append([])
            keys = 0
        chunks[-1].append(c)
        keys += c.m
    return chunks


class SharedFirstRound:
    """Round 1 of every configuration of one N, from the stored tokens (sent_id, label, ng).

    One class-count job and one ranking, with the largest m: the vocabulary of a smaller m
    is a prefix. The labelled rows are written once as ids under the widest vocabulary;
    trainings take what is below their m from that copy, chunk by chunk.
    """

    def __init__(self, rows: DataFrame, n: int, m: int) -> None:
        self.n, self.done = n, {}
        counts = class_counts_with_totals(rows, F.col("label")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.totals = _totals(counts)
            ranked = rank_vocab(counts, *self.totals[:2], m)
            ranking = ranked.select("ngram", "fid", F.xxhash64("ngram").alias("_h")).collect()
        finally:
            counts.unpersist()
        self.ranking = sorted(ranking, key=lambda r: r["fid"])
        widest = self._vocabulary(m)
        self.labelled, self.path = materialize_at(
            rows.where(F.col("label") != 0).select("label", feature_ids(F.col("ng"), widest).alias("ids")),
            "search-first-round")

    def _vocabulary(self, m: int) -> Vocabulary:
        top = self.ranking[:m]
        return Vocabulary(self.n, tuple(r["ngram"] for r in top),
                          build_lookup([(r["ngram"], r["fid"], r["_h"]) for r in top]))

    def models(self, configs: list) -> dict[tuple, FirstRound]:
        """First rounds of ``configs`` by :func:`_key`; those of the chunk before are reused, older ones dropped."""
        keys = sorted({_key(c) for c in configs})
        self.done = {k: v for k, v in self.done.items() if k in keys}
        fresh = [k for k in keys if k not in self.done]
        if fresh:
            vocabs = [self._vocabulary(k[1]) for k in fresh]
            parts = F.array(*[F.struct(F.lit(s).alias("slot"), F.col("label").alias("label"),
                                       F.filter("ids", _below(v.size)).alias("fids")) for s, v in enumerate(vocabs)])
            of = lambda place: {s: k[place] for s, k in enumerate(fresh)}
            fits = train_weights_batched(self.labelled.select(F.explode(parts).alias("x")).select("x.*"),
                                         {s: v.size for s, v in enumerate(vocabs)}, of(2), of(3), of(4))
            positives, negatives, unlabelled = self.totals
            for s, (key, vocab) in enumerate(zip(fresh, vocabs, strict=True)):
                info = RoundInfo(1, positives, negatives, unlabelled, vocab.size, fits[s].epochs,
                                 fits[s].l1[-1] if fits[s].l1 else None, None)
                self.done[key] = FirstRound(Model(vocab, fits[s].weights), info, unlabelled)
        return self.done

    def release(self) -> None:
        release(self.labelled.sparkSession, self.path)


def _labs(slot: int):
    return F.element_at(F.col("labs"), slot + 1)


def _group_counts(state: DataFrame, slots: list) -> DataFrame:
    """(ngram, rows, pos_s and neg_s of every slot s): class counts of all configurations at once.

    A row's N-grams are exploded once, whatever the number of configurations;
    one aggregate holds a pair of counts for each. The NULL N-gram stands for
    every row, so its counts are the totals.
    """
    none = F.array(F.lit(None).cast("string"))
    known = reduce(lambda x, y: x | y, [_labs(s) != 0 for s in slots])
    keys = F.when(known, F.concat(F.array_distinct("ng"), none)).otherwise(none)
    counts = [F.count_if(_labs(s) == label).alias(f"{name}_{s}") for s in slots for name, label in (("pos", 1), ("neg", -1))]
    return (state.select("labs", F.explode(keys).alias("ngram")).groupBy("ngram")
            .agg(F.count(F.lit(1)).alias("rows"), *counts))


def _slot_totals(counts: DataFrame, slots: list) -> dict:
    """slot -> (positives, negatives, unlabelled), from the NULL N-gram's row."""
    row = counts.where(F.col("ngram").isNull()).first()
    if row is None:
        return {s: (0, 0, 0) for s in slots}
    return {s: (row[f"pos_{s}"], row[f"neg_{s}"], row["rows"] - row[f"pos_{s}"] - row[f"neg_{s}"]) for s in slots}


def _slot_vocabularies(counts: DataFrame, totals: dict, sizes: dict, n: int) -> dict:
    """Every active slot's top-m vocabulary, collected in one job.

    Each slot is its own bounded top-m (``TakeOrderedAndProject``) over its two
    columns of the counts; the union only saves one driver round trip per configuration.
    """
    parts = []
    for s, m in sizes.items():
        p, q, _ = totals[s]
        own = counts.select("ngram", F.col(f"pos_{s}").alias("pos"), F.col(f"neg_{s}").alias("neg"))
        # An N-gram that only other configurations have labelled rows of isn't this one's.
        ranked = rank_vocab(own.where("ngram IS NOT NULL AND pos + neg > 0"), p, q, m)
        parts.append(ranked.select(F.lit(s).alias("slot"), "ngram", "fid", F.xxhash64("ngram").alias("_h")))
    rows = reduce(DataFrame.unionByName, parts).collect()
    out = {}
    for s in sizes:
        mine = sorted((r for r in rows if r["slot"] == s), key=lambda r: r["fid"])
        out[s] = Vocabulary(n, tuple(r["ngram"] for r in mine),
                            build_lookup([(r["ngram"], r["fid"], r["_h"]) for r in mine]))
    return out


def _chained_labs(width: int, segment: dict, thresholds: dict):
    """Each slot's label after its segment models (first non-zero wins)."""
    return F.array(*[label_chain(_labs(s), F.col("ng"), segment.get(s, []), thresholds[s])
                     for s in range(width)])


def _test_accuracy(test: DataFrame, n: int, models: dict) -> dict:
    """Held-out accuracy of every slot's final model, in one job."""
    slots = sorted(models)
    rows = tokenized(test, n, keep=("sent_id", "label"))
    scores = F.array(*[F.struct(F.lit(s).alias("slot"), model_score(F.col("ng"), models[s]).alias("score"))
                       for s in slots])
    per_slot = rows.select("label", F.explode(scores).alias("x")).select("label", "x.slot", "x.score")
    right = F.when(F.col("score") * F.col("label") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    got = {r.slot: r.accuracy for r in per_slot.groupBy("slot").agg(F.avg(right).alias("accuracy")).collect()}
    return {s: got.get(s) for s in slots}


def _held(base: DataFrame, small: bool) -> DataFrame:
    """A segment base's (labs, ng); cached over the cores when the input is small."""
    rows = base.select("labs", "ng")
    return spread_small(rows).persist(StorageLevel.MEMORY_AND_DISK) if small else rows


def _run_group(tokens: DataFrame, test: DataFrame, n: int, group: list, firsts: dict,
               max_rounds: int | None, checkpoint_every: int, small: bool) -> dict:
    """Self-train every configuration of one N together; returns slot -> (acc, rounds).

    The segment base is (sent_id, ng, labs) with one label per slot, no round reads the text; the
    models of the current segment are applied in-row as per-slot chains, and
    folded into a new Parquet base every ``checkpoint_every`` rounds.
    """
    width = len(group)
    thresholds = {s: c.threshold for s, c in enumerate(group)}
    base = tokens.select("sent_id", "ng", F.array_repeat(F.col("label"), width).alias("labs"))
    firsts_by_slot = {s: firsts[_key(c)] for s, c in enumerate(group)}
    models = {s: [firsts_by_slot[s].model] for s in range(width)}
    segment = {s: [firsts_by_slot[s].model] for s in range(width)}
    previous = {s: firsts_by_slot[s].unlabelled for s in range(width)}
    active = list(range(width))
    rounds_in_segment = 1
    base_path = None
    rows = _held(base, small)
    while active:
        # Stopped slots are never read again within the round; only the
        # active ones pay for their chains (the fold below applies all).
        staged = rows.withColumn("labs", _chained_labs(width, {s: segment[s] for s in active}, thresholds))
        counts = _group_counts(staged, active).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            totals = _slot_totals(counts, active)
            still = []
            for s in active:
                unlabelled = totals[s][2]
                stop = unlabelled == 0 or unlabelled == previous[s]
                if max_rounds is not None and len(models[s]) >= max_rounds:
                    stop = True
                if not stop:
                    still.append(s)
                    previous[s] = unlabelled
            active = still
            if not active:
                break
            vocabs = _slot_vocabularies(counts, totals, {s: group[s].m for s in active}, n)
        finally:
            counts.unpersist()
        parts = F.array(*[F.struct(F.lit(s).alias("slot"), _labs(s).alias("label"),
                                   F.when(_labs(s) != 0, feature_ids(F.col("ng"), vocabs[s])).alias("fids"))
                          for s in active])
        feats = staged.select(F.explode(parts).alias("x")).select("x.*").where(F.col("label") != 0)
        fits = train_weights_batched(
            feats, {s: vocabs[s].size for s in active}, {s: group[s].num_iter for s in active},
            {s: group[s].alpha for s in active}, {s: group[s].delta for s in active})
        for s in active:
            model = Model(vocabs[s], fits[s].weights)
            models[s].append(model)
            segment[s].append(model)
        rounds_in_segment += 1
        if checkpoint_every and rounds_in_segment >= checkpoint_every:
            folded = base.withColumn("labs", _chained_labs(width, segment, thresholds))
            previous_path = base_path
            base, base_path = materialize_at(folded, "search-state")
            release(base.sparkSession, previous_path)  # the new base no longer reads it
            segment = {s: [] for s in range(width)}
            rounds_in_segment = 0
            rows.unpersist()
            rows = _held(base, small)
    rows.unpersist()
    release(tokens.sparkSession, base_path)
    final = {s: models[s][-1] for s in range(width)}
    accuracy = _test_accuracy(test, n, final) if test is not None else {s: None for s in final}
    return {s: (accuracy[s], len(models[s])) for s in range(width)}


def search(train: DataFrame, test: DataFrame, n=(1, 1, 1), m=(400, 400, 100),
           num_iter=(100, 100, 100), threshold=(0.5, 0.5, 0.1), alpha=(0.002, 0.002, 0.002),
           delta=(0.05, 0.05, 0.05), max_rounds: int | None = None,
           checkpoint_every: int = CHECKPOINT_EVERY,
           max_lookup_keys: int = MAX_LOOKUP_KEYS, chunk: int | None = CHUNK) -> DataFrame:
    """(config_id, n, m, num_iter, threshold, alpha, delta, accuracy, rounds).

    Configurations with the same N advance together in chunks of at most
    ``chunk``: one class-count aggregation and one job per training epoch serve every
    configuration of a chunk that still runs, and the ranking and first rounds are shared
    between chunks. The result doesn't depend on the chunks. ``max_rounds`` is an optional safety limit per
    configuration (off by default: every configuration runs to convergence).
    """
    spark = train.sparkSession
    everything = grid_configs(n=n, m=m, num_iter=num_iter, threshold=threshold, alpha=alpha, delta=delta)
    # Configurations whose vocabulary exceeds the in-row lookup bound run one
    # by one in self-training's join form; the rest advance together.
    configs = [c for c in everything if c.m <= max_lookup_keys]
    train, small = _prepare(train)
    rows = []
    for c in everything:
        if c.m > max_lookup_keys:
            result = self_train(train, test, n=c.n, m=c.m, n_iter=c.num_iter, threshold=c.threshold,
                                alpha=c.alpha, delta=c.delta, max_rounds=max_rounds, prepared=True,
                                max_lookup_keys=max_lookup_keys)
            rows.append(_outcome(c, result.test_accuracy, len(result.models)))
    for n_value in sorted({c.n for c in configs}):
        group = [c for c in configs if c.n == n_value]
        # Text is tokenized once for every N; rounds and fold-ins read the tokens.
        tokens, tokens_path = materialize_at(tokenized(train, n_value, keep=("sent_id", "label")), "search-tokens")
        first = SharedFirstRound(tokens, n_value, max(c.m for c in group))
        try:
            for part in chunked(group, chunk, max_lookup_keys):
                # A segment chains a model per round and configuration: fold so often that it stays within the bound.
                every = max(1, min(checkpoint_every or max_lookup_keys, max_lookup_keys // sum(c.m for c in part)))
                outcome = _run_group(tokens, test, n_value, part, first.models(part), max_rounds, every, small)
                rows += [_outcome(c, *outcome[s]) for s, c in enumerate(part)]
        finally:
            first.release()
            release(spark, tokens_path)
    if small:
        train.unpersist()
    rows.sort(key=lambda r: r[0])
    return spark.createDataFrame(rows, "config_id int, n int, m int, num_iter int, threshold double, "
                                       "alpha double, delta double, accuracy double, rounds int")


def _outcome(c: Config, accuracy: float | None, rounds: int) -> tuple:
    return (c.config_id, c.n, c.m, c.num_iter, c.threshold, c.alpha, c.delta,
            None if accuracy is None else round(float(accuracy), 9), rounds)


def best_config(results: DataFrame) -> DataFrame:
    """The first configuration (loop order) with the highest accuracy.

    When no accuracy is positive this is configuration 0, the start values,
    as in the reference's strict-greater update.
    """
    ranked = results.withColumn("_key", F.when(F.col("accuracy") > 0, F.col("accuracy")).otherwise(F.lit(0.0)))
    return ranked.orderBy(F.col("_key").desc(), F.col("config_id")).limit(1).drop("_key")
