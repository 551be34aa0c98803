"""Full-batch logistic training.

Weights start at zero. Each epoch is one Spark job over columnar blocks of the
labelled rows (:mod:`sprout.operators.blocks`): score every row against the
current weights and sum ``(y - p) * alpha`` per feature id. Weights go out and
sums come back as arrays, so an epoch's cost in the driver does not grow with
text or Python rows per feature. Training stops after ``n_iter`` epochs, or right
after the first step whose L1 size is below ``delta``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import gradients, pack_blocks, right_answers
from ..operators.features import featurize
from ..operators.scoring import Model
from ..operators.vocab import Vocabulary
from ..sources.fixtures import materialize_at, release


# Bytes of training rows per task, at most, and the bytes worth a task of their own
# while cores are free (8 bytes per distinct id of a row, at most, and 5 per row).
BYTES_PER_TASK = 128 * 1024 * 1024
BYTES_WORTH_A_TASK = 4 * 1024 * 1024


@dataclass
class TrainResult:
    weights: np.ndarray
    epochs: int = 0
    l1: list = field(default_factory=list)
    train_accuracy: float | None = None


@dataclass
class EpochInput:
    """Blocks of the training rows, cached in a session of the loop's own."""

    blocks: DataFrame
    tasks: int
    path: str

    def release(self) -> None:
        self.blocks.unpersist()
        release(self.blocks.sparkSession, self.path)


def stage_epoch_input(feats: DataFrame) -> EpochInput:
    """Reliable, cached copy of the training rows (slot, label, fids) as blocks, sized by volume.

    One job counts rows and ids; the rows are spread over the cores, in
    tasks of BYTES_WORTH_A_TASK to BYTES_PER_TASK, packed into blocks,
    written as Parquet under the checkpoint folder and cached. Epoch plans
    then start from a small leaf (cheap to plan every epoch), read memory, and
    a lost cache block is reloaded from the files rather than recomputed from
    text. The caller releases the copy.
    """
    staged = feats.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        row = staged.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("fids")).alias("ids")).first()
        volume = 5 * int(row["rows"] or 0) + 8 * int(row["ids"] or 0)
        cores = feats.sparkSession.sparkContext.defaultParallelism
        tasks = max(1, math.ceil(volume / BYTES_PER_TASK), min(cores, math.ceil(volume / BYTES_WORTH_A_TASK)))
        _, path = materialize_at(pack_blocks(staged.repartition(tasks) if tasks > 1 else staged.coalesce(1)), "epoch-input")
    finally:
        staged.unpersist()
    # The loop has a session of its own: its settings touch no other query.
    loop = feats.sparkSession.newSession()
    loop.conf.set("spark.sql.adaptive.enabled", "false")
    loop.conf.set("spark.sql.files.openCostInBytes", str(BYTES_PER_TASK))  # one split per file
    return EpochInput(loop.read.parquet(path).persist(StorageLevel.MEMORY_AND_DISK), tasks, path)


def train_weights(feats: DataFrame, size: int, n_iter: int, alpha: float, delta: float,
                  label: str = "label", measure: bool = False) -> TrainResult:
    """Train on ``feats`` (label, fids); labels 0 are ignored."""
    rows = feats.select(F.lit(0).alias("slot"), F.col(label).alias("label"), "fids")
    return train_weights_batched(rows, {0: size}, {0: int(n_iter)}, {0: alpha}, {0: delta}, measure)[0]


def train_model(labelled: DataFrame, vocab: Vocabulary, n_iter: int, alpha: float,
                delta: float) -> tuple[Model, TrainResult]:
    """Featurize the labelled rows of ``labelled`` and train a model."""
    feats = featurize(labelled.where(F.col("label") != 0), vocab)
    result = train_weights(feats, vocab.size, n_iter, alpha, delta)
    return Model(vocab, result.weights), result


def train_weights_batched(feats: DataFrame, sizes: dict, n_iter: dict, alpha: dict,
                          delta: dict, measure: bool = False) -> dict:
    """Train several independent models in one job per epoch.

    ``feats`` has (slot, label, fids); every dict is keyed by slot (0-based,
    small: one entry per configuration). Each slot follows exactly the
    single-model trajectory and drops out of the passes once it stops, so an
    epoch costs one job for all slots. With ``measure`` (one slot only) the
    accuracy of the final weights on the training rows is taken as well.
    """
    slots = sorted(sizes)
    results = {s: TrainResult(np.zeros(sizes[s])) for s in slots}
    active = [s for s in slots if n_iter[s] > 0]
    data = stage_epoch_input(feats.where(F.col("label") != 0).select("slot", "label", "fids"))
    try:
        running, blocks = list(active), data.blocks
        while active:
            if active != running:  # rows of stopped slots aren't read any more
                running, blocks = list(active), data.blocks.where(F.col("slot").isin(active))
            steps = gradients(blocks, data.tasks, {s: results[s].weights for s in active},
                              {s: float(alpha[s]) for s in active})
            for s in running:
                fit, l1 = results[s], float(np.abs(steps[s]).sum())
                fit.weights = fit.weights + steps[s]
                fit.epochs += 1
                fit.l1.append(l1)
                if l1 < delta[s] or fit.epochs >= n_iter[s]:
                    active.remove(s)
        if measure:
            right, n = right_answers(data.blocks, results[0].weights)
            results[0].train_accuracy = right / n if n else None
    finally:
        data.release()
    return results
