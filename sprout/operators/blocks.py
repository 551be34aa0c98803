"""Columnar training rows: CSR blocks and one gradient pass over them.

A block holds the rows of one slot (one training among several that run
together) as four arrays: targets, row ends, feature ids and their counts.
A pass sends the weight vectors to the tasks as arrays, adds up each task's
gradient in one vector per slot and returns it in chunks of ``CHUNK`` sums. With
several tasks the chunks are shuffled and added before they reach the driver, so
the driver receives each sum once, as bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_IDS = 1 << 19  # ids of a block, unless one row has more
CHUNK = 1 << 16  # gradient sums that travel together
# Partial sums below this many bytes, over all tasks, are added on the driver.
DIRECT_BYTES = 4 << 20

BLOCKS = "slot int, rows int, targets binary, ends binary, fids binary, cnts binary"
_BLOCK_SCHEMA = pa.schema([("slot", pa.int32()), ("rows", pa.int32()), *(
    (c, pa.binary()) for c in ("targets", "ends", "fids", "cnts"))])
SUMS = "slot int, chunk int, sums binary"
_SUM_SCHEMA = pa.schema([("slot", pa.int32()), ("chunk", pa.int32()), ("sums", pa.binary())])


def counted(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row ends, distinct ids, counts) of rows given one after the other with ``sizes`` ids each."""
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    width = int(ids.max()) + 1 if len(ids) else 1
    keys, cnts = np.unique(row * width + ids, return_counts=True)
    ends = np.searchsorted(keys // width, np.arange(len(sizes)), side="right")
    return ends.astype("<i4"), (keys % width).astype("<i4"), cnts.astype("<i4")


def pack_blocks(feats: DataFrame) -> DataFrame:
    """Blocks of labelled rows (slot, label, fids)."""

    def block(slot, labels, ids, sizes):
        ends, fids, cnts = counted(ids, sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array([slot], pa.int32()), pa.array([len(sizes)], pa.int32()),
             *(pa.array([a.tobytes()], pa.binary()) for a in (np.sign(labels).astype("i1"), ends, fids, cnts))],
            schema=_BLOCK_SCHEMA)

    def run(batches):
        for batch in batches:
            slots, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            ids, sizes = lists.flatten().to_numpy().astype(np.int64), np.diff(offsets)
            for slot in np.unique(slots):
                own = np.flatnonzero(slots == slot)
                share = np.cumsum(sizes[own]) // BLOCK_IDS
                for part in np.split(own, np.flatnonzero(np.diff(share)) + 1):
                    held = [ids[offsets[r]:offsets[r + 1]] for r in part]
                    yield block(int(slot), labels[part], np.concatenate(held), sizes[part])

    return feats.select(F.col("slot").cast("int"), F.col("label").cast("int"),
                        F.coalesce("fids", F.array().cast("array<int>")).alias("fids")).mapInArrow(run, BLOCKS)


def _scores(block: tuple, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """(labels, scores, row of each entry, feature ids, counts) of one block."""
    targets, ends, fids, cnts = (np.frombuffer(b.as_buffer(), kind) for b, kind in
                                 zip(block, ("i1", "<i4", "<i4", "<i4"), strict=True))
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return targets, np.bincount(row, weights[fids] * cnts, len(ends)), row, fids, cnts


def gradient_sums(blocks: DataFrame, weights: dict[int, np.ndarray], alphas: dict[int, float]) -> DataFrame:
    """(slot, chunk, sums): per task, sums of (y - p) * alpha over the occurrences of each feature."""

    def run(batches):
        total = {s: np.zeros(len(w)) for s, w in weights.items()}
        for batch in batches:
            for slot, *block in zip(batch.column(0).to_pylist(), *batch.columns[2:], strict=True):
                if slot not in total:
                    continue
                labels, scores, row, fids, cnts = _scores(block, weights[slot])
                with np.errstate(over="ignore"):
                    step = ((labels > 0) - 1.0 / (1.0 + np.exp(-scores))) * alphas[slot]
                total[slot] += np.bincount(fids, step[row] * cnts, len(total[slot]))
        yield from chunks(total)

    return blocks.mapInArrow(run, SUMS)


def chunks(total: dict[int, np.ndarray]):
    """Vectors cut into rows of :data:`SUMS`, chunks of zeros left out."""
    rows = [(s, k, part.astype("<f8").tobytes()) for s, vector in sorted(total.items())
            for k in range(-(-len(vector) // CHUNK)) if (part := vector[k * CHUNK:(k + 1) * CHUNK]).any()]
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _SUM_SCHEMA, strict=True)], schema=_SUM_SCHEMA)


def merged(partial: DataFrame, tasks: int) -> DataFrame:
    """Chunks added up over the tasks, each chunk in one task."""

    def run(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for slot, chunk, sums in zip(*batch.to_pydict().values(), strict=True):
                more = np.frombuffer(sums, "<f8")
                total[slot, chunk] = total[slot, chunk] + more if (slot, chunk) in total else more
        rows = [(s, k, v.tobytes()) for (s, k), v in sorted(total.items())]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SUM_SCHEMA, strict=True)], schema=_SUM_SCHEMA)

    return partial.repartition(tasks, "slot", "chunk").mapInArrow(run, SUMS)


def gradients(blocks: DataFrame, tasks: int, weights: dict[int, np.ndarray],
              alphas: dict[int, float]) -> dict[int, np.ndarray]:
    """One pass: the gradient step of every slot in ``weights`` (bounded by the models' sizes)."""
    size = sum(len(w) for w in weights.values())
    sums = gradient_sums(blocks, weights, alphas)
    if tasks > 1 and 8 * size * tasks > DIRECT_BYTES:
        sums = merged(sums, max(1, min(tasks, -(-size // CHUNK))))
    out = {s: np.zeros(len(w)) for s, w in weights.items()}
    for slot, chunk, data in sums.collect():
        part = np.frombuffer(data, "<f8")
        out[slot][chunk * CHUNK:chunk * CHUNK + len(part)] += part
    return out


def right_answers(blocks: DataFrame, weights: np.ndarray) -> tuple[int, int]:
    """(right, rows): rows of slot 0 whose score has the sign of their label."""

    def run(batches):
        right = rows = 0
        for batch in batches:
            for block in zip(*batch.columns[2:], strict=True):
                labels, scores, *_ = _scores(block, weights)
                right, rows = right + int((scores * labels > 0).sum()), rows + len(labels)
        yield pa.RecordBatch.from_pydict({"right": [right], "n": [rows]})

    row = blocks.mapInArrow(run, "right long, n long").agg(F.sum("right"), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)
