"""Vector codes: product quantisation with anchors-hierarchy metric trees.

Vectors become whole numbers, are cut into equal consecutive parts, and every
part position gets a codebook by a fixed number of assign-and-average rounds.

Trees. Each task takes its vectors in blocks of at most ``BLOCK`` and builds, per block
and part, a metric tree from the middle out: about sqrt(n) anchors are placed
farthest first, each stealing the points nearer to it (points within half the
distance between two anchors are never asked); anchors are then merged
upwards, closest balls first, and each is divided downwards in the same way
until a ball has at most ``LEAF`` points. Every ball caches the number and
the sum of its points. Trees are written once and read in every round.

Rounds. The root starts with all codebook entries as candidates. A ball inherits
its parent's list and drops each entry that is farther than the ball's nearest
entry for every point of the ball: the ball lies on the nearest entry's side of the
plane between the two. If one is left, the ball is wholly owned and its cached sum
and count are added without looking at a point; a leaf with several compares its
points with those on its list. The tests keep a margin above rounding, so a tie is
never decided by them; comparisons are exact in whole numbers.

What a round brings to the driver is one sum and count per codebook entry
and component, a size set by the codebook and not by the rows.

Defined cases: rows whose vector is NULL or holds a NULL or non-finite component
are dropped; a NULL id sorts last among the first codebook entries, equal ids in order of their
vectors; fewer rows than entries give a shorter codebook; vectors shorter than the
longest, or a length that the parts don't divide, are filled up with zeros;
NULL labels are one label; repeated rows keep a row each; scaled components beyond
2^62 count as 2^62 and errors beyond 2^63 - 1 as that; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_schema, small

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 4096  # vectors of a tree
LEAF = 24  # points of a ball that is not divided
MOST, TOP = 1 << 62, (1 << 63) - 1


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x) of every component, ``width`` columns, short vectors filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        values = flat.reshape(-1, width)
    else:
        values = np.zeros((len(sizes), width))
        values[np.arange(width) < sizes[:, None]] = flat
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * values), -MOST, MOST).astype(np.int64)


def narrowed(values: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if values.size == 0 or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


def exact(points: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both arrays in the fastest number type in which their squared distances are exact."""
    top = max((int(abs(int(x))) for a in (points, others) if a.size for x in (a.min(), a.max())), default=0)
    bound = points.shape[1] * (2 * top) ** 2
    kind = np.float64 if bound < 1 << 52 else np.int64 if bound < 1 << 62 else object
    return points.astype(kind), others.astype(kind)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries."""
    p, e = exact(points, entries)
    if p.dtype == np.float64:
        return (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)
    return np.stack([((p - row) ** 2).sum(1) for row in e], axis=1)


def errors(points: np.ndarray, chosen: np.ndarray) -> list[int]:
    """Exact squared distance of each point to the entry in the same row."""
    p, c = exact(points, chosen)
    return [int(x) for x in ((p - c) ** 2).sum(1)]


class Tree:
    """Balls over ``points``, parents before children; each holds the places [lo, hi) of ``order``."""

    FIELDS = ("points", "order", "lo", "hi", "parent", "leaf", "radius", "sums")

    def __init__(self, **fields: np.ndarray) -> None:
        self.__dict__.update(fields)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data), allow_pickle=False) as held:
            return cls(**{f: held[f] for f in cls.FIELDS})


def anchors(points: np.ndarray) -> list[np.ndarray]:
    """Places of ``points`` by anchor: about sqrt(n) anchors, farthest first; one if all points are equal."""
    n = len(points)
    owner = np.zeros(n, np.int64)
    apart = np.sqrt(((points - points[0]) ** 2).sum(1))
    pivots = [0]
    while len(pivots) < math.isqrt(n - 1) + 1:
        far = int(apart.argmax())
        if apart[far] == 0:
            break
        between = np.sqrt(((points[pivots] - points[far]) ** 2).sum(1))
        # A point nearer to its anchor than half the way to the new one can't be nearer to the new one.
        asked = np.flatnonzero(apart > between[owner] / 2)
        new = np.sqrt(((points[asked] - points[far]) ** 2).sum(1))
        stolen = new < apart[asked]
        owner[asked[stolen]], apart[asked[stolen]] = len(pivots), new[stolen]
        pivots.append(far)
    order = np.argsort(owner, kind="stable")
    return [g for g in np.split(order, np.searchsorted(owner[order], np.arange(1, len(pivots)))) if len(g)]


def merged(points: np.ndarray, groups: list[np.ndarray], divide) -> tuple:
    """Nested pairs over the anchors' groups, closest balls first; ``divide`` makes a group's own subtree."""
    nodes = [divide(g) for g in groups]
    count = np.array([len(g) for g in groups], float)
    center = np.stack([points[g].mean(0) for g in groups])
    radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(1)).max() for g, c in zip(groups, center, strict=True)])

    def reach(k):  # radius of a ball around ball k and each other one
        return (np.sqrt(((center - center[k]) ** 2).sum(1)) + radius + radius[k]) / 2

    cost = np.stack([reach(k) for k in range(len(nodes))])
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(nodes) - 1):
        i, j = np.unravel_index(int(cost.argmin()), cost.shape)
        nodes[i] = (nodes[i], nodes[j])
        radius[i] = cost[i, j]
        center[i] = (center[i] * count[i] + center[j] * count[j]) / (count[i] + count[j])
        count[i] += count[j]
        cost[j, :] = cost[:, j] = np.inf
        gone = np.isinf(cost[i]) & np.isinf(cost[:, i])
        new = reach(i)
        new[gone] = np.inf
        new[i] = np.inf
        cost[i, :] = cost[:, i] = new
    return nodes[int(count.argmax())] if len(nodes) > 1 else nodes[0]


def build(values: np.ndarray) -> Tree:
    """The tree of one block's part; ``values`` are whole numbers."""
    points = values.astype(np.float64)

    def divide(places: np.ndarray):
        if len(places) <= LEAF:
            return places
        groups = [places[g] for g in anchors(points[places])]
        return places if len(groups) == 1 else merged(points, groups, divide)

    order, lo, hi, parent, leaf = [], [], [], [], []
    at, waiting = 0, [(divide(np.arange(len(points))), -1)]
    while waiting:  # depth first, so a ball's points stand together
        node, above = waiting.pop()
        if node is None:  # both children of a ball are done
            hi[above] = at
            continue
        lo.append(at)
        hi.append(at)
        parent.append(above)
        leaf.append(not isinstance(node, tuple))
        here = len(lo) - 1
        if leaf[-1]:
            order.append(node)
            at += len(node)
            hi[here] = at
        else:
            waiting += [(None, here), (node[1], here), (node[0], here)]
    order = np.concatenate(order)
    lo, hi = np.array(lo), np.array(hi)
    placed, standing = points[order], values[order]
    sums = np.stack([exact_sum(standing[a:b]) for a, b in zip(lo, hi, strict=True)])
    radius = np.zeros(len(lo))
    for k, (a, b) in enumerate(zip(lo, hi, strict=True)):
        center = sums[k].astype(float) / (b - a)
        radius[k] = np.sqrt(((placed[a:b] - center) ** 2).sum(1).max())
    if sums.dtype == object:  # beyond a long: not cached, added up when asked for
        sums = np.zeros((0, values.shape[1]), np.int64)
    return Tree(points=narrowed(standing), order=order.astype(np.int32), lo=lo.astype(np.int32), hi=hi.astype(np.int32),
                parent=np.array(parent, np.int32), leaf=np.array(leaf), radius=radius, sums=narrowed(sums))


def exact_sum(values: np.ndarray) -> np.ndarray:
    """Sum over rows; whole numbers of any size where a long could overflow."""
    top = max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0
    kind = np.int64 if top * max(1, len(values)) < MOST else object
    return values.astype(kind).sum(axis=0)


def ball_sums(tree: Tree, k: int) -> np.ndarray:
    if len(tree.sums):
        return tree.sums[k].astype(np.int64)
    return exact_sum(tree.points[tree.lo[k]:tree.hi[k]].astype(np.int64))


def assign(tree: Tree, entries: np.ndarray):
    """Yield (entry, ball, None) for wholly owned balls and (None, ball, entry of each point) for leaves."""
    count = (tree.hi - tree.lo).astype(float)
    points, book = exact(tree.points.astype(np.int64), entries)
    norms = (book * book).sum(axis=1)
    sums = tree.sums.astype(float) if len(tree.sums) else np.stack(
        [ball_sums(tree, k).astype(float) for k in range(len(tree.lo))])
    center, near = sums / count[:, None], entries.astype(float)
    between = np.sqrt(squared(entries, entries).astype(float))
    scale = (center * center).sum(axis=1) + (near * near).sum(axis=1).max()
    to = (center * center).sum(axis=1)[:, None] + (near * near).sum(axis=1) - 2 * (center @ near.T)
    _, first = np.unique(entries, axis=0, return_index=True)  # of equal entries only the first is ever nearest
    candidates = np.zeros((len(tree.lo), len(entries)), bool)
    depth = np.zeros(len(tree.lo), np.int64)
    for k in range(1, len(depth)):
        depth[k] = depth[tree.parent[k]] + 1
    undecided = np.zeros(len(depth), bool)
    for level in range(int(depth.max()) + 1):
        balls = np.flatnonzero(depth == level)
        if level == 0:
            candidates[np.ix_(balls, first)] = True
        else:
            balls = balls[undecided[tree.parent[balls]]]
            candidates[balls] = candidates[tree.parent[balls]]
        if not len(balls):
            break
        own = np.where(candidates[balls], to[balls], np.inf)
        best = own.argmin(axis=1)
        lead = own - own[np.arange(len(balls)), best][:, None]
        side = 2 * tree.radius[balls, None] * between[best]
        # Kept unless farther for every point of the ball, by more than rounding could hide.
        candidates[balls] &= lead <= side * (1 + 1e-9) + 1e-9 * scale[balls, None]
        alone = candidates[balls].sum(axis=1) == 1
        for k, entry in zip(balls[alone].tolist(), best[alone].tolist(), strict=True):
            yield entry, k, None
        several = balls[~alone]
        undecided[several[~tree.leaf[several]]] = True
        for k in several[tree.leaf[several]].tolist():
            listed = np.flatnonzero(candidates[k])
            here = points[tree.lo[k]:tree.hi[k]]
            if book.dtype == np.float64:  # without the points' own norms, which are the same for all entries
                apart = norms[listed] - 2 * (here @ book[listed].T)
            else:
                apart = squared(here, entries[listed])
            yield None, k, listed[apart.argmin(axis=1)]  # the first of equals


def tree_blocks(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """(vec_id array, label array, trees array<binary>): one row per block."""
    types = [kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    ddl = f"vec_id array<{types[0]}>, label array<{types[1]}>, trees array<binary>"
    schema = arrow_schema(ddl)

    def run(batches):
        def block(ids, labels, values):
            cut = np.split(values, parts, axis=1)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], schema.field(0).type), pa.array([labels], schema.field(1).type),
                 pa.array([[build(part).dump() for part in cut]], schema.field(2).type)], schema=schema)

        ids, labels, values = [], [], np.zeros((0, width), np.int64)
        for batch in batches:
            ids += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            values = np.concatenate([values, whole_numbers(batch.column(2), width)])
            while len(ids) >= BLOCK:
                yield block(ids[:BLOCK], labels[:BLOCK], values[:BLOCK])
                ids, labels, values = ids[BLOCK:], labels[BLOCK:], values[BLOCK:]
        if ids:
            yield block(ids, labels, values)

    return kept.mapInArrow(run, ddl)


def entry_sums(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, place, n, total): count and component sums of what each entry owns."""
    ddl = "part int, entry int, place int, n long, total decimal(38,0)"
    schema = arrow_schema(ddl)

    def run(batches):
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for trees in batch.column(0):
                for part, data in enumerate(trees):
                    tree, book = Tree.load(data.as_py()), books[part]
                    for entry, k, each in assign(tree, book):
                        lo, hi = tree.lo[k], tree.hi[k]
                        if each is None:
                            counts[part][entry] += hi - lo
                            totals[part][entry] += ball_sums(tree, k).astype(object)
                            continue
                        points = tree.points[lo:hi].astype(np.int64)
                        for e in np.unique(each):
                            counts[part][e] += int((each == e).sum())
                            totals[part][e] += exact_sum(points[each == e]).astype(object)
        for part, (n, total) in enumerate(zip(counts, totals, strict=True)):
            used = np.flatnonzero(n)
            wide = total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used) * wide, part), pa.int32()), pa.array(np.repeat(used, wide), pa.int32()),
                 pa.array(np.tile(np.arange(wide), len(used)), pa.int32()), pa.array(np.repeat(n[used], wide), pa.int64()),
                 pa.array([Decimal(int(x)) for x in total[used].reshape(-1)], schema.field(4).type)], schema=schema)

    return (blocks.select("trees").mapInArrow(run, ddl).groupBy("part", "entry", "place")
            .agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")))


def averaged(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one round: each used entry becomes the floor of its parts' mean."""
    new = [b.copy() for b in books]
    for row in entry_sums(blocks, books).collect():  # entries times components, whatever the rows
        new[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return new


def codes(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error): final codes and squared distances."""
    types = [blocks.schema[c].dataType.elementType.simpleString() for c in ("vec_id", "label")]
    ddl = f"vec_id {types[0]}, label {types[1]}, code string, error long"
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            for ids, labels, trees in zip(*batch.columns, strict=True):
                chosen = np.zeros((len(ids), len(books)), np.uint8)
                error = [0] * len(ids)
                for part, data in enumerate(trees):
                    tree, book = Tree.load(data.as_py()), books[part]
                    own = np.zeros(len(tree.order), np.int64)
                    for entry, k, each in assign(tree, book):
                        own[tree.lo[k]:tree.hi[k]] = entry if each is None else each
                    chosen[tree.order, part] = own
                    for row, far in zip(tree.order, errors(tree.points.astype(np.int64), book[own]), strict=True):
                        error[row] += far
                text, wide = chosen.tobytes().hex(), 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([text[k * wide:(k + 1) * wide] for k in range(len(ids))]),
                     pa.array([min(e, TOP) for e in error], pa.int64())], schema=schema)

    return blocks.mapInArrow(run, ddl)


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per kept vector; at most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    sound = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = (vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v"))
            .where(F.col("v").isNotNull()).where(sound))
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).toArrow()
    seeds = whole_numbers(first["v"].combine_chunks(), width) if len(first) else np.zeros((0, width), np.int64)
    books = np.split(seeds, parts, axis=1)

    scratch = Scratch()
    blocks = scratch.store(tree_blocks(kept, width, parts), "vector_trees")
    for _ in range(rounds):
        books = averaged(blocks, books)
    coded = scratch.store(codes(blocks, books), "vector_codes")
    scratch.release(blocks)
    numbers = ",".join(str(int(x)) for book in books for x in book.reshape(-1))
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(TOP).cast("decimal(38,0)")).cast("long")
    labels = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label")
    return (coded.join(small(labels), F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
