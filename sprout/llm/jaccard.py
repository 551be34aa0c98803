"""Exact N-gram Jaccard join with set-relation skipping.

A document's set holds its distinct word shingles. Documents with equal sets
form a class; only classes are joined.

Index. Shingles are ordered from rare to frequent by a counting sketch over
all documents, and a class enters the lists of its first
``n - ceil(t * n) + 1`` shingles: two classes that link meet in the list of their
first common shingle. An entry keeps its position in the class's order and
the class's size, which bound the overlap that is still possible from there.

Pairs are compared in full only if the parities of their shingles, 512 bits
a class, do not already differ in too many places.

Answers from similar sets. In each list the entry with the smallest position leads (a
text that others were derived from has no shingle rarer than theirs). A class is
first compared with the leader it meets in most lists, then with its other leaders, unless
the component it is in by then already holds them. The answers of a similar set come
from the leader's: entries in one component need no comparison with each other, and two
entries whose distances to their leader differ by more than 1 - t can't link, by the
triangle inequality.

Skipping. What remains is searched list by list. Entries stand in order of size, in skip
blocks of ``SKIP`` that keep their best position; a set passes over the blocks whose
sizes it can't link with, or whose best position is too late for it, without looking into
them. Long lists are cut into parts of at most about ``BLOCK`` entries and every pair of parts is
searched on its own, so no list has to fit in one task.

The links found give exact components. ``all_links=True`` keeps comparing
within components, for callers that want every linked pair.

Defined cases: NULL and empty texts have no shingle, size 0, and are linked
with nothing; fewer words than a shingle form one shingle; repeated rows and
ids fall in one class if their sets are equal; an empty table gives an empty
result; extra columns are ignored. Shingles are 64-bit hashes, classes
128-bit hashes of the sorted shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_rows, arrow_schema, frugal, partitions, small, stored, text_or_empty
from .components import components

SHINGLE = 3
PERCENT = 90  # linked if 100 * intersection >= PERCENT * union
PARITY = 512  # bits of a class's parity
SKETCH_BITS = (16, 22)  # counters: eight per document, within these powers of two
CHUNK = 1 << 15
WAITING = 1 << 20  # shingles counted at one time
BLOCK = 256  # entries of a part of a list
ENTRIES = 20_000  # entries searched at one time, and the rest of the last part
SKIP = 16  # entries of a skip block
PROBES = 1 << 14  # pairs of an entry and a skip block looked into at one time
MEMO = 100_000
FILTER_BITS = 27  # a filter of shared shingles has at most 2 ** 27 bits, 16 MB
PER_SHINGLE = 10  # its bits a shingle
PIECE = 16  # it is built in pieces of 2 ** 16 bits

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# ASCII letters to lower case, one byte each; bytes.split() then cuts at exactly
# space and U+0009 to U+000D.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Shingler:
    """Text to the sorted distinct 64-bit hashes of its shingles."""

    def __init__(self, width: int = SHINGLE) -> None:
        import xxhash
        self.width, self.hash, self.memo = width, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: str) -> np.ndarray:
        found = text.encode().translate(_LOWER).split()
        if not found:
            return np.zeros(0, np.uint64)
        if len(found) < self.width:
            return np.array([self.hash(b" ".join(found), seed=len(found))], np.uint64)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in found:
            if w not in memo:
                memo[w] = self.hash(w)
        one = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
        mixed = np.zeros(len(one) - self.width + 1, np.uint64)
        for k in range(self.width):
            mixed = (mixed ^ one[k:k + len(mixed)]) * _A
            mixed ^= mixed >> np.uint64(31)
        mixed *= _B
        return np.unique(mixed ^ (mixed >> np.uint64(29)))


class ShingleFilter:
    """Bloom filter of shingles: their upper bits name a piece, their lower ones three bits in it."""

    def __init__(self, bits: int, field: np.ndarray) -> None:
        self.bits, self.field = bits, field

    @staticmethod
    def places(t: np.ndarray) -> np.ndarray:
        return np.stack([t >> np.uint64(k * PIECE) & np.uint64((1 << PIECE) - 1) for k in range(3)]).astype(np.int64)

    def __call__(self, t: np.ndarray) -> np.ndarray:
        at = ((t >> np.uint64(64 - self.bits + PIECE)).astype(np.int64) << PIECE) + self.places(t)
        return (self.field[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0)


def shingle_filter(shared: DataFrame) -> ShingleFilter | None:
    """Filter of the shingles of ``shared`` (t), or None if it would need more than 2 ** FILTER_BITS bits.

    Every piece is built by one task; the driver gets the finished pieces.
    """
    bits = max(PIECE + 1, math.ceil(math.log2(PER_SHINGLE * max(1, shared.count()))))
    if bits > FILTER_BITS:
        return None

    def build(batches):
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            t = np.sort(batch.column(0).to_numpy().view(np.uint64))  # pieces side by side
            own = (t >> np.uint64(64 - bits + PIECE)).astype(np.int64)
            names, starts = np.unique(own, return_index=True)
            for piece, some in zip(names.tolist(), np.split(t, starts)[1:], strict=True):
                field = pieces.setdefault(piece, np.zeros(1 << PIECE, bool))
                field[ShingleFilter.places(some).ravel()] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(pieces), pa.int64()),
             pa.array([np.packbits(f, bitorder="little").tobytes() for f in pieces.values()], pa.binary())],
            ["piece", "field"])

    named = shared.select("t", F.expr(f"shiftrightunsigned(t, {64 - bits + PIECE})").alias("piece"))
    rows = named.repartition(partitions(shared.sparkSession), "piece").select("t").mapInArrow(
        frugal(build), "piece long, field binary").collect()  # the bounded filter
    field = np.zeros(1 << (bits - 3), np.uint8)
    for piece, part in rows:
        field[piece << (PIECE - 3):(piece + 1) << (PIECE - 3)] = np.frombuffer(part, np.uint8)
    return ShingleFilter(bits, field)


def list_entries(reps: DataFrame, shared: DataFrame) -> DataFrame:
    """(c, n, pos, t): entries of the classes; those of shingles that ``shared`` lacks are left out where its filter shows it.

    Most shingles of a class are its own. The filter drops nearly all of them before
    anything moves; with more shingles than it can hold, all entries move.
    """
    keeps = shingle_filter(shared)
    if keeps is None:
        return reps.select("c", "n", F.posexplode("prefix").alias("pos", "t"))
    sent = reps.sparkSession.sparkContext.broadcast((keeps.bits, keeps.field))
    schema = arrow_schema("c long, n long, pos int, t long")

    def run(batches):
        known = ShingleFilter(*sent.value)
        for batch in batches:
            prefixes = batch.column(2)
            t = prefixes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = prefixes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(t)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = np.flatnonzero(known(t))
            row = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(pos[kept].astype(np.int32)),
                 pa.array(t[kept].view(np.int64))], schema=schema)

    return reps.select("c", "n", "prefix").mapInArrow(frugal(run), "c long, n long, pos int, t long")


def _sum_counts(total: dict[int, np.ndarray], chunk: int, more: np.ndarray) -> None:
    if chunk in total:
        total[chunk] += more
    else:
        total[chunk] = more.astype(np.int64)


def frequency_sketch(texts: DataFrame, width: int = SHINGLE) -> np.ndarray:
    """Shingle counts of all texts, by the upper bits of the hash.

    Each task counts into one array; arrays are summed chunk by chunk. The
    size of the sketch is bounded whatever the corpus. It only orders
    shingles, so a collision costs speed and never a link.
    """
    low, high = SKETCH_BITS
    bits = min(high, max(low, math.ceil(math.log2(8 * max(1, texts.count())))))
    shift, size = np.uint64(64 - bits), 1 << bits

    def count(batches):
        shingles, total, held, waiting = Shingler(width), np.zeros(size, np.int32), [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(shingles(text.as_py()) >> shift)
                waiting += len(held[-1])
                if waiting > WAITING:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=size).astype(np.int32)
                    held, waiting = [], 0
        if held:
            total += np.bincount(np.concatenate(held).astype(np.int64), minlength=size).astype(np.int32)
        parts = [(k, total[k * CHUNK:(k + 1) * CHUNK]) for k in range(size // CHUNK)]
        parts = [(k, p) for k, p in parts if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()),
                                          pa.array([p.tobytes() for _, p in parts], pa.binary())], ["chunk", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, p in zip(*batch.to_pydict().values(), strict=True):
                _sum_counts(total, k, np.frombuffer(p, np.int32))
        most = np.iinfo(np.int32).max
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([np.minimum(p, most).astype(np.int32).tobytes() for p in total.values()], pa.binary())],
            ["chunk", "counts"])

    with arrow_rows(texts.sparkSession):
        rows = (texts.mapInArrow(frugal(count), "chunk int, counts binary").repartition(size // CHUNK, "chunk")
                .mapInArrow(frugal(add), "chunk int, counts binary").collect())  # the bounded sketch
    sketch = np.zeros(size, np.int32)
    for k, p in rows:
        sketch[k * CHUNK:(k + 1) * CHUNK] = np.frombuffer(p, np.int32)
    return sketch


def class_of(shingles: np.ndarray) -> bytes | None:
    import xxhash
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles per bucket, packed into 64-bit words.

    Two sets differ in at least as many shingles as these bits do, so a pair
    with too many different bits is ruled out without its sets.
    """
    odd = np.bincount((shingles >> np.uint64(3)).astype(np.int64) % PARITY, minlength=PARITY).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def document_sets(texts: DataFrame, sketch: np.ndarray, width: int, percent: int) -> DataFrame:
    """(_id..., n, class, bits, prefix): size, class, parity and rarest shingles of every document.

    The last column of ``texts`` is the text, the others are passed through.
    """
    *kept, _ = texts.columns
    ddl = "".join(f"`{c}` {texts.schema[c].dataType.simpleString()}, " for c in kept)
    ddl += "n long, class binary, bits array<long>, prefix array<long>"
    schema = arrow_schema(ddl)
    shared = texts.sparkSession.sparkContext.broadcast(sketch)
    shift = np.uint64(64 - int(math.log2(len(sketch))))

    def run(batches):
        counts, shingles = shared.value, Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, classes, bits, prefixes = [], [], [], []
                for text in part.column(part.num_columns - 1):
                    own = shingles(text.as_py())
                    n = len(own)
                    order = np.argsort(counts[(own >> shift).astype(np.int64)], kind="stable")
                    first = n - -(-percent * n // 100) + 1 if n else 0
                    sizes.append(n)
                    classes.append(class_of(own))
                    bits.append(parity_bits(own))
                    prefixes.append(own[order[:first]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                     pa.array(bits, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64()))], schema=schema)

    return texts.mapInArrow(frugal(run), ddl)


def can_link(percent: int, n1: str, p1: str, n2: str, p2: str):
    """Size and position bounds of a pair that first meets at positions p1, p2."""
    n1, p1, n2, p2 = map(F.col, (n1, p1, n2, p2))
    room = F.least(n1 - p1, n2 - p2)
    return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
            & ((100 + percent) * room >= percent * (n1 + n2)))


def promising(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, spoke) whose parity bits leave room for the overlap they need."""
    bits = small(reps.select("c", "n", "bits"))
    of = lambda name: bits.select(F.col("c").alias(name), F.col("n").alias("n" + name),
                                  F.col("bits").alias("bits" + name))
    both = pairs.join(of("hub"), "hub").join(of("spoke"), "spoke")
    differ = sum((F.bit_count(F.get("bitshub", F.lit(k)).bitwiseXOR(F.get("bitsspoke", F.lit(k))))
                  for k in range(PARITY // 64)), F.lit(0))
    total = F.col("nhub") + F.col("nspoke")
    return both.where((100 + percent) * (total - differ) >= 2 * percent * total).select(*pairs.columns)


def class_sets(rows: DataFrame, reps: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(c, shingles) of the classes ``wanted`` (c), from one document of each."""
    named = small(wanted.distinct().join(small(reps.select("c", "class", "_id")), "c"))
    texts = rows.select("_id", "text").join(named, "_id").select("text", "c", "class")

    def run(batches):
        shingles = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                own = [shingles(t.as_py()) for t in part.column(0)]
                # A repeated id may bring texts of other classes.
                right = [k for k, (s, c) in enumerate(zip(own, part.column(2), strict=True)) if class_of(s) == c.as_py()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(right, pa.int64())),
                     pa.array([own[k].view(np.int64) for k in right], pa.list_(pa.int64()))], ["c", "shingles"])

    return texts.mapInArrow(frugal(run), "c long, shingles array<long>")


def verified(pairs: DataFrame, rows: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """(hub, spoke, common, na, nb, linked): exact overlaps of the pairs.

    A spoke's set moves once, to its hub's; neither is stored.
    """
    spokes = class_sets(rows, reps, pairs.select(F.col("spoke").alias("c")), width)
    spokes = spokes.join(small(pairs), F.col("c") == F.col("spoke")).select("hub", "spoke", F.col("shingles").alias("own"))
    hubs = class_sets(rows, reps, pairs.select(F.col("hub").alias("c")), width)
    both = spokes.join(hubs, F.col("hub") == F.col("c"))
    # A repeated row can bring a class twice, a pair stays one row.
    both = both.select("hub", "spoke", F.size(F.array_intersect("own", "shingles")).alias("common"),
                       F.size("shingles").alias("na"), F.size("own").alias("nb")).dropDuplicates(["hub", "spoke"])
    return both.withColumn("linked", 100 * F.col("common") >=
                           percent * (F.col("na") + F.col("nb") - F.col("common")))


def open_pairs(entries: dict[str, np.ndarray], percent: int, within: bool):
    """Yield (class, class) arrays of pairs, in whole parts of lists, that nothing rules out yet.

    ``entries`` stand part by part in order of size. A skip block keeps the
    best room (shingles from the position on) of its entries; an entry looks into
    the blocks up to the size limit whose best room is enough, a bounded number at a time.
    """
    keys = np.stack([entries[c] for c in ("t", "bi", "bj")], axis=1)
    total = len(keys)
    if not total:
        return
    group = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(axis=1)])
    n, room = entries["n"], entries["n"] - entries["pos"]
    far, block, root, name = (entries[c] for c in ("far", "block", "root", "c"))
    two = entries["bi"] != entries["bj"]
    # End of the entries of the same part that aren't too large: sizes grow within a part.
    most = int(n.max()) + 1
    end = np.searchsorted(group * most + n, group * most + np.minimum(100 * n // percent, most - 1), side="right")
    best = np.maximum.reduceat(room, np.arange(0, total, SKIP))
    least = -(-2 * percent * n // (100 + percent))  # overlap with a set no smaller
    first, last = (np.arange(total) + 1) // SKIP, -(-end // SKIP)
    blocks = np.where((room >= least) & (end > np.arange(total) + 1), last - first, 0)
    done = np.cumsum(blocks)
    if not done[-1]:
        return
    cuts = np.searchsorted(done, np.arange(0, int(done[-1]), PROBES), side="right")
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), total], strict=True):
        i = np.repeat(np.arange(lo, hi), blocks[lo:hi])
        k = first[i] + np.arange(len(i)) - np.repeat(done[lo:hi] - blocks[lo:hi] - done[lo] + blocks[lo], blocks[lo:hi])
        seen = best[k] >= least[i]
        for some in np.array_split(np.flatnonzero(seen), max(1, -(-int(seen.sum()) // PROBES))):
            a = np.repeat(i[some], SKIP)
            b = (k[some][:, None] * SKIP + np.arange(SKIP)).ravel()
            ok = (b > a) & (b < end[a])
            a, b = a[ok], b[ok]
            ok = (100 + percent) * np.minimum(room[a], room[b]) >= percent * (n[a] + n[b])
            if not within:
                ok &= root[a] != root[b]
            ok &= ~two[a] | (block[a] != block[b])
            ok &= ~(np.abs(far[a] - far[b]) > 1 - percent / 100 + 1e-9)  # NaN: not compared with the leader
            pairs = np.unique(np.stack([np.minimum(name[a], name[b])[ok], np.maximum(name[a], name[b])[ok]], axis=1), axis=0)
            if len(pairs):
                yield pairs[:, 0], pairs[:, 1]


COLUMNS = ("t", "bi", "bj", "n", "pos", "root", "block", "c", "far")


def whole_parts(batches, rows: int = ENTRIES):
    """Sorted entries as arrays of at least ``rows`` entries that end with a part of a list."""
    held = None
    for batch in batches:
        new = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64 if c == "far" else np.int64) for c in COLUMNS}
        held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in COLUMNS}
        if len(held["t"]) >= rows:
            same = np.ones(len(held["t"]), bool)
            for c in ("t", "bi", "bj"):
                same &= held[c] == held[c][-1]
            end = int(same.argmax())
            if end:
                yield {c: v[:end] for c, v in held.items()}
                held = {c: v[end:] for c, v in held.items()}
    if held is not None and len(held["t"]):
        yield held


def remaining_pairs(entries: DataFrame, known: DataFrame, roots: DataFrame, percent: int,
                    all_links: bool) -> DataFrame:
    """(hub, spoke): pairs of a list, no leader among them, that may still link."""
    rest = entries.where("size > 2").join(small(roots), F.col("c") == F.col("node"), "left").drop("node")
    rest = rest.withColumn("root", F.coalesce("root", "c"))
    if not all_links:
        several = (rest.groupBy("t").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                   .where("lo != hi").select("t"))
        rest = rest.join(small(several), "t", "left_semi")
    jaccard = F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    far = both_ways(known.select("hub", "spoke", (1 - jaccard).alias("far"))).select(
        F.col("hub").alias("leader"), F.col("spoke").alias("c"), "far")
    rest = (rest.join(small(far), ["leader", "c"], "left")
            .withColumn("far", F.when(F.col("c") == F.col("leader"), F.lit(0.0)).otherwise(F.col("far"))))
    # Pairs of parts: an entry of part k goes to (k, j) for later j and (i, k) for earlier i.
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    rest = rest.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("c"), "parts").cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rest = rest.select("t", "c", "n", "pos", "root", F.coalesce("far", F.lit(float("nan"))).alias("far"), "block",
                       F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
    schema = arrow_schema("hub long, spoke long")

    def search(batches):
        for part in whole_parts(batches):
            for hub, spoke in open_pairs(part, percent, all_links):
                yield pa.RecordBatch.from_arrays([pa.array(hub, pa.int64()), pa.array(spoke, pa.int64())], schema=schema)

    # A fixed number of partitions: the work is in the comparisons, not the bytes.
    tasks = 4 * partitions(entries.sparkSession)
    pairs = (rest.repartition(tasks, "t", "bi", "bj").sortWithinPartitions("t", "bi", "bj", "n", "c")
             .mapInArrow(frugal(search), "hub long, spoke long").distinct())
    met = known.select(F.least("hub", "spoke").alias("hub"), F.greatest("hub", "spoke").alias("spoke"))
    return pairs.join(small(met), ["hub", "spoke"], "left_anti")


def once(pairs: DataFrame) -> DataFrame:
    """(hub, spoke): one row for two classes that are each other's leader in some list."""
    both = pairs.groupBy(F.least("hub", "spoke"), F.greatest("hub", "spoke")).agg(F.min(F.struct("hub", "spoke")).alias("p"))
    return both.select("p.hub", "p.spoke")


def both_ways(pairs: DataFrame) -> DataFrame:
    """Every row, and the same with hub and spoke changed over."""
    rest = [c for c in pairs.columns if c not in ("hub", "spoke")]
    return pairs.select("hub", "spoke", *rest).unionByName(
        pairs.select(F.col("spoke").alias("hub"), F.col("hub").alias("spoke"), *rest))


def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose classes aren't in one component yet."""
    root = lambda name: small(roots).select(F.col("node").alias(name), F.col("root").alias("r" + name))
    both = pairs.join(root("hub"), "hub", "left").join(root("spoke"), "spoke", "left")
    return both.where(F.coalesce("rhub", "hub") != F.coalesce("rspoke", "spoke")).select(*pairs.columns)


def jaccard_classes(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, all_links: bool = False,
                    doc_id: str = "doc_id", text: str = "text", carry=()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Membership (doc_id, carry..., n_shingles, class), links (a, b, common, na, nb) and roots (node, root).

    Links name classes, roots the smallest class of each component; classes without a link have no root.
    """
    scratch = Scratch()
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("\x00"))
    rows = docs.select(key.alias("_id"), F.col(doc_id).alias("doc_id"), *carry, text_or_empty(text).alias("text"))
    sketch = frequency_sketch(rows.select("text"), width)
    sets = scratch.store(document_sets(rows, sketch, width, percent), "document_sets")
    # Classes are numbered as they are written: what moves from here on are numbers.
    reps = scratch.store(sets.where("class IS NOT NULL").groupBy("class").agg(
        F.min("_id").alias("_id"), F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.first("prefix").alias("prefix")).withColumn("c", F.monotonically_increasing_id()), "classes")
    members = scratch.store(sets.select("doc_id", *carry, F.col("n").alias("n_shingles"), "class"), "members")
    scratch.release(sets)

    # Most lists hold one class: they are found by their shingles alone, and
    # only entries of the others move (and the filter's few false hits).
    several = scratch.store(reps.select(F.explode("prefix").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("size"))
                            .where("size > 1"), "shared_shingles")
    met = scratch.store(list_entries(reps, several).join(small(several), "t"), "shared_entries")
    lists = met.groupBy("t").agg(F.min(F.struct("pos", "n", "c")).alias("lead"))
    entries = scratch.store(met.join(small(lists), "t").select(
        "t", "c", "n", "pos", "size", F.col("lead.c").alias("leader"),
        F.col("lead.n").alias("ln"), F.col("lead.pos").alias("lp")), "lists")
    scratch.release(several, met)

    meets = (entries.where(F.col("c") != F.col("leader")).where(can_link(percent, "n", "pos", "ln", "lp"))
             .groupBy(F.col("leader").alias("hub"), F.col("c").alias("spoke")).agg(F.count(F.lit(1)).alias("lists")))
    star = scratch.store(promising(meets, reps, percent), "leader_pairs")
    best = star.groupBy("spoke").agg(F.max(F.struct("lists", "hub")).alias("most"))
    chosen = scratch.store(once(best.select(F.col("most.hub").alias("hub"), "spoke")), "first_leaders")
    known = scratch.store(verified(chosen, rows, reps, width, percent), "leader_links")
    roots = scratch.store(components(known.where("linked"), "hub", "spoke"), "roots")
    other = once(star.select("hub", "spoke")).join(small(both_ways(chosen)), ["hub", "spoke"], "left_anti")
    other = scratch.store(other if all_links else across(other, roots), "other_leaders")
    known, roots = _more(scratch, known, roots, other, rows, reps, width, percent)
    scratch.release(star, chosen, other)
    rest = promising(remaining_pairs(entries, known, roots, percent, all_links), reps, percent)
    rest = scratch.store(rest, "open_pairs")
    known, roots = _more(scratch, known, roots, rest, rows, reps, width, percent)
    scratch.release(entries, rest)

    links = known.where("linked").select("hub", "spoke", "common", "na", "nb")
    of = lambda name: reps.select(F.col("c").alias(name), F.col("class").alias(name + "_class"))
    links = links.join(of("hub"), "hub").join(of("spoke"), "spoke").select(
        F.col("hub_class").alias("a"), F.col("spoke_class").alias("b"), "common", "na", "nb")
    roots = scratch.store(roots.join(of("node"), "node").join(of("root"), "root").select(
        F.col("node_class").alias("node"), F.col("root_class").alias("root")), "component_roots")
    return members, links, roots


def _more(scratch: Scratch, known: DataFrame, roots: DataFrame, pairs: DataFrame, rows: DataFrame, reps: DataFrame,
          width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Known overlaps and components after comparing ``pairs`` too."""
    if not pairs.limit(1).count():
        return known, roots
    fresh = scratch.store(verified(pairs, rows, reps, width, percent), "more_links")
    if not fresh.where("linked").limit(1).count():
        return known.unionByName(fresh), roots
    # A component goes on as the links to its root, so the work follows what is new.
    links = fresh.where("linked").select("hub", "spoke").unionByName(
        roots.select(F.col("root").alias("hub"), F.col("node").alias("spoke")))
    return known.unionByName(fresh), scratch.store(components(links, "hub", "spoke"), "roots")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE,
                       doc_id: str = "doc_id", text: str = "text", carry=()) -> DataFrame:
    """(doc_id, n_shingles, component_id, carry...), one row per document."""
    rows, _, roots = jaccard_classes(docs, percent, width, doc_id=doc_id, text=text, carry=carry)
    some = rows.where("class IS NOT NULL")
    least = some.groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    named = least.join(roots, F.col("class") == F.col("node"), "left")
    # A class of one document without a link is its own component: only the others are looked up.
    named = named.where("copies > 1 OR root IS NOT NULL").select("class", "least", F.coalesce("root", "class").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(named.join(small(ids), "root").select("class", "component_id"), "class_components")
    found = some.join(small(named), "class", "left")
    alone = rows.where("class IS NULL").withColumn("component_id", F.lit(None).cast(rows.schema["doc_id"].dataType))
    out = found.select("doc_id", "n_shingles", "component_id", *carry).unionByName(
        alone.select("doc_id", "n_shingles", "component_id", *carry))
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
