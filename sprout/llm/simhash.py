"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint. Every word shingle of a text, repeats included, is hashed to 64
bits; a bit of the fingerprint is 1 if it is set in more than half of the
hashes.

Covering masks. Each bit position gets a nonzero vector of r + 1 bits; each of
the 2^(r+1) - 1 nonzero vectors v gives a mask, which keeps the positions
whose vector has an odd product with v. Two fingerprints that differ in at most
r positions span at most r of the r + 1 dimensions, so some v is orthogonal to
all of them: its mask keeps none of these positions and the pair collides in
that table. No pair within the radius is missed, whatever the data.

Full buckets. A bucket holds fingerprints that agree on the kept half of the
bits. One with more than ``LIMIT`` distinct fingerprints is split again by
covering masks over the bits its mask left free, with the same guarantee; at
the third level at most ``2^8`` fingerprints can differ in what is left. So a
bucket that is compared in full is small by construction, and nothing is
dropped. Buckets are counted before anything moves; the many that hold one
fingerprint move no row.

A bucket yields a spanning forest of its links, at most one row per entry,
never all of its pairs; the forests of all buckets have the components of the
whole link graph. Equal fingerprints are one node from the start, however many
rows share them.

Defined cases: NULL and empty texts have fingerprint 0, which links like any
other; fewer words than a shingle form one shingle; a NULL id counts as no id in
the smallest id of its component, which is NULL if no row in it has one;
repeated rows and ids keep a row each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_schema, partitions, small, text_or_empty
from .components import components

SHINGLE = 3
RADIUS = 3  # fingerprints link at this many differing bits or fewer
SEED = 42  # of XXH64
LIMIT = 128  # distinct fingerprints of a bucket compared in full
LEVELS = 3
CHUNK = 1 << 16  # shingles hashed at one time
ENTRIES = 20_000  # entries compared at one time, and the rest of the last bucket

# ASCII letters to lower case; bytes.split() then cuts at exactly space and U+0009 to U+000D.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles, as an unsigned number."""
    from xxhash import xxh64_intdigest
    found = text.translate(_LOWER).split()
    if not found:
        return 0
    width = min(width, len(found))
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    total = len(found) - width + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        upto = min(total, at + CHUNK)
        cuts = zip(starts[at:upto].tolist(), ends[at + width - 1:upto + width - 1].tolist(), strict=True)
        hashes = np.fromiter([xxh64_intdigest(line[s:e], SEED) for s, e in cuts], "<u8", upto - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * counts > total))


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the positions ``bits``: any ``radius`` of them miss at least one mask together."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        kept = [b for k, b in enumerate(bits) if (((k % vectors) + 1) & v).bit_count() % 2]
        masks.append(sum(1 << b for b in kept))
    return masks


def mask_tree(radius: int = RADIUS, levels: int = LEVELS) -> list[list[tuple[int, int, int]]]:
    """Per level, (path, table, mask): the masks that split a bucket of table ``path`` further.

    Path 0 is the whole set; a mask of a deeper level keeps all that its path keeps.
    """
    tree, paths = [], [(0, 0)]
    for _ in range(levels):
        level = []
        for path, mask in paths:
            free = [b for b in range(64) if not mask >> b & 1]
            for k, more in enumerate(covering_masks(free, radius), 1):
                level.append((path, path << (radius + 1) | k, mask | more))
        tree.append(level)
        paths = [(table, mask) for _, table, mask in level]
    return tree


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, width: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): every row's fingerprint as a signed 64-bit number."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).cast("binary").alias("t"))
    ddl = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, fp long"
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            found = [signed(fingerprint(t.as_py(), width)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], schema=schema)

    return texts.mapInArrow(run, ddl)


def bucket_forest(group: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that join what is linked within each group; entries of a group stand together.

    Every entry is compared with the one after it, then the one after that,
    all entries at once, until each has met the end of its group.
    """
    left, right = [], []
    bits = fp.view(np.uint64)  # a signed number's own bits would be those of its absolute value
    i, step = np.arange(len(fp)), 0
    while len(i):
        step += 1
        i = i[i + step < len(fp)]
        i = i[group[i + step] == group[i]]
        near = i[np.bitwise_count(bits[i] ^ bits[i + step]) <= radius]
        left.append(near)
        right.append(near + step)
    left = np.concatenate(left) if left else np.zeros(0, np.int64)
    right = np.concatenate(right) if right else np.zeros(0, np.int64)
    root = np.arange(len(fp))
    while True:  # smallest entry reachable, by links and shortcuts
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = np.flatnonzero(root != np.arange(len(fp)))
    return fp[other], fp[root[other]]


def whole_groups(batches, rows: int = ENTRIES):
    """Sorted entries (t, key, fp) as arrays (group, fp) of at least ``rows`` entries that end with a group."""
    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([h, c.to_numpy().astype(np.int64)]) for h, c in zip(held, batch.columns, strict=True)]
        if len(held[0]) < rows:
            continue
        same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
        end = int(same.argmax())
        if end:
            yield numbered([h[:end] for h in held])
            held = [h[end:] for h in held]
    if len(held[0]):
        yield numbered(held)


def numbered(entries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t, key, fp = entries
    return np.cumsum(np.r_[0, (t[1:] != t[:-1]) | (key[1:] != key[:-1])]), fp


def close_links(shared: DataFrame, radius: int) -> DataFrame:
    """(a, b): spanning links of every bucket of ``shared`` (t, key, fp)."""
    schema = arrow_schema("a long, b long")

    def run(batches):
        for group, fp in whole_groups(batches):
            a, b = bucket_forest(group, fp, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return (shared.repartition(4 * partitions(shared.sparkSession), "t", "key")
            .sortWithinPartitions("t", "key").mapInArrow(run, "a long, b long").distinct())


def mask_table(spark: SparkSession, level: list[tuple[int, int, int]]) -> DataFrame:
    """A deeper level of the mask tree, a fixed number of rows (225 and 3,375 at radius 3)."""
    return spark.createDataFrame([(p, t, signed(m)) for p, t, m in level], "path int, t int, mask long")


def near_links(nodes: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(a, b): links between distinct fingerprints ``nodes`` (fp) with the components of all links within ``radius``."""
    spark, scratch = nodes.sparkSession, Scratch()
    tree, links = mask_tree(radius), []
    first = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(signed(m)).alias("mask")) for _, t, m in tree[0]])
    tables = nodes.select("fp", F.explode(first).alias("m")).select("fp", "m.t", "m.mask")
    for depth, level in enumerate(tree, 1):
        if depth > 1:
            tables = held.join(F.broadcast(mask_table(spark, level)), "path")
        entries = tables.select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        sizes = scratch.store(entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"),
                              "simhash_buckets")
        full = sizes.where(F.col("size") > limit) if depth < len(tree) else sizes.where("false")
        close = sizes.where(F.col("size") <= limit) if depth < len(tree) else sizes
        links.append(scratch.store(close_links(entries.join(small(close.drop("size")), ["t", "key"], "left_semi"), radius),
                                   "simhash_links"))
        if not full.limit(1).count():
            break
        deeper = entries.join(small(full.drop("size")), ["t", "key"], "left_semi")
        # A bucket's fingerprints go on under its table's masks; two buckets of a
        # table share no fingerprint, so (path, fp) stays distinct.
        held = scratch.store(deeper.select(F.col("t").alias("path"), "fp"), "simhash_full")
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def simhash_components(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE, limit: int = LIMIT,
                       doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document."""
    scratch = Scratch()
    rows = scratch.store(fingerprints(docs, width, doc_id, text), "fingerprints")
    nodes = scratch.store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint_nodes")
    roots = scratch.store(components(near_links(nodes.select("fp"), radius, limit), "a", "b"), "fingerprint_roots")
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.store(named.join(least, "root").select("fp", "component_id"), "fingerprint_components")
    return rows.join(small(named), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
