"""Best-fit packing of token sequences by large-item matching.

Every document becomes its token ids and an end id; longer ones than a
sequence are cut into full pieces after a shorter first one. Packing needs only the
number of pieces of each length, at most ``capacity`` numbers whatever the
size of the corpus, so the plan is made on those counts: pieces above a third
of the capacity are matched greedily, the largest with the largest that fits,
at most two in a sequence; smaller ones, largest first, go to the fullest
sequence that still has room. The plan says how many sequences of each kind
there are; pieces are then ranked within their length by Spark and take the
places of the plan by rank.

Defined cases: a NULL or empty text is the end id alone; repeated rows and
NULL ids are packed like any other; an empty table gives no piece; extra
columns are ignored.

The ids are those of the ``tokenizers`` library for the given file. Its
byte-pair merges are read into ``tiktoken``, which gives the same ids several
times faster; texts with characters outside a fixed range, where the pre-token
rule might differ between Unicode versions, go to ``tokenizers`` itself.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, stored, text_or_empty

CAPACITY = 1024
END_ID = 2
ROWS_PER_BUCKET = 500_000  # rows ranked by one task, on average
BUCKETS = 1024  # at most; ranks need CAPACITY x BUCKETS counts

# Fixed value: the pre-token rule of the byte-level vocabulary.
PRE_TOKEN = r" ?\p{L}+|'(?:s|t|re|ve|m|ll|d)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on whose classes all Unicode versions agree: ASCII, Latin, dashes and quotes.
AGREED = "\t\n\r\x20-\x7e\xa1-ʯ‐-‧€"


def vocabulary(path: str) -> tuple[dict[bytes, int], list[str]]:
    """Byte strings and ids of a byte-level vocabulary file, and its added tokens, which aren't among them."""
    import json
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = [t["content"] for t in spec.get("added_tokens", ())]
    # A byte-level vocabulary writes printable bytes as themselves and the
    # others, in order, as the characters from U+0100.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    as_char = {chr(b): b for b in shown}
    as_char.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    return {bytes(as_char[c] for c in token): n for token, n in spec["model"]["vocab"].items() if token not in added}, added


class Encoder:
    """Texts to little-endian 32-bit ids, end id included."""

    def __init__(self, path: str, end_id: int = END_ID) -> None:
        import os
        import re

        import tiktoken
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        ranks, added = vocabulary(path)
        self.plain = tiktoken.Encoding("same ids", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
        self.other = re.compile("|".join([f"[^{AGREED}]", *map(re.escape, added)]))
        self.end = int(end_id).to_bytes(4, "little")

    def ids(self, text: str) -> list[int]:
        if self.other.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.plain.encode_ordinary(text)

    def __call__(self, text: str) -> bytes:
        return array("I", self.ids(text)).tobytes() + self.end


@cache
def encoder(path: str, end_id: int) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path, end_id)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids; the first may be short."""
    first = total % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    source = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"

    schema = arrow_schema(out)

    def run(batches):
        encode = encoder(tokenizer, end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 128).columns)
                rows = []
                for key, raw in zip(ids, map(encode, texts), strict=True):
                    for n, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                        rows.append((key, n, start, length, zlib.crc32(raw[4 * start:4 * (start + length)])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                    schema=schema)

    return source.mapInArrow(run, out)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(how many, lengths in order): kinds of sequences that hold all pieces."""
    left = dict(counts)
    kinds: list[list] = []  # [how many, lengths, room]
    for length in [n for n in left if n == capacity]:
        kinds.append([left.pop(length), [length], 0])
    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        for partner in [p for p in reversed(large) if p <= min(length, capacity - length)]:
            pairs = left[length] // 2 if partner == length else min(left[length], left[partner])
            if pairs:
                kinds.append([pairs, [length, partner], capacity - length - partner])
                left[length] -= pairs
                left[partner] -= pairs
        if left[length]:
            kinds.append([left[length], [length], capacity - length])
            left[length] = 0
    by_room: dict[int, list[list]] = {}
    for kind in kinds:
        by_room.setdefault(kind[2], []).append(kind)
    rooms = sorted(by_room)

    def take(room: int) -> list:
        kind = by_room[room].pop()
        if not by_room[room]:
            del by_room[room]
            rooms.pop(bisect_left(rooms, room))
        return kind

    def put(kind: list) -> None:
        if kind[2] not in by_room:
            by_room[kind[2]] = []
            rooms.insert(bisect_left(rooms, kind[2]), kind[2])
        by_room[kind[2]].append(kind)

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[length]
        while todo:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # no room anywhere: open sequences
                each = min(todo, capacity // length)
                kind = [todo // each, [length] * each, capacity - each * length]
                kinds.append(kind)
                todo -= kind[0] * each
            else:
                kind = take(rooms[at])
                if kind[0] > todo:  # only some of this kind are filled
                    rest = [kind[0] - todo, list(kind[1]), kind[2]]
                    kinds.append(rest)
                    put(rest)
                    kind[0] = todo
                kind[1] = [*kind[1], length]
                kind[2] -= length
                todo -= kind[0]
            put(kind)
    return [(n, lengths) for n, lengths, _ in kinds]


def places(kinds: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence and offset of each run of places."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for many, lengths in kinds:
        offset = 0
        for length in lengths:
            runs.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + many
            offset += length
        sequence += many
    return {n: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for n, r in runs.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    # A number per piece, written with it: pieces under one repeated or NULL id spread over the buckets too.
    cut_up = stored(pieces(docs, tokenizer, capacity, end_id, doc_id, text)
                    .withColumn("_n", F.monotonically_increasing_id()), "pieces")
    buckets = int(min(BUCKETS, max(8, cut_up.count() // ROWS_PER_BUCKET)))
    cut_up = cut_up.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "_n"), F.lit(buckets)).cast("int"))
    # At most capacity x buckets counts, far fewer in practice.
    sizes = cut_up.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece_counts")
    counts = {int(r[0]): int(r[1]) for r in sizes.groupBy("length").agg(F.sum("n")).collect()}
    where = places(plan_sequences(counts, capacity))

    ranked = cut_up.join(F.broadcast(sizes.select("length", "_bucket", "_before")), ["length", "_bucket"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_before") - 1 + F.row_number().over(
            Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")))
        .alias("_rank"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence = np.zeros(len(length), np.int64)
        offset = np.zeros(len(length), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for n in np.unique(lengths):
            own = lengths == n
            first, start, at = where[int(n)]
            run = np.searchsorted(first, ranks[own], side="right") - 1
            sequence[own] = start[run] + ranks[own] - first[run]
            offset[own] = at[run]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("_place", place("length", "_rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"))
