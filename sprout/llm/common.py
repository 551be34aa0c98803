"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sprout.session import ensure_checkpoint_dir, scoped_conf
from sprout.sources.fixtures import materialize, materialize_at, release

# ASCII letters, lower-cased one by one (no other letter changes).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: ASCII characters outside words; every other character is part of one.
BETWEEN_WORDS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())

BATCH_ROWS = 1024  # rows of an Arrow batch
SLICE_ROWS = 256  # rows of an Arrow batch that are Python objects at one time
# Tables up to this many rows and bytes are broadcast, larger ones are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20

# Lower-cases A-Z in UTF-8 bytes and turns every ASCII byte outside a word into a space.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else
                   c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark's own reader (any file system)."""
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_rows(spark: SparkSession):
    """Context in which tasks exchange texts with Python in batches of at most ``BATCH_ROWS`` rows.

    A task and its worker hold a batch each, and copies of it, outside Spark's own memory.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    return scoped_conf(spark, {key: min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS})


def give_back() -> None:
    """Return what a worker has freed to the system: workers live on, and the next stage's memory comes on top."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, after which the worker gives its memory back."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts lineage)."""
    with arrow_rows(df.sparkSession):
        return materialize(df, name)


class Scratch:
    """Stored tables of one operator, deleted one by one once nothing reads them any more."""

    def __init__(self) -> None:
        self.held: list[tuple[DataFrame, str]] = []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        with arrow_rows(df.sparkSession):
            table, path = materialize_at(df, name)
        self.held.append((table, path))
        return table

    def release(self, *tables: DataFrame) -> None:
        for table in tables:
            for k, (held, path) in enumerate(self.held):
                if held is table:
                    release(table.sparkSession, path)
                    del self.held[k]
                    break


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in a join's hash table, about: 32, the text of strings and binaries, 8 for a number, also in an array."""
    def size(c: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        return 8 * F.greatest(F.size(c), F.lit(0)) + 16 if kind.startswith("array") else F.lit(8)
    return sum((size(c, kind) for c, kind in df.dtypes), F.lit(32))


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its rows and bytes, counted first, are within the bounds.

    Without the hint the join shuffles both sides, with the same result.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """ARRAY<STRING>: words in text order, A-Z lower-cased.

    One character map and a split at single spaces, which costs a third of
    a regular expression over the text.
    """
    spaced = F.translate(text, UPPER + BETWEEN_WORDS, LOWER + " " * len(BETWEEN_WORDS))
    return F.array_remove(F.split(spaced, " "), "")


def held_out(doc_id: Column) -> Column:
    """Rows whose label may not be learnt: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def per_row(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """Apply a row function in Arrow batches: columns of ``df`` in, ``schema`` out.

    ``make`` runs once per task and returns the function, so models and
    compiled patterns are built there. One slice of texts is held at a time.
    """
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                columns = [c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns]
                rows = [fn(*row) for row in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col, type=f.type)
                     for col, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    return df.mapInArrow(frugal(run), schema)


def by_ids(docs: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join of ``docs`` to a list of ids, NULL keys never matching.

    The list is broadcast only after its rows and bytes were counted; a longer
    list takes the shuffled join, with the same result.
    """
    return docs.join(small(ids), key, how)


def with_row_key(docs: DataFrame, doc_id: str = "doc_id") -> tuple[DataFrame, str]:
    """``docs`` and the name of a column that is unique per row.

    That is the id itself when it is unique and never NULL. Otherwise the
    rows are stored with a number of their own, under a name that no column has.
    """
    ids = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("_n"))
    if ids.where((F.col("_n") > 1) | F.col(doc_id).isNull()).limit(1).count() == 0:
        return docs, doc_id
    name = "_row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name
