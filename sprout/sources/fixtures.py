"""Fixture tables and the ``sentences`` view built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path

TEST_EVERY = 5  # every 5th labelled row is held out


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Parquet table; a scan with fewer splits than cores is spread over them.

    Text work is per row and CPU-bound, so a small table read as one split
    (one row group) would tokenize in one task. Spreading it is a cheap
    round-robin shuffle of a small input; a large table already has more
    splits than cores and is left as it is.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_small(df) if spread else df


def spread_small(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the default parallelism if it has fewer partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


# Bytes of text whose N-grams one task counts.
TEXT_PER_TASK = 8 << 20


def spread_text(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` dealt out evenly, about ``TEXT_PER_TASK`` bytes of text to a task, if that makes more tasks than cores.

    A split of a compressed file holds tens of millions of words. A table of all their N-grams
    in one task grows with the split, out of the cache and then onto disk.
    """
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = -(-size // TEXT_PER_TASK)
    return rows.repartition(tasks) if tasks > rows.sparkSession.sparkContext.defaultParallelism else rows


def label_from_quality(quality) -> F.Column:
    """quality 1 -> 1, 0 -> -1, missing -> 0 (unknown)."""
    return F.when(quality == 1, F.lit(1)).when(quality == 0, F.lit(-1)).otherwise(F.lit(0))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sent_id, text, label): documents LEFT JOIN labels.

    No join hint: Catalyst broadcasts ``labels`` when its file size is under
    the broadcast threshold and shuffles both sides otherwise.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", spread=False).select("doc_id", "quality")
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("doc_id").alias("sent_id"), "text",
                    label_from_quality(F.col("quality")).alias("label")))


def is_test(sent_id="sent_id", label="label") -> F.Column:
    return (F.col(label) != 0) & (F.col(sent_id) % TEST_EVERY == 0)


def split_train_test(sents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Held-out rows: labelled and id % 5 == 0. Train: everything else."""
    return sents.where(~is_test()), sents.where(is_test())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder, read it back.

    Cuts lineage reliably: a lost executor re-reads files, it does not
    recompute joins. Column pruning still works on the copy.
    """
    return materialize_at(df, name)[0]


def materialize_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """:func:`materialize`, also returning the path (for :func:`release`)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), path


# Tables up to this many rows and bytes are sent to every task, larger ones are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its rows and bytes, counted first, are within the bounds.

    Without the hint Catalyst shuffles both sides of the join, with the same result.
    """
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) + 8 if kind in ("string", "binary") else F.lit(8)
             for c, kind in df.dtypes]
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(sizes, F.lit(32))), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def release(spark: SparkSession, path: str | None) -> None:
    """Delete a scratch copy made by :func:`materialize_at` once it is superseded."""
    if path:
        delete_path(spark, path)
