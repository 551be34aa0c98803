"""Exact deduplication by content sort, in DataFrame operations only.

Texts are equal when identical after their white space (space, U+0009 to
U+000D) is deleted. Records are range-partitioned on the normalised text with
sampled splitters and sorted externally within each range, which puts equal
texts next to each other; a window over the sorted rows compares neighbouring
texts in full and keeps, of equal ones, the row whose original text has most
code points, then the smallest id. Splitters are sampled as the first
``HEAD`` characters and a hash, so what the driver sees of a text is bounded.

Hot texts. A counted sample names the texts that would fill a good part of a
range (at most four per shuffle partition, by construction). Their sort key
gets a salt, so that such a group becomes several segments in several ranges;
one aggregated row per segment is enough to merge them.

Defined cases: a NULL text counts as empty, all empty texts form one group, a
NULL id loses against any other id, and of rows alike in text and id exactly
one is kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored, text_or_empty

# The white space that normalisation deletes.
WHITE_SPACE = " \t\n\x0b\x0c\r"
HEAD = 32  # leading characters of a text that its splitter key holds
SAMPLE_PER_PARTITION = 200  # sampled keys per shuffle partition
HOT_SAMPLES = 50  # a text seen so often in the sample is split
SEGMENT_SAMPLES = 12  # sampled keys a segment of a hot text stands for


def normalised(text: str = "text") -> Column:
    return F.translate(text_or_empty(text), WHITE_SPACE, "")


def hot_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_hash, _parts): texts worth splitting, at most 4 per shuffle partition."""
    wanted = SAMPLE_PER_PARTITION * partitions(docs.sparkSession)
    every = max(1, docs.count() // wanted)
    sampled = docs.withColumn("_mid", F.monotonically_increasing_id()).where(
        F.pmod(F.xxhash64("_mid"), F.lit(every)) == 0)
    return (sampled.groupBy(F.xxhash64(normalised(text)).alias("_hash")).count()
            .where(F.col("count") >= HOT_SAMPLES)
            .select("_hash", F.ceil(F.col("count") / SEGMENT_SAMPLES).cast("int").alias("_parts")))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry=()) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, carry...), one row per document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), *carry,
                       F.char_length(text_or_empty(text)).cast("long").alias("_len"),
                       normalised(text).alias("_norm"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("_mix"))
    rows = (rows.withColumn("_hash", F.xxhash64("_norm")).withColumn("_head", F.substring("_norm", 1, HEAD))
            .join(F.broadcast(stored(hot_texts(docs, text), "hot_texts")), "_hash", "left")
            .withColumn("_salt", F.coalesce(F.pmod("_mix", F.col("_parts")).cast("int"), F.lit(-1)))
            .drop("_parts", "_mix"))
    # The windows need the rows of one sort key together: the range
    # partitioning already gives that, so there is one exchange and one sort.
    key = ["_head", "_hash", "_salt"]
    ranged = rows.repartitionByRange(*key)
    best = [F.col("_len").desc(), F.col("doc_id").asc_nulls_last()]
    group = Window.partitionBy(*key, "_norm")
    first = stored(ranged.select(
        "doc_id", *carry, "_salt", "_len",
        F.row_number().over(group.orderBy(*best)).alias("_rank"),
        F.first("doc_id").over(group.orderBy(*best)).alias("_keep"),
        F.count(F.lit(1)).over(group).alias("_size"),
        F.sha2("_norm", 256).alias("text_sha256")), "content_sort")
    # One row per segment of a hot text; the hot list bounds their groups.
    order = F.struct((-F.col("_len")).alias("l"), F.col("doc_id").isNull().alias("n"),
                     F.col("doc_id").alias("d"), F.col("_salt").alias("s"))
    merged = (first.where((F.col("_salt") >= 0) & (F.col("_rank") == 1)).groupBy("text_sha256")
              .agg(F.min(order).alias("_best"), F.sum("_size").alias("_all")))
    out = first.join(F.broadcast(merged), "text_sha256", "left")
    hot = F.col("_best").isNotNull()
    return out.select(
        "doc_id", F.when(hot, F.col("_best.d")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_all", "_size").alias("group_size"),
        ((F.col("_rank") == 1) & (~hot | (F.col("_best.s") == F.col("_salt")))).alias("kept"),
        "text_sha256", *carry)
