"""Corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of :mod:`sprout.llm` on all that the stage
before it kept; every stage's rows are written as Parquet and read again.
A stage decides by a row key (the id, or a number of its own where ids repeat
or are NULL) and returns the columns of its input, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.llm.common import by_ids, stored, table, with_row_key
from sprout.llm.decontam import decontaminate
from sprout.llm.exact_dedup import exact_dedup
from sprout.llm.ftrl import quality_scores
from sprout.llm.jaccard import jaccard_components
from sprout.llm.packing import pack
from sprout.llm.queries import tokenizer_path


# Near-duplicates of the stage: 5-word shingles, linked from a Jaccard of 0.8. (op7's
# own values, 3 words and 90 %, are those of its registered query.)
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def _carried(key: str) -> tuple[str, ...]:
    """What an operator has to pass through so that its rows can be told apart."""
    return () if key == "doc_id" else (key,)


def _needed(docs: DataFrame, key: str) -> DataFrame:
    return docs.select("doc_id", "text", *_carried(key))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    rows, key = with_row_key(docs)
    scores = quality_scores(_needed(rows, key), table(spark, sf_dir, "labels"), carry=_carried(key))
    rejected = stored(scores.where("predicted = 0").select(key), "rejected")
    return by_ids(rows, rejected, key, "left_anti").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts one row stays."""
    rows, key = with_row_key(docs)
    dropped = stored(exact_dedup(_needed(rows, key), carry=_carried(key)).where("NOT kept").select(key), "dropped")
    return by_ids(rows, dropped, key, "left_anti").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the smallest id of each component stays.

    Documents without a shingle are linked with nothing and stay.
    """
    rows, key = with_row_key(docs)
    linked = jaccard_components(_needed(rows, key), percent=NEAR_PERCENT, width=NEAR_WIDTH, carry=_carried(key))
    groups = stored(linked.where("n_shingles > 0")
                    .select("component_id", F.col("doc_id").alias("_id"), F.col(key).alias("_key")), "components")
    stays = groups.groupBy("component_id").agg(F.min(F.struct("_id", "_key")).alias("least"))
    # By the rows' own keys, which are unique: a component of any size is no join key.
    dropped = groups.select("_key").join(stays.select(F.col("least._key").alias("_key")), "_key", "left_anti")
    return by_ids(rows, stored(dropped.withColumnRenamed("_key", key), "near_duplicates"), key, "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark window go."""
    rows, key = with_row_key(docs)
    found = decontaminate(_needed(rows, key), table(spark, sf_dir, "benchmark"), carry=_carried(key))
    leaked = stored(found.where("contaminated").select(key), "contaminated")
    return by_ids(rows, leaked, key, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the pieces of the documents left and their places."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", dedup_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

# A trained classifier and a tokenizer take part: no SQL says that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
