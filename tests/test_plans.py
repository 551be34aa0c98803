"""Plan-shape regressions: the scale properties claimed in README.md."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sprout.operators import Vocabulary, featurize, select_vocab
from sprout.operators.gradient import gradient_from_view
from sprout.operators.vocab import class_counts_with_totals, rank_vocab, tokenized
from sprout.session import scoped_conf
from sprout.sources import sentences, split_train_test


def _plan(df) -> str:
    with scoped_conf(df.sparkSession, {"spark.sql.adaptive.enabled": "false"}):
        return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan))


def test_featurize_has_no_shuffle(spark):
    train, _ = split_train_test(sentences(spark, SF_SMALL))
    vocab = Vocabulary.from_frame(select_vocab(train, 1, 50), 1)
    base = _shuffles(_plan(train))  # spreading a one-split table, if any
    assert _shuffles(_plan(featurize(train, vocab))) == base


def test_class_counts_one_shuffle_with_partial_aggregation(spark):
    train, _ = split_train_test(sentences(spark, SF_SMALL))
    plan = _plan(class_counts_with_totals(tokenized(train, 1), F.col("label")))
    assert _shuffles(plan) - _shuffles(_plan(train)) == 1
    assert "partial_count" in plan


def test_top_m_is_take_ordered(spark):
    train, _ = split_train_test(sentences(spark, SF_SMALL))
    counts = class_counts_with_totals(tokenized(train, 1), F.col("label"))
    assert "TakeOrderedAndProject" in _plan(rank_vocab(counts, 10, 5, 400))


def test_epoch_on_one_partition_needs_no_exchange(spark):
    df = spark.createDataFrame([(1, [0, 1]), (-1, [1, 2])], "label int, fids array<int>").coalesce(1)
    df.createOrReplaceTempView("plan_epoch")
    with scoped_conf(spark, {"spark.sql.shuffle.partitions": "1"}):
        plan = _plan(gradient_from_view(spark, "plan_epoch", [0.1, 0.2, 0.3], 0.01))
    assert _shuffles(plan) == 0


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(tokenized(sentences(spark, SF_SMALL), 1))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<doc_id:bigint,text:string>" in schemas
    assert all("n_chars" not in s and "source" not in s for s in schemas)
