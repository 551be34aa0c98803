"""Worked examples from the source comments as golden cases."""

from pyspark.sql import functions as F

import bruteforce as bf

from sprout.functions import threshold_cut
from sprout.functions.lookup import build_lookup
from sprout.functions.stats import sign_marker, threshold_decision
from sprout.operators import Vocabulary, featurize, rank_vocab


def test_rank_to_id(spark):
    # Three N-grams with distinct, defined gains rank to ids 0, 1, 2 in gain order.
    counts = spark.createDataFrame([("a", 9, 1), ("b", 6, 4), ("c", 3, 3)], "ngram string, pos long, neg long")
    got = [(r.ngram, r.fid) for r in rank_vocab(counts, 20, 10, 3).orderBy("fid").collect()]
    gains = {g: bf.info_gain(p, n, 20, 10) for g, p, n in [("a", 9, 1), ("b", 6, 4), ("c", 3, 3)]}
    assert [g for g, _ in got] == sorted(gains, key=lambda g: -gains[g])
    assert [f for _, f in got] == [0, 1, 2]


def test_sentence_to_ids(spark):
    # "A B C D" with the trigram map {"a b c": 0, "b c d": 1} becomes [0, 1].
    keys = spark.createDataFrame([("a b c", 0), ("b c d", 1)], "ngram string, fid int")
    rows = keys.select("ngram", "fid", F.xxhash64("ngram").alias("h")).collect()
    vocab = Vocabulary(3, ("a b c", "b c d"), build_lookup([(r[0], r[1], r[2]) for r in rows]))
    df = spark.createDataFrame([(0, "A B C D", 0), (1, "A B", 0)], "sent_id long, text string, label int")
    got = {r.sent_id: r.fids for r in featurize(df, vocab).collect()}
    assert got == {0: [0, 1], 1: []}


def test_relabel_rule(spark):
    # ("A B", 0) scored 0.2 becomes 1 when 0.2 > threshold; bounds are strict.
    df = spark.createDataFrame([(0.2,), (-0.2,), (0.1,), (0.0,)], "s double")
    cut = [r[0] for r in df.select(threshold_cut(F.col("s"), 0.1)).collect()]
    assert cut == [1, -1, 0, 0]
    decide = [r[0] for r in df.select(threshold_decision(F.col("s"), 0.1)).collect()]
    assert decide == [1, -1, None, None]
    assert [r[0] for r in df.select(sign_marker(F.col("s"))).collect()] == ["+", "-", "+", "-"]
