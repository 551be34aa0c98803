"""Multi-round self-training on sf0.01 against the brute force (crosses the
Parquet state fold at round 10), and partition invariance."""

import pytest

import bruteforce as bf
from conftest import SF_MID, SF_SMALL
from sprout.plans import self_train
from sprout.sources import sentences, split_train_test


@pytest.mark.parametrize("params", [(1, 400, 10, 0.3, 0.05, 0.05), (2, 200, 8, 0.2, 0.05, 0.05)])
def test_many_rounds_match_bruteforce(spark, params):
    n, m, n_iter, threshold, alpha, delta = params
    train, test = split_train_test(sentences(spark, SF_MID))
    res = self_train(train, test, n=n, m=m, n_iter=n_iter, threshold=threshold, alpha=alpha, delta=delta)
    bf_train, bf_test = bf.split(bf.load_sentences(SF_MID))
    labels, models = bf.self_train(bf_train, n, m, n_iter, threshold, alpha, delta)
    assert len(res.models) == len(models)
    assert {r.sent_id: r.label for r in res.labels.collect()} == labels
    fmap, w, _ = models[-1]
    assert res.test_accuracy == pytest.approx(bf.accuracy([(t, l) for _, t, l in bf_test], fmap, w, n), abs=1e-12)


def test_self_train_partition_invariant(spark):
    train, _ = split_train_test(sentences(spark, SF_SMALL))
    a = self_train(train, None, m=100, n_iter=6, threshold=0.2, alpha=0.02)
    b = self_train(train.repartition(13), None, m=100, n_iter=6, threshold=0.2, alpha=0.02)
    assert {r.sent_id: r.label for r in a.labels.collect()} == {r.sent_id: r.label for r in b.labels.collect()}
    assert len(a.models) == len(b.models)
