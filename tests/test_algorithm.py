"""Spark results against the plain-Python brute force on the sf0.001 fixture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import bruteforce as bf
from conftest import SF_SMALL
from sprout.operators import Vocabulary, featurize, featurize_by_join, select_vocab
from sprout.operators.vocab import label_totals, ngram_class_counts, rank_vocab, tokenized
from sprout.plans import self_train, train_weights
from sprout.sources import sentences, split_train_test


@pytest.fixture(scope="module")
def split(spark):
    return split_train_test(sentences(spark, SF_SMALL))


@pytest.fixture(scope="module")
def bf_split():
    return bf.split(bf.load_sentences(SF_SMALL))


@pytest.mark.parametrize("n,m", [(1, 400), (2, 100), (1, 5)])
def test_vocab_matches_bruteforce(spark, split, bf_split, n, m):
    train, _ = split
    got = [r.ngram for r in select_vocab(train, n, m).orderBy("fid").collect()]
    want = bf.vocab([(t, l) for _, t, l in bf_split[0]], n, m)
    assert got == want


def test_vocab_size_is_min_m_distinct(spark, split):
    train, _ = split
    distinct = ngram_class_counts(train, 1).count()
    assert select_vocab(train, 1, 10 ** 6).count() == distinct
    fids = [r.fid for r in select_vocab(train, 1, 37).collect()]
    assert sorted(fids) == list(range(37))


def test_undefined_gain_ranks_last(spark, split):
    train, _ = split
    p, q, _ = label_totals(train)
    ranked = rank_vocab(ngram_class_counts(train, 1), p, q, 10 ** 6).orderBy("fid").collect()
    seen_null = False
    for r in ranked:
        if r.ig is None:
            seen_null = True
        else:
            assert not seen_null
    assert seen_null


def test_training_matches_bruteforce(spark, split, bf_split):
    train, _ = split
    vocab = Vocabulary.from_frame(select_vocab(train, 1, 400), 1)
    feats = featurize(train.where("label != 0"), vocab)
    fit = train_weights(feats, vocab.size, 25, 0.002, 0.05)
    fmap = {g: i for i, g in enumerate(vocab.ngrams)}
    bfeats = [(bf.featurize(t, fmap, 1), l) for _, t, l in bf_split[0] if l != 0]
    w, l1s = bf.train(bfeats, 25, 0.002, 0.05)
    want = np.zeros(vocab.size)
    for f, v in w.items():
        want[f] = v
    assert fit.epochs == len(l1s)
    assert np.allclose(fit.weights, want, rtol=0, atol=1e-9)
    assert np.allclose(fit.l1, l1s, rtol=0, atol=1e-9)


def test_early_stop_after_step(spark, split):
    train, _ = split
    vocab = Vocabulary.from_frame(select_vocab(train, 1, 50), 1)
    fit = train_weights(featurize(train.where("label != 0"), vocab), vocab.size, 10, 0.002, 1e9)
    assert fit.epochs == 1 and np.any(fit.weights != 0)


def test_training_without_features(spark):
    df = spark.createDataFrame([(1, []), (-1, [])], "label int, fids array<int>")
    fit = train_weights(df, 3, 5, 0.1, 0.05)
    assert fit.epochs == 1 and list(fit.weights) == [0.0, 0.0, 0.0]


def test_lookup_and_join_featurize_agree(spark, split):
    train, _ = split
    vocab = Vocabulary.from_frame(select_vocab(train, 2, 200), 2)
    a = {r.sent_id: sorted(r.fids) for r in featurize(train, vocab).collect()}
    b = {r.sent_id: sorted(r.fids) for r in
         featurize_by_join(tokenized(train, 2), vocab.frame(spark)).collect()}
    assert a == b and len(a) == train.count()


def test_self_train_matches_bruteforce(spark, split, bf_split):
    train, test = split
    res = self_train(train, test, n=1, m=100, n_iter=15, threshold=0.3, alpha=0.01, delta=0.05)
    labels, models = bf.self_train(bf_split[0], 1, 100, 15, 0.3, 0.01, 0.05)
    got = {r.sent_id: r.label for r in res.labels.collect()}
    assert got == labels
    assert len(res.models) == len(models)
    fmap, w, _ = models[-1]
    rows = [(t, l) for _, t, l in bf_split[1]]
    assert res.test_accuracy == pytest.approx(bf.accuracy(rows, fmap, w, 1), abs=1e-12)


def test_self_train_properties(spark, split):
    train, _ = split
    res = self_train(train, None, n=1, m=100, n_iter=10, threshold=0.2, alpha=0.01, delta=0.05)
    seeds = {r.sent_id: r.label for r in train.collect()}
    final = {r.sent_id: r.label for r in res.labels.collect()}
    assert all(final[s] == l for s, l in seeds.items() if l != 0)
    before = [h.unlabelled_before for h in res.history] + [res.unlabelled_after]
    assert all(a >= b for a, b in zip(before, before[1:]))
    assert res.unlabelled_after == sum(1 for v in final.values() if v == 0)


def test_self_train_fixed_vocab(spark, split):
    train, _ = split
    res = self_train(train, None, n=1, m=60, n_iter=5, threshold=0.05, alpha=0.05, delta=0.05,
                     refresh_vocab=False)
    assert all(m.vocab.ngrams == res.models[0].vocab.ngrams for m in res.models)


def test_scores_invariant_to_partitioning(spark, split):
    from sprout.plans.selftrain import score_rows
    train, test = split
    res = self_train(train, None, n=1, m=50, n_iter=5, max_rounds=1)
    a = {r.sent_id: r.score for r in score_rows(test, res.model).collect()}
    b = {r.sent_id: r.score for r in score_rows(test.repartition(7), res.model).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_labelled_text_matches_state(spark, split):
    train, _ = split
    res = self_train(train, None, n=1, m=80, n_iter=8, threshold=0.1, alpha=0.02, delta=0.05,
                     checkpoint_every=2)
    state = {r.sent_id: r.label for r in res.labels.collect()}
    text = {r.sent_id: r.label for r in res.labelled_text().collect()}
    assert state == text
    assert len(res.models) >= 2


def test_batched_training_equals_single(spark, split):
    from pyspark.sql import functions as F
    from sprout.plans.train import train_weights_batched
    train, _ = split
    v1 = Vocabulary.from_frame(select_vocab(train, 1, 60), 1)
    v2 = Vocabulary.from_frame(select_vocab(train, 1, 30), 1)
    f1 = featurize(train.where("label != 0"), v1)
    f2 = featurize(train.where("label != 0"), v2)
    both = (f1.select(F.lit(0).alias("slot"), "label", "fids")
            .unionByName(f2.select(F.lit(1).alias("slot"), "label", "fids")))
    got = train_weights_batched(both, {0: 60, 1: 30}, {0: 12, 1: 4}, {0: 0.01, 1: 0.05}, {0: 0.05, 1: 1e-9})
    one = train_weights(f1, 60, 12, 0.01, 0.05)
    two = train_weights(f2, 30, 4, 0.05, 1e-9)
    assert got[0].epochs == one.epochs and got[1].epochs == two.epochs == 4
    assert np.allclose(got[0].weights, one.weights, atol=1e-12)
    assert np.allclose(got[1].weights, two.weights, atol=1e-12)


def test_sorted_ranking_equals_topk(spark, split):
    train, _ = split
    p, q, _ = label_totals(train)
    counts = ngram_class_counts(train.repartition(5), 1).persist()
    for m in (7, 300, 10 ** 6):
        a = [(r.ngram, r.fid, r.ig) for r in rank_vocab(counts, p, q, m).orderBy("fid").collect()]
        b = [(r.ngram, r.fid, r.ig) for r in rank_vocab(counts, p, q, m, topk_max=0).orderBy("fid").collect()]
        assert a == b and [x[1] for x in a] == list(range(len(a)))
    counts.unpersist()


def test_joined_self_train_equals_lookup_and_bruteforce(spark, split, bf_split):
    train, test = split
    params = dict(n=1, m=60, n_iter=6, threshold=0.2, alpha=0.02, delta=0.05)
    joined = self_train(train, test, max_lookup_keys=10, **params)
    lookup = self_train(train, test, **params)
    got = {r.sent_id: r.label for r in joined.labels.collect()}
    assert got == {r.sent_id: r.label for r in lookup.labels.collect()}
    labels, models = bf.self_train(bf_split[0], 1, 60, 6, 0.2, 0.02, 0.05)
    assert got == labels and len(joined.models) == len(models)
    assert joined.test_accuracy == pytest.approx(lookup.test_accuracy, abs=1e-12)
    a = {r.ngram: r.weight for r in joined.model_frame(spark).collect()}
    b = {r.ngram: r.weight for r in lookup.model_frame(spark).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    text = {r.sent_id: r.label for r in joined.labelled_text().collect()}
    assert text == got
