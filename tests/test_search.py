from decimal import Decimal

import pytest

import bruteforce as bf
from conftest import SF_SMALL
from sprout.plans.search import (CHUNK, _group_counts, _key, _slot_totals, best_config, chunked, config_grid,
                                 grid_configs, inclusive_range, search)
from sprout.sources import sentences, split_train_test


def test_inclusive_decimal_range():
    assert inclusive_range(0.5, 0.8, 0.1) == [Decimal("0.5"), Decimal("0.6"), Decimal("0.7"), Decimal("0.8")]
    assert inclusive_range(100, 1000, 300) == [100, 400, 700, 1000]
    assert inclusive_range(1, 1, 1) == [1]


def test_grid_loop_order(spark):
    configs = grid_configs(n=(1, 2, 1), m=(100, 200, 100), num_iter=(5, 5, 1),
                           threshold=(0.5, 0.6, 0.1), alpha=(0.1, 0.1, 0.1), delta=(0.05, 0.05, 0.05))
    assert [c.config_id for c in configs] == list(range(8))
    assert [(c.n, c.m, c.threshold) for c in configs[:3]] == [(1, 100, 0.5), (1, 100, 0.6), (1, 200, 0.5)]
    assert config_grid(spark, n=(1, 2, 1), m=(100, 200, 100), num_iter=(5, 5, 1), threshold=(0.5, 0.6, 0.1),
                       alpha=(0.1, 0.1, 0.1), delta=(0.05, 0.05, 0.05)).count() == 8


def test_search_matches_bruteforce(spark):
    train, test = split_train_test(sentences(spark, SF_SMALL))
    grid = dict(n=(1, 1, 1), m=(40, 80, 40), num_iter=(8, 8, 1), threshold=(0.1, 0.3, 0.2),
                alpha=(0.01, 0.01, 0.01), delta=(0.05, 0.05, 0.05))
    results = search(train, test, checkpoint_every=2, **grid).orderBy("config_id").collect()
    bf_train, bf_test = bf.split(bf.load_sentences(SF_SMALL))
    rows = [(t, l) for _, t, l in bf_test]
    for r in results:
        labels, models = bf.self_train(bf_train, r.n, r.m, r.num_iter, r.threshold, r.alpha, r.delta)
        fmap, w, _ = models[-1]
        assert r.accuracy == pytest.approx(bf.accuracy(rows, fmap, w, 1), abs=1e-9)
        assert r.rounds == len(models)


def test_best_config_first_max_and_default(spark):
    schema = "config_id int, n int, m int, num_iter int, threshold double, alpha double, delta double, accuracy double, rounds int"
    df = spark.createDataFrame([(0, 1, 1, 1, 0.5, 0.1, 0.1, 0.2, 1), (1, 1, 2, 1, 0.5, 0.1, 0.1, 0.7, 1),
                                (2, 1, 3, 1, 0.5, 0.1, 0.1, 0.7, 1)], schema)
    assert best_config(df).first().config_id == 1
    zeros = spark.createDataFrame([(0, 1, 1, 1, 0.5, 0.1, 0.1, 0.0, 1), (1, 1, 2, 1, 0.5, 0.1, 0.1, 0.0, 1)], schema)
    assert best_config(zeros).first().config_id == 0


def test_search_large_m_uses_join_form(spark):
    train, test = split_train_test(sentences(spark, SF_SMALL))
    grid = dict(n=(1, 1, 1), m=(20, 40, 20), num_iter=(4, 4, 1), threshold=(0.2, 0.2, 0.1),
                alpha=(0.02, 0.02, 0.01), delta=(0.05, 0.05, 0.05))
    mixed = {r.config_id: (r.accuracy, r.rounds) for r in search(train, test, max_lookup_keys=30, **grid).collect()}
    plain = {r.config_id: (r.accuracy, r.rounds) for r in search(train, test, **grid).collect()}
    assert mixed.keys() == plain.keys() == {0, 1}
    for k in plain:
        assert mixed[k][1] == plain[k][1] and abs((mixed[k][0] or 0) - (plain[k][0] or 0)) < 1e-12


def test_chunks_of_a_large_grid():
    """96 configurations: bounded chunks, every one in one chunk, equal first rounds next to each other."""
    configs = grid_configs(n=(1, 2, 1), m=(100, 400, 100), num_iter=(50, 100, 50), threshold=(0.5, 0.7, 0.1),
                           alpha=(0.002, 0.004, 0.002), delta=(0.05, 0.05, 0.05))
    assert len(configs) == 96
    for n in (1, 2):
        group = [c for c in configs if c.n == n]
        for width, keys in ((CHUNK, 200_000), (5, 200_000), (None, 1000), (1, 200_000)):
            chunks = chunked(group, width, keys)
            assert sorted(c.config_id for part in chunks for c in part) == [c.config_id for c in group]
            assert all(len(part) <= (width or len(group)) and sum(c.m for c in part) <= keys for part in chunks)
            held = [{_key(c) for c in part} for part in chunks]
            for key in {_key(c) for c in group}:
                at = [k for k, keys_of in enumerate(held) if key in keys_of]
                assert at == list(range(at[0], at[-1] + 1))
        assert len(chunked(group, None, 10**9)) == 1


def test_same_result_for_any_chunks(spark):
    train, test = split_train_test(sentences(spark, SF_SMALL))
    grid = dict(n=(1, 1, 1), m=(30, 60, 30), num_iter=(5, 5, 1), threshold=(0.1, 0.3, 0.1),
                alpha=(0.02, 0.02, 0.01), delta=(0.05, 0.05, 0.05), max_rounds=4)
    runs = [search(train, test, chunk=c, **grid).collect() for c in (1, 4, None)]
    runs.append(search(train, test, max_lookup_keys=100, **grid).collect())  # the bound folds every round or two
    assert len(runs[0]) == 6 and all(r == runs[0] for r in runs)


def test_counts_of_all_configurations_in_one_aggregate(spark):
    rows = [(["a", "b", "a"], [1, 1, 0]), (["a", "c"], [-1, 0, 0]), (["b"], [0, 0, -1]), (["d"], [0, 0, 0]), ([], [1, 0, 0])]
    state = spark.createDataFrame(rows, "ng array<string>, labs array<int>")
    slots = [0, 1, 2]
    counts = _group_counts(state, slots)
    got = {r["ngram"]: tuple((r[f"pos_{s}"], r[f"neg_{s}"]) for s in slots) for r in counts.collect()}
    want = {g: tuple((sum(g in ng and labs[s] == 1 for ng, labs in rows), sum(g in ng and labs[s] == -1 for ng, labs in rows))
                     for s in slots) for g in "abc"}
    assert {g: v for g, v in got.items() if g} == want
    assert _slot_totals(counts, slots) == {s: (sum(labs[s] == 1 for _, labs in rows), sum(labs[s] == -1 for _, labs in rows),
                                               sum(labs[s] == 0 for _, labs in rows)) for s in slots}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and _group_counts(state, [0])._jdf.queryExecution().optimizedPlan().toString().count(
        "Generate") == 1
    assert _slot_totals(_group_counts(state.where("false"), slots), slots) == {s: (0, 0, 0) for s in slots}


def test_search_tokenizes_the_text_once(spark, monkeypatch):
    """Training text is tokenized for the stored tokens only, whatever the rounds and fold-ins; then the held-out text."""
    from sprout.plans import search as plan
    texts = []
    whole = plan.tokenized
    monkeypatch.setattr(plan, "tokenized", lambda rows, *a, **b: texts.append(rows) or whole(rows, *a, **b))
    train, test = split_train_test(sentences(spark, SF_SMALL))
    out = search(train, test, n=(1, 1, 1), m=(40, 80, 40), num_iter=(4, 4, 1), threshold=(0.1, 0.1, 0.1),
                 alpha=(0.02, 0.02, 0.01), delta=(0.05, 0.05, 0.05), checkpoint_every=1, max_rounds=3)
    assert max(r.rounds for r in out.collect()) > 1 and len(texts) == 2
