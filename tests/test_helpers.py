import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sprout.sources.fixtures import materialize_at, release
from sprout.sources.lines import with_line_index


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 300), st.integers(1, 9))
def test_line_index_is_dense_and_ordered(spark, rows, parts):
    # Sorted ranges, one file each: the index follows the files in path order.
    df, path = materialize_at(spark.range(rows).repartitionByRange(parts, "id").sortWithinPartitions("id"), "line-index")
    got = with_line_index(df, "idx").collect()
    assert sorted((r.idx, r.id) for r in got) == [(k, k) for k in range(rows)]
    release(spark, path)


def test_line_index_of_a_folder_ignores_file_sizes_and_splits(spark, tmp_path):
    from sprout.session import scoped_conf
    from sprout.sources.lines import read_labelled_lines
    want = []
    for name, lines in (("a", 3), ("b", 400), ("c", 1), ("d", 90), ("e", 0), ("f", 250)):
        own = [f"{name} line {i} " + "x" * (i % 29) for i in range(lines)]
        (tmp_path / f"{name}.txt").write_text("".join(line + "+\n" for line in own))
        want += own
    for size in ("2048", "128m"):
        with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"}):
            got = sorted(read_labelled_lines(spark, str(tmp_path), index=True).collect())
        assert [(r.sent_id, r.text) for r in got] == list(enumerate(want))


def test_join_form_keeps_repeated_and_null_keys(spark):
    from sprout.plans import score_batch
    model = spark.createDataFrame([("good", 0, 1.0, 1), ("bad", 1, -2.0, 1)], "ngram string, fid int, weight double, n int")
    texts = spark.createDataFrame([(1, "good"), (1, "bad"), (None, "good"), (2, "good good"), (3, ""), (4, None)],
                                  "k int, text string")
    forms = [sorted(map(tuple, score_batch(texts, model, ["k"], max_lookup_keys=bound).collect()), key=repr)
             for bound in (100, 0)]
    assert forms[0] == forms[1]
    assert sorted(s for _, s, _ in forms[0]) == [-2.0, 0.0, 0.0, 1.0, 1.0, 2.0]


def test_self_training_forms_agree_on_repeated_ids(spark):
    from sprout.plans import self_train
    rows = [(1, "good nice day", 1), (2, "bad sad day", -1), (3, "good nice", 0), (3, "bad sad", 0), (None, "good nice", 0),
            (4, "fine nice good", 1), (5, "sad bad grim", -1), (4, "nothing here", 0)]
    df = spark.createDataFrame(rows, "sent_id long, text string, label int")
    forms = []
    for bound in (1000, 1):
        result = self_train(df, None, n=1, m=20, n_iter=30, threshold=0.1, alpha=0.1, max_lookup_keys=bound)
        forms.append(sorted(map(tuple, result.labelled_text().collect()), key=repr))
        assert all(h.seconds is not None for h in result.history) and len(result.models) == len(result.history)
    assert forms[0] == forms[1] and len(forms[0]) == len(rows)


def test_sink_keeps_one_row_per_text(spark, tmp_path):
    from sprout.sources.lines import read_labelled_lines, write_labelled_lines
    df = spark.createDataFrame([("first line\nsecond line", 1), ("a\r\nb", -1)], "text string, label int")
    for _ in range(2):  # the second write replaces the first
        write_labelled_lines(df, str(tmp_path / "out"))
    assert sorted(map(tuple, read_labelled_lines(spark, str(tmp_path / "out")).collect())) == [
        ("a  b", -1), ("first line second line", 1)]


def test_ranking_forms_agree(spark):
    from sprout.operators.vocab import rank_vocab
    counts = spark.createDataFrame([(f"w{k}", 1 + k % 7, 1 + k % 5) for k in range(60)] + [(None, 30, 30)],
                                   "ngram string, pos long, neg long")
    forms = [sorted((r.fid, r.ngram) for r in rank_vocab(counts, 30, 30, 25, topk_max=bound).collect()) for bound in (100, 10)]
    assert forms[0] == forms[1] and [f for f, _ in forms[0]] == list(range(25))


def test_release_deletes_scratch_copy(spark):
    copy, path = materialize_at(spark.range(10), "release-test")
    assert copy.count() == 10
    local = path.replace("file:", "")
    assert os.path.exists(local)
    release(spark, path)
    assert not os.path.exists(local)


def test_training_over_several_tasks_in_its_own_session(spark, monkeypatch):
    import numpy as np
    from sprout.operators import blocks
    from sprout.plans import train
    rows = [(1 if k % 3 else -1, [k % 7, (k * 5) % 7, k % 2]) for k in range(400)]
    df = spark.createDataFrame(rows, "label int, fids array<int>")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    one = train.train_weights(df, 7, 12, 0.01, 1e-9)
    monkeypatch.setattr(train, "BYTES_WORTH_A_TASK", 1024)
    data = train.stage_epoch_input(df.selectExpr("0 AS slot", "label", "fids"))
    assert data.tasks > 1 and data.blocks.rdd.getNumPartitions() == data.tasks
    data.release()
    monkeypatch.setattr(blocks, "DIRECT_BYTES", 0)  # partial sums meet in tasks, chunk by chunk
    monkeypatch.setattr(blocks, "CHUNK", 2)
    many = train.train_weights(df, 7, 12, 0.01, 1e-9, measure=True)
    assert one.epochs == many.epochs == 12
    np.testing.assert_allclose(one.weights, many.weights, atol=1e-12)
    assert before == {k: spark.conf.get(k) for k in before}
    early = train.train_weights(df, 7, 100, 0.0001, 10.0)  # the first step is already below delta
    assert early.epochs == 1


def test_wide_models_and_blocks_cut_between_rows(spark, monkeypatch):
    """A million features: weights travel as arrays; small blocks give the same sums."""
    import numpy as np
    from sprout.operators import blocks
    from sprout.plans import train
    rng = np.random.default_rng(3)
    rows = [(1 if rng.random() < 0.6 else -1, [int(x) for x in rng.integers(0, 1_000_000, 30)] + [7, 7, 999_999])
            for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, fids array<int>").repartition(3)
    want, labels = np.zeros(1_000_000), np.array([y for y, _ in rows])
    for _ in range(3):
        scores = np.array([want[f].sum() for _, f in rows])
        step = 0.05 * ((labels > 0) - 1 / (1 + np.exp(-scores)))
        for (_, f), g in zip(rows, step):
            np.add.at(want, f, g)
    for size in (1 << 19, 50):
        monkeypatch.setattr(blocks, "BLOCK_IDS", size)
        fit = train.train_weights(df, 1_000_000, 3, 0.05, 1e-9)
        np.testing.assert_allclose(fit.weights, want, atol=1e-12)


def test_counted_ids():
    import numpy as np
    from sprout.operators.blocks import counted
    ends, fids, cnts = counted(np.array([5, 5, 2, 9, 2, 2]), np.array([3, 0, 1, 2]))
    assert ends.tolist() == [2, 2, 3, 4] and fids.tolist() == [2, 5, 9, 2] and cnts.tolist() == [1, 2, 1, 2]
    assert [a.tolist() for a in counted(np.zeros(0, np.int64), np.zeros(2, np.int64))] == [[0, 0], [], []]


def test_ranking_leaves_out_what_cannot_be_chosen(spark, monkeypatch):
    """The sorted form with a cut at a quantile: same vocabulary for any m, ties and undefined gains included."""
    from sprout.operators.vocab import rank_vocab
    rows = [(f"w{k:04d}", 1 + k % 23, k % 17) for k in range(3000)] + [(f"z{k}", k % 3, 0) for k in range(900)] + [(None, 90, 80)]
    counts = spark.createDataFrame(rows, "ngram string, pos long, neg long").repartition(4)
    for m in (1, 40, 1500, 2900, 3500, 5000):
        forms = [[tuple(r) for r in rank_vocab(counts, 90, 80, m, topk_max=bound).orderBy("fid").collect()] for bound in (10**6, 0)]
        assert forms[0] == forms[1] and len(forms[0]) == min(m, 3900)


def test_join_featurization_tells_rows_apart(spark):
    from sprout.operators import featurize
    from sprout.operators.vocab import Vocabulary
    from sprout.functions.lookup import collect_lookup
    names = spark.createDataFrame([("a", 0), ("b", 1), ("the", 2)], "ngram string, fid int")
    vocab = Vocabulary(1, ("a", "b", "the"), collect_lookup(names, "ngram", "fid"))
    sents = spark.createDataFrame([(1, 1, "a the b the"), (1, 1, "b"), (None, 1, "the a"), (None, None, None), (2, 0, "x y")],
                                  "sent_id int, label int, text string")
    forms = [sorted(map(tuple, featurize(sents, vocab, max_lookup_keys=k).collect()), key=repr) for k in (10, 0)]
    assert forms[0] == forms[1] and len(forms[0]) == 5
    assert (1, 1, [0, 2, 1, 2]) in forms[0]


def test_heavy_ngrams_are_looked_up_in_the_rows(spark, monkeypatch):
    """A third of all tokens is one N-gram: no entry of it is shuffled, and the scores are those of the lookup form, bit by bit."""
    import random
    from pyspark.sql import functions as F
    from sprout.operators import hits
    from sprout.operators.vocab import tokenized
    from sprout.plans import score_batch
    rng = random.Random(1)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    rows = [(i, " ".join("the" if rng.random() < 1 / 3 else rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    texts = spark.createDataFrame(rows, "i int, text string").repartition(3)
    model = spark.createDataFrame([(g, k, rng.uniform(-1, 1), 1) for k, g in enumerate(["the", *words[::2]])],
                                  "ngram string, fid int, weight double, n int")
    want = sorted(map(tuple, score_batch(texts, model, ["i"]).collect()))
    for share, heavy in ((1e-4, 201), (0.02, 1), (1.0, 0)):
        monkeypatch.setattr(hits, "HEAVY_SHARE", share)
        entries = tokenized(texts, 1, keep=("i",)).select(F.explode(F.array_distinct("ng")).alias("ngram"))
        assert len(hits.heavy_ngrams(entries)) == heavy
        assert sorted(map(tuple, score_batch(texts, model, ["i"], max_lookup_keys=0).collect())) == want


def test_full_training_queries_match_brute_force(spark):
    """100 epochs at the default parameters: model, conversation scores and held-out accuracy."""
    import math
    import bruteforce as bf
    from conftest import SF_SMALL
    from sprout.queries import QUERIES
    train, test = bf.split(bf.load_sentences(SF_SMALL))
    rows = [(t, y) for _, t, y in train]
    names = bf.vocab(rows, 1, 400)
    fmap = {g: k for k, g in enumerate(names)}
    w, l1 = bf.train([(bf.featurize(t, fmap, 1), y) for t, y in rows if y != 0], 100, 0.002, 0.05)
    assert len(l1) > 3
    model = {r["ngram"]: r["weight"] for r in QUERIES["model_table_full"](spark, SF_SMALL).collect()}
    assert model.keys() == fmap.keys()
    assert all(math.isclose(model[g], w.get(k, 0.0), abs_tol=1e-9) for g, k in fmap.items())
    scores = {(r["conv_id"], r["turn"]): r["score"] for r in QUERIES["score_batch_full"](spark, SF_SMALL).collect()}
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    for r in turns:
        want = bf.score(bf.featurize(r["text"] or "", fmap, 1), w)
        assert math.isclose(scores[r["conv_id"], r["turn"]], want, abs_tol=1e-9)
    held = [(t, y) for _, t, y in test]
    assert math.isclose(QUERIES["accuracy_full"](spark, SF_SMALL).first()["accuracy"], bf.accuracy(held, fmap, w, 1))
