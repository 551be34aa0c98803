"""Edge cases the source leaves undefined (it crashes or loops): defined results here."""

from sprout.plans import score_batch, self_train
from sprout.plans.selftrain import evaluate


def _df(spark, rows):
    return spark.createDataFrame(rows, "sent_id long, text string, label int")


def test_no_unlabelled_rows_still_trains_once(spark):
    df = _df(spark, [(0, "good bank money", 1), (1, "river bank water", -1), (2, "good money", 1)])
    res = self_train(df, None, m=10, n_iter=3, alpha=0.1)
    assert len(res.models) == 1 and res.unlabelled_after == 0


def test_no_labelled_rows_gives_empty_model(spark):
    df = _df(spark, [(0, "a b", 0), (1, "c d", 0)])
    res = self_train(df, None, m=10, n_iter=3)
    assert res.model.vocab.size == 0 and len(res.models) == 1
    assert sorted(r.label for r in res.labels.collect()) == [0, 0]


def test_null_and_empty_text(spark):
    df = _df(spark, [(0, None, 1), (1, "", -1), (2, "x y", 0), (3, "x", 1), (4, "y", -1)])
    res = self_train(df, None, m=10, n_iter=2, alpha=0.5, threshold=0.0)
    got = {r.sent_id: r.label for r in res.labels.collect()}
    assert got[0] == 1 and got[1] == -1
    frame = res.model.frame(spark)
    out = {r.sent_id: r.score for r in score_batch(df, frame, ["sent_id"]).collect()}
    assert out[0] == 0.0 and out[1] == 0.0


def test_empty_test_set_accuracy_is_null(spark):
    df = _df(spark, [(0, "good bank", 1), (1, "river bank", -1), (2, "good river", 0)])
    res = self_train(df, None, m=5, n_iter=2)
    assert evaluate(df.where("false"), res.model) is None
