import pytest
from conftest import SF_SMALL
from sprout.plans import score_batch, self_train
from sprout.sources import sentences, split_train_test
from sprout.streaming import start_scoring


def test_stream_scores_equal_batch(spark, tmp_path):
    train, _ = split_train_test(sentences(spark, SF_SMALL))
    frame = self_train(train, None, n=1, m=80, n_iter=5, max_rounds=1).model.frame(spark)
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    src = str(tmp_path / "in")
    conv.repartition(3).write.parquet(src)
    sink = str(tmp_path / "out")
    query = start_scoring(spark, src, "conv_id long, turn long, role string, text string", frame, sink,
                          keys=["conv_id", "turn"], checkpoint=str(tmp_path / "ckpt"), trigger_once=True)
    query.awaitTermination(120)
    got = {(r.conv_id, r.turn): (round(r.score, 9), r.label) for r in spark.read.parquet(sink).collect()}
    want = {(r.conv_id, r.turn): (round(r.score, 9), r.label)
            for r in score_batch(conv, frame, ["conv_id", "turn"]).collect()}
    assert got == want and len(got) == conv.count()


def test_text_stream_scores_equal_batch(spark, tmp_path):
    from sprout.streaming import start_scoring_text
    train, _ = split_train_test(sentences(spark, SF_SMALL))
    frame = self_train(train, None, n=1, m=80, n_iter=5, max_rounds=1).model.frame(spark)
    src = tmp_path / "text-in"
    src.mkdir()
    texts = ["the bank of the river", "money in the bank", "", "x y z"]
    (src / "a.txt").write_text("\n".join(texts[:2]) + "\n")
    (src / "b.txt").write_text("\n".join(texts[2:]) + "\n")
    sink = str(tmp_path / "text-out")
    q = start_scoring_text(spark, str(src), frame, sink, checkpoint=str(tmp_path / "ck"), trigger_once=True)
    q.awaitTermination(120)
    got = {r.text: round(r.score, 9) for r in spark.read.parquet(sink).collect()}
    batch = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    want = {texts[r.i]: round(r.score, 9) for r in score_batch(batch, frame, ["i"]).collect()}
    assert got == want


def test_large_model_is_joined_in_runs(spark, tmp_path, monkeypatch):
    """Above the lookup bound: each run scores what is new, a run that failed late is done again, scores equal the batch's."""
    from sprout.plans import batch as plans
    from sprout.streaming import scoring
    frame = spark.createDataFrame([(f"w{k}", k, (k % 7 - 3) / 7, 1) for k in range(300)] + [("ünï", 300, 0.1, 1)],
                                  "ngram string, fid int, weight double, n int").repartition(3)
    texts = ["w1 w2 w2 w299 none", "", None, "none at all", "ünï w3 w3 w3 w5 w8", "w1 w2 w2 w299 none"]
    schema, src, sink = "i int, text string", str(tmp_path / "in"), str(tmp_path / "out")
    monkeypatch.setattr(scoring, "MAX_LOOKUP_KEYS", 20)

    def arrive(k):
        rows = spark.createDataFrame([(10 * k + i, t) for i, t in enumerate(texts)], schema)
        rows.coalesce(1).write.mode("append").parquet(src)
        return rows

    def run():
        start_scoring(spark, src, schema, frame, sink, ["i"], checkpoint=str(tmp_path / "ck"), trigger_once=True)

    def scores():
        return sorted(tuple(r) for r in spark.read.parquet(sink).drop("run").collect())

    want = []
    for k in range(2):
        want += [tuple(r) for r in score_batch(arrive(k), frame, ["i"]).collect()]
        run()
        run()  # nothing new
        assert scores() == sorted(want)
    rows, writer = arrive(2), type(spark.range(1).write)
    write = writer.parquet

    def fails(self, path, *args, **kw):
        if path.endswith("/runs"):
            raise OSError("lost before the run was recorded")
        return write(self, path, *args, **kw)
    with monkeypatch.context() as broken:
        broken.setattr(writer, "parquet", fails)
        with pytest.raises(OSError):
            run()
    run()
    want += [tuple(r) for r in score_batch(rows, frame, ["i"]).collect()]
    assert scores() == sorted(want)
    assert sorted(map(tuple, scoring.score_stream(rows, frame, ["i"]).collect())) == sorted(
        tuple(r) for r in score_batch(rows, frame, ["i"]).collect())
    with pytest.raises(ValueError):
        start_scoring(spark, src, schema, frame, sink, ["i"], checkpoint=str(tmp_path / "ck2"))
    assert plans.load_model(frame, limit=20) is None
