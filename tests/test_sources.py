import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sprout.plans import load_model, score_batch, self_train
from sprout.sources import (build_corpus, keyword_filter, read_legacy_model, read_model, seed_by_marker,
                            sentences, split_train_test, write_legacy_model, write_model)


def test_keyword_filter_exact_case(spark):
    df = spark.createDataFrame([(1, "The bank is here"), (2, "a bankrupt bank."), (3, "Bank")], "id int, text string")
    assert [r.id for r in keyword_filter(df, "bank").collect()] == [1, 2]


def test_marker_first_match_substring(spark):
    df = spark.createDataFrame([("x src12 y",), ("src2",), ("src1",), ("none",)], "tags string")
    got = [r[0] for r in df.select(seed_by_marker(F.col("tags"), "src1", "src2")).collect()]
    assert got == ["+", "-", "+", "0"]


def test_build_corpus(spark):
    tagged = spark.createDataFrame([(1, "the bank, river", "src1"), (2, "no match", "src1"), (3, "the x", "src2")],
                                   "id long, text string, tags string")
    plain = spark.createDataFrame([(9, "at the bank")], "id long, text string")
    out = build_corpus("the", [("t", tagged, F.col("id"), F.lit(0), "text", "tags")],
                       [("u", plain, F.col("id"), F.lit(0), "text")], "src1", "src2")
    assert sorted((r.corpus, r.item_id, r.value) for r in out.collect()) == [
        ("t", 1, "the bank, river+"), ("t", 3, "the x-"), ("u", 9, "at the bank0")]


def _model(spark):
    train, _ = split_train_test(sentences(spark, SF_SMALL))
    return self_train(train, None, n=2, m=60, n_iter=5, max_rounds=1).model


def test_model_roundtrips(spark, tmp_path):
    frame = _model(spark).frame(spark)
    write_model(frame, str(tmp_path / "p"))
    back = read_model(spark, str(tmp_path / "p"))
    want = sorted((r.ngram, r.fid, r.weight, r.n) for r in frame.collect())
    assert sorted((r.ngram, r.fid, r.weight, r.n) for r in back.collect()) == want
    write_legacy_model(back, str(tmp_path / "t"))
    legacy = read_legacy_model(spark, str(tmp_path / "t"))
    assert sorted((r.ngram, r.weight, r.n) for r in legacy.collect()) == sorted((g, w, n) for g, _, w, n in want)
    rows = sorted(legacy.collect(), key=lambda r: r.fid)
    assert [r.fid for r in rows] == list(range(len(rows)))
    assert [r.weight for r in rows] == sorted((w for _, _, w, _ in want), reverse=True)
    files = spark.read.text(str(tmp_path / "t")).collect()
    assert [f"({r.ngram},{r.weight!r})".split(",")[0] for r in rows] == [f.value.split(",")[0] for f in files]
    write_legacy_model(back.limit(3), str(tmp_path / "t"))  # outputs are overwritten
    assert spark.read.text(str(tmp_path / "t")).count() == 3
    lines = spark.read.text(str(tmp_path / "t")).collect()
    assert all(r.value.startswith("(") and r.value.endswith(")") for r in lines)


def test_score_batch_lookup_equals_join(spark):
    frame = _model(spark).frame(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    a = {r.doc_id: (round(r.score, 9), r.label) for r in score_batch(docs, frame, ["doc_id"]).collect()}
    b = {r.doc_id: (round(r.score, 9), r.label) for r in
         score_batch(docs, frame, ["doc_id"], max_lookup_keys=0).collect()}
    assert a == b and len(a) == docs.count()
    assert load_model(frame).n == 2


def test_failed_overwrite_keeps_the_old_output(spark, tmp_path):
    import os
    from pyspark.sql import functions as F
    from sprout.sources.lines import read_labelled_lines, write_labelled_lines
    from sprout.sources.models import read_model, write_model
    lines, model = str(tmp_path / "lines"), str(tmp_path / "model")
    good = spark.createDataFrame([("one", 1), (None, -1)], "text string, label int")
    frame = spark.createDataFrame([("a", 0, 0.5, 1)], "ngram string, fid int, weight double, n int")
    write_labelled_lines(good, lines)
    write_model(frame, model)
    broken = good.withColumn("text", F.when(F.col("label") > 0, F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises(Exception):
        write_labelled_lines(broken, lines)
    with pytest.raises(Exception):
        write_model(frame.withColumn("ngram", F.raise_error(F.lit("no")).cast("string")), model)
    assert sorted(map(tuple, read_labelled_lines(spark, lines).collect())) == [("", -1), ("one", 1)]
    assert read_model(spark, model).collect() == frame.collect()
    assert sorted(os.listdir(tmp_path)) == ["lines", "model"]  # no staging folder is left
    write_model(frame.withColumn("weight", F.lit(2.0)), model)
    assert read_model(spark, model).first()["weight"] == 2.0
    assert sorted(os.listdir(tmp_path)) == ["lines", "model"]
