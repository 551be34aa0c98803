from pyspark.sql import functions as F

import bruteforce as bf
from conftest import SF_SMALL
from sprout.plans.modes import search_mode, train_mode
from sprout.plans.modes import test_mode as score_saved_model
from sprout.sources import encode_labelled, sentences


def _write_lines(spark, path):
    # One text file, one line per document, in doc_id order: line index == doc_id.
    sents = sentences(spark, SF_SMALL).select("sent_id", F.regexp_replace("text", r"[\r\n]", " ").alias("text"),
                                                "label")
    lines = [r.value for r in encode_labelled(sents.orderBy("sent_id")).collect()]
    path.write_text("\n".join(lines) + "\n")
    return lines


def test_train_then_test_mode(spark, tmp_path):
    lines = _write_lines(spark, tmp_path / "in.txt")
    res = train_mode(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), str(tmp_path / "model"),
                     m=60, n_iter=6, threshold=0.2, alpha=0.02, legacy_model_path=str(tmp_path / "legacy"))
    rows = [(i, l[:-1], {"+": 1, "-": -1}.get(l[-1], 0)) for i, l in enumerate(lines)]
    train, test = bf.split(rows)
    labels, models = bf.self_train(train, 1, 60, 6, 0.2, 0.02, 0.05)
    written = spark.read.text(str(tmp_path / "out")).collect()
    assert len(written) == len(train)
    want = sorted(text + {1: "+", -1: "-"}.get(labels[i], "0") for i, text, _ in train)
    assert sorted(r.value for r in written) == want
    fmap, w, _ = models[-1]
    assert abs(res.test_accuracy - bf.accuracy([(t, l) for _, t, l in test], fmap, w, 1)) < 1e-12
    docs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    a = {r.item_id: r.label for r in score_saved_model(spark, str(tmp_path / "model"), docs, ["item_id"]).collect()}
    b = {r.item_id: r.label for r in score_saved_model(spark, str(tmp_path / "legacy"), docs, ["item_id"], legacy=True).collect()}
    assert a == b and len(a) == docs.count()


def test_search_mode(spark, tmp_path):
    _write_lines(spark, tmp_path / "in.txt")
    results, best = search_mode(spark, str(tmp_path / "in.txt"), m=(30, 60, 30), num_iter=(4, 4, 1),
                                threshold=(0.2, 0.2, 0.1), alpha=(0.02, 0.02, 0.01), delta=(0.05, 0.05, 0.05))
    rows = results.orderBy("config_id").collect()
    assert [r.m for r in rows] == [30, 60]
    top = max(rows, key=lambda r: (r.accuracy or 0, -r.config_id))
    assert best.first().config_id == (top.config_id if (top.accuracy or 0) > 0 else 0)


def test_command_line(spark, tmp_path):
    from sprout.cli import main
    _write_lines(spark, tmp_path / "in.txt")
    common = ["--input", str(tmp_path / "in.txt"), "--output", str(tmp_path / "out"),
              "--model", str(tmp_path / "model"), "--m_start", "40", "--num_iter_start", "4",
              "--threshold_start", "0.2", "--alpha_start", "0.02"]
    result = main(["--mod", "train"] + common, spark=spark)
    assert len(result.models) >= 1 and result.model.vocab.size == 40
    out = main(["--mod", "test", "--model", str(tmp_path / "model"), "--test_sent", "the bank of the river"],
               spark=spark)
    assert out.first().label in ("+", "-")
    grid = ["--m_end", "80", "--m_step", "40", "--threshold_end", "0.2", "--alpha_end", "0.02", "--num_iter_end", "4"]
    results, best = main(["--mod", "search"] + common + grid, spark=spark)
    assert results.count() == 2 and best.count() == 1
    empty, none = main(["--mod", "search"] + common, spark=spark)  # alpha start > end: no configuration
    assert empty.count() == 0 and none.count() == 0


def test_module_entry_point_help():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "sprout", "--mod", "help"], cwd=root,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "--mod train, search or test" in out.stdout


def test_command_line_variants(spark, tmp_path):
    from sprout.cli import main
    _write_lines(spark, tmp_path / "in.txt")
    result = main(["--mod", "train", "--input", str(tmp_path / "in.txt"), "--output", str(tmp_path / "out"),
                   "--model", str(tmp_path / "model"), "--m_start", "30", "--num_iter_start", "2",
                   "--threshold_start", "0.05", "--alpha_start", "0.05", "--delta_start", "0.0",
                   "--scala_epochs", "--fixed_vocab"], spark=spark)
    assert all(h.epochs == 3 for h in result.history)
    assert all(m.vocab.ngrams == result.models[0].vocab.ngrams for m in result.models)
    assert all(h.seconds is not None and h.seconds > 0 for h in result.history)
