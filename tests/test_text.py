from pyspark.sql import functions as F

from sprout.functions import ngrams, tokenize, words


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("x")).first()["x"]


def test_tokenizer_contract(spark):
    got = _one(spark, tokenize, "Hello World, it's O'Neil's x-ray ÉTÉ ü don't'")
    assert got == ["hello", "world", "it's", "o'neil", "s", "x", "ray", "t", "don't"]


def test_tokenizer_empty(spark):
    assert _one(spark, tokenize, "") == []
    assert _one(spark, tokenize, "123 ... !!") == []


def test_words_keep_case(spark):
    assert _one(spark, words, "The bank, the Bank") == ["The", "bank", "the", "Bank"]


def test_ngram_windows(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "t array<string>")
    for n, want in [(1, [["a", "b", "c", "d"], ["a"], []]),
                    (2, [["a b", "b c", "c d"], [], []]),
                    (3, [["a b c", "b c d"], [], []]),
                    (4, [["a b c d"], [], []]),
                    (5, [[], [], []])]:
        assert [r[0] for r in df.select(ngrams("t", n)).collect()] == want


def test_comment_example_trigrams(spark):
    # "A B C D" has the trigrams "a b c" and "b c d".
    tok = spark.createDataFrame([("A B C D",)], "text string").select(tokenize("text").alias("t"))
    assert tok.select(ngrams("t", 3)).first()[0] == ["a b c", "b c d"]


def test_ngram_rows_equal_the_window_lists(spark):
    from sprout.functions.text import ngram_rows
    texts = [None, "", "one", "one two", "a b c d a b c", "It's it's 5 o'clock o'clock", "x " * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(tokenize("text").alias("tok"))
    for n in (1, 2, 3, 5):
        want = sorted(g for r in rows.select(ngrams("tok", n).alias("ng")).collect() for g in r.ng)
        assert sorted(r.ngram for r in ngram_rows(rows, "tok", n).collect()) == want


def test_ngram_counts_hold_a_bounded_text_per_task(spark, tmp_path, monkeypatch):
    """However large the splits, a task counts TEXT_PER_TASK bytes, and the text is tokenized once."""
    from sprout import queries
    from sprout.sources import fixtures
    texts = [f"alpha beta w{k % 7} gamma delta" for k in range(400)]
    path = str(tmp_path)
    (spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
     .write.parquet(f"{path}/documents.parquet"))
    spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    monkeypatch.setattr(fixtures, "TEXT_PER_TASK", 1000)
    tasks = -(-sum(map(len, texts)) // 1000)
    for n in (1, 2, 3):
        found = queries._ngram_occurrences(spark, path, n)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert f"Repartition {tasks}, true" in plan and plan.count("regexp_extract_all") == 1
        words = [t.replace("w", "w ").split() for t in texts]
        words = [[w for w in own if not w.isdigit()] for own in words]
        want = {}
        for own in words:
            for k in range(len(own) - n + 1):
                g = " ".join(own[k:k + n])
                want[g] = want.get(g, 0) + 1
        assert {r.ngram: r.occurrences for r in found.collect()} == want
