"""Property tests: Spark tokenizer / N-grams / information gain against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import bruteforce as bf
from sprout.functions import information_gain, ngrams, tokenize

ALPHABET = "abcXYZ' .,-\n\tÉéüß0İK"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts, st.integers(min_value=1, max_value=3))
def test_ngrams_match_python(spark, batch, n):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, text string")
    got = {r.i: r.g for r in df.select("i", tokenize("text").alias("t")).select("i", ngrams("t", n).alias("g")).collect()}
    assert [got[i] for i in range(len(batch))] == [bf.ngrams(t, n) for t in batch]


counts = st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(0, 30), st.integers(0, 30))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(counts, min_size=1, max_size=40))
def test_information_gain_matches_python(spark, rows):
    # (p1, n1, extra positives, extra negatives): totals P = p1 + extra, Q = n1 + extra
    data = [(p1, n1, p1 + ep, n1 + en) for p1, n1, ep, en in rows]
    df = spark.createDataFrame(data, "p1 long, n1 long, P long, Q long")
    got = [r[0] for r in df.select(information_gain(F.col("p1"), F.col("n1"), F.col("P"), F.col("Q"))).collect()]
    for value, (p1, n1, P, Q) in zip(got, data):
        want = bf.info_gain(p1, n1, P, Q)
        assert (value is None) == (want is None)
        if want is not None:
            assert abs(value - want) < 1e-12


examples = st.lists(st.tuples(st.sampled_from([1, -1]), st.lists(st.integers(0, 7), max_size=6)),
                    min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(examples, st.sampled_from([0.05, 0.5, 3.0]), st.sampled_from([0.01, 0.3, 10.0]))
def test_training_matches_python(spark, rows, alpha, delta):
    import numpy as np
    from sprout.plans import train_weights
    df = spark.createDataFrame(rows, "label int, fids array<int>")
    fit = train_weights(df, 8, 6, alpha, delta)
    w, l1s = bf.train([(f, l) for l, f in rows], 6, alpha, delta)
    want = np.zeros(8)
    for f, v in w.items():
        want[f] = v
    assert fit.epochs == len(l1s)
    assert np.allclose(fit.weights, want, atol=1e-9)
