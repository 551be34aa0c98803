"""Named queries over the fixture tables, one per operator family.

Each takes (spark, sf_dir) and returns a DataFrame. Every one reads the
whole fixture tables. The oracle-checked ones fix the parameters in
``CHECK``; three training epochs keep the SQL oracle tractable.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import defaults
from .functions.stats import sigmoid, threshold_cut
from .functions.text import ngram_rows, tokenize
from .operators.features import explode_features, featurize
from .operators.gradient import gradient, gradient_norm
from .operators.scoring import Model, accuracy
from .operators.vocab import (Vocabulary, label_totals, ngram_class_counts, ngram_doc_freq,
                              select_vocab, tokenized)
from .functions.stats import information_gain
from .plans.batch import score_batch
from .plans.search import best_config, search
from .plans.selftrain import score_rows, self_train
from .plans.train import train_model
from .session import scratch_path
from .sources.corpus import build_corpus, keyword_filter, seed_by_marker
from .sources.fixtures import read_table, sentences, split_train_test, spread_text
from .sources.lines import encode_labelled, parse_lines, read_labelled_lines, write_labelled_lines
from .sources.models import read_legacy_model, read_model, write_legacy_model, write_model

# Parameters of the oracle-checked training queries.
CHECK = dict(n=1, m=400, n_iter=3, threshold=0.5, alpha=0.002, delta=0.05)
# Keyword corpus: an exact, case-sensitive word; sense markers found in tag text.
KEYWORD = "the"
SENSE_POS, SENSE_NEG = "src1", "src2"
# Search grid used by the registered search query (inclusive ranges).
SEARCH_GRID = dict(n=(1, 1, 1), m=(100, 400, 300), num_iter=(20, 20, 20),
                   threshold=(0.5, 0.8, 0.3), alpha=(0.002, 0.002, 0.002),
                   delta=(0.05, 0.05, 0.05))


def r6(col):
    """Round for cross-engine comparison; + 0.0 folds -0.0 into 0.0."""
    return F.round(col, 6) + F.lit(0.0)


def _split(spark, sf):
    return split_train_test(sentences(spark, sf))


def _vocab(spark, sf, n=CHECK["n"], m=CHECK["m"]):
    train, _ = _split(spark, sf)
    return Vocabulary.from_frame(select_vocab(train, n, m), n)


def _model(spark, sf, n=CHECK["n"]) -> Model:
    train, _ = _split(spark, sf)
    vocab = _vocab(spark, sf, n=n)
    model, _ = train_model(train, vocab, CHECK["n_iter"], CHECK["alpha"], CHECK["delta"])
    return model


# --- sources, decode/encode, filters -------------------------------------------------

def q_scan_sentences(spark, sf):
    """Labelled lines written as text and scanned back (one line per document)."""
    path = scratch_path(spark, "labelled-lines")
    write_labelled_lines(sentences(spark, sf).select("text", "label"), path)
    return read_labelled_lines(spark, path)


def q_overwrite_outputs(spark, sf):
    """Labelled lines and a model written twice to the same paths, read back: the second write counts."""
    sents = sentences(spark, sf).select("text", "label")
    path = scratch_path(spark, "overwritten-lines")
    write_labelled_lines(sents.withColumn("label", F.lit(0)), path)
    write_labelled_lines(sents, path)
    return read_labelled_lines(spark, path)


def q_line_index(spark, sf):
    """Lines in several files, read back with their position over the whole folder."""
    path = scratch_path(spark, "indexed-lines")
    by_id = sentences(spark, sf).repartitionByRange(7, "sent_id").sortWithinPartitions("sent_id")
    write_labelled_lines(by_id.select("text", "label"), path)
    return read_labelled_lines(spark, path, index=True)


def q_parse_lines(spark, sf):
    lines = encode_labelled(sentences(spark, sf), keep=("sent_id",))
    return parse_lines(lines, keep=("sent_id",))


def q_parse_lines_strip3(spark, sf):
    """The notebook's line form: three trailing characters dropped, last one is the marker."""
    lines = encode_labelled(sentences(spark, sf), keep=("sent_id",))
    return parse_lines(lines, strip_chars=3, keep=("sent_id",))


def q_encode_labelled_text(spark, sf):
    return encode_labelled(sentences(spark, sf), keep=("sent_id",))


def q_label_counts(spark, sf):
    s = sentences(spark, sf)
    split = F.when((F.col("label") != 0) & (F.col("sent_id") % 5 == 0), F.lit("test")).otherwise(F.lit("train"))
    lab = F.col("label")
    return (s.groupBy(split.alias("split"))
            .agg(F.count_if(lab == 1).alias("positives"), F.count_if(lab == -1).alias("negatives"),
                 F.count_if(lab == 0).alias("unlabelled"), F.count(F.lit(1)).alias("total")))


def q_split_train_test(spark, sf):
    train, test = _split(spark, sf)
    return (train.select("sent_id", "label", F.lit("train").alias("split"))
            .unionByName(test.select("sent_id", "label", F.lit("test").alias("split"))))


def q_labelled_only(spark, sf):
    train, _ = _split(spark, sf)
    return train.where(F.col("label") != 0).select("sent_id", "label")


# --- text ------------------------------------------------------------------------

def q_tokenize(spark, sf):
    s = sentences(spark, sf)
    return s.select("sent_id", F.posexplode(tokenize("text")).alias("pos", "token"))


def _ngram_occurrences(spark, sf, n):
    """Every N-gram and its occurrences; a task counts a bounded amount of text before the shuffle."""
    rows = spread_text(sentences(spark, sf).select("text")).select(tokenize("text").alias("tok"))
    return ngram_rows(rows, "tok", n).groupBy("ngram").agg(F.count(F.lit(1)).alias("occurrences"))


def q_ngrams_n1(spark, sf):
    return _ngram_occurrences(spark, sf, 1)


def q_ngrams_n2(spark, sf):
    return _ngram_occurrences(spark, sf, 2)


def q_ngrams_n3(spark, sf):
    return _ngram_occurrences(spark, sf, 3)


def q_ngram_doc_freq(spark, sf):
    train, _ = _split(spark, sf)
    return ngram_doc_freq(train, CHECK["n"])


def q_ngram_class_counts(spark, sf):
    train, _ = _split(spark, sf)
    return ngram_class_counts(train, CHECK["n"])


def q_info_gain(spark, sf):
    train, _ = _split(spark, sf)
    positives, negatives, _ = label_totals(train)
    counts = ngram_class_counts(train, CHECK["n"])
    return counts.select("ngram", "pos", "neg",
                         F.round(information_gain(F.col("pos"), F.col("neg"), positives, negatives), 9).alias("ig"))


def q_select_vocab(spark, sf):
    train, _ = _split(spark, sf)
    return select_vocab(train, CHECK["n"], CHECK["m"])


def q_select_vocab_n2(spark, sf):
    train, _ = _split(spark, sf)
    return select_vocab(train, 2, CHECK["m"])


def q_vocab_semi_filter(spark, sf):
    """Occurrences, over training rows, of N-grams kept by the vocabulary."""
    train, _ = _split(spark, sf)
    vocab = select_vocab(train, CHECK["n"], CHECK["m"]).select("ngram")
    occ = tokenized(train, CHECK["n"], keep=("sent_id",)).select(F.explode("ng").alias("ngram"))
    return (occ.join(vocab, "ngram", "left_semi")
            .groupBy("ngram").agg(F.count(F.lit(1)).alias("occurrences")))


# --- features, training, scoring ------------------------------------------------------

def q_featurize(spark, sf):
    train, _ = _split(spark, sf)
    feats = featurize(train.where(F.col("label") != 0), _vocab(spark, sf))
    return explode_features(feats, keep=("sent_id",))


def q_featurize_n2(spark, sf):
    train, _ = _split(spark, sf)
    feats = featurize(train.where(F.col("label") != 0), _vocab(spark, sf, n=2))
    return explode_features(feats, keep=("sent_id",))


def q_gradient_step(spark, sf):
    train, _ = _split(spark, sf)
    vocab = _vocab(spark, sf)
    feats = featurize(train.where(F.col("label") != 0), vocab)
    delta = gradient(feats, [0.0] * vocab.size, CHECK["alpha"])
    return delta.select("fid", r6(F.col("delta")).alias("delta"))


def q_gradient_norm(spark, sf):
    train, _ = _split(spark, sf)
    vocab = _vocab(spark, sf)
    feats = featurize(train.where(F.col("label") != 0), vocab)
    delta = gradient(feats, [0.0] * vocab.size, CHECK["alpha"])
    return gradient_norm(delta).select(r6(F.col("l1")).alias("l1"))


def q_train_weights_3ep(spark, sf):
    model = _model(spark, sf)
    return model.frame(spark).where(F.col("weight") != 0).select("fid", "ngram", r6(F.col("weight")).alias("weight"))


def q_model_table(spark, sf):
    model = _model(spark, sf)
    return model.frame(spark).select("ngram", "fid", r6(F.col("weight")).alias("weight"), "n")


def q_model_roundtrip(spark, sf):
    """Model written as Parquet and as legacy text lines, both read back."""
    frame = _model(spark, sf).frame(spark)
    parquet_path = scratch_path(spark, "model-parquet")
    write_model(frame, parquet_path)
    text_path = scratch_path(spark, "model-text")
    write_legacy_model(read_model(spark, parquet_path), text_path)
    legacy = read_legacy_model(spark, text_path)
    return legacy.select("ngram", "fid", r6(F.col("weight")).alias("weight"), "n")


def q_score_sentences(spark, sf):
    _, test = _split(spark, sf)
    scored = score_rows(test, _model(spark, sf))
    return scored.select("sent_id", "label", r6(F.col("score")).alias("score"))


def q_predict_proba(spark, sf):
    _, test = _split(spark, sf)
    scored = score_rows(test, _model(spark, sf))
    return scored.select("sent_id", r6(sigmoid(F.col("score"))).alias("prob"))


def q_threshold_label(spark, sf):
    train, _ = _split(spark, sf)
    scored = score_rows(train.where(F.col("label") == 0), _model(spark, sf))
    return scored.select("sent_id", r6(F.col("score")).alias("score"),
                         threshold_cut(F.col("score"), CHECK["threshold"]).alias("new_label"))


def q_accuracy(spark, sf):
    _, test = _split(spark, sf)
    acc = accuracy(score_rows(test, _model(spark, sf)))
    return acc.select(F.round("accuracy", 9).alias("accuracy"), "n", "correct")


def q_score_batch(spark, sf):
    frame = _model(spark, sf).frame(spark)
    conv = read_table(spark, sf, "conversations")
    out = score_batch(conv, frame, keys=("conv_id", "turn"))
    return out.select("conv_id", "turn", r6(F.col("score")).alias("score"), "label")


def q_score_batch_joined(spark, sf):
    """The same scores by the join form, which models beyond the lookup bound take."""
    frame = _model(spark, sf).frame(spark)
    conv = read_table(spark, sf, "conversations")
    out = score_batch(conv, frame, keys=("conv_id", "turn"), max_lookup_keys=0)
    return out.select("conv_id", "turn", r6(F.col("score")).alias("score"), "label")


# Default parameters: 100 epochs. No SQL statement goes so far; tests compare with a brute force.

def _full_model(spark, sf) -> Model:
    train, _ = _split(spark, sf)
    return train_model(train, _vocab(spark, sf), defaults.NUM_ITER, defaults.ALPHA, defaults.DELTA)[0]


def q_model_table_full(spark, sf):
    """The model of a whole training at the default parameters."""
    return _full_model(spark, sf).frame(spark)


def q_score_batch_full(spark, sf):
    """Every conversation turn scored with that model."""
    return score_batch(read_table(spark, sf, "conversations"), _full_model(spark, sf).frame(spark), keys=("conv_id", "turn"))


def q_accuracy_full(spark, sf):
    """Its accuracy on the held-out rows."""
    _, test = _split(spark, sf)
    return accuracy(score_rows(test, _full_model(spark, sf)))


# --- self-training and search ---------------------------------------------------------

def q_self_train_round1(spark, sf):
    train, _ = _split(spark, sf)
    result = self_train(train, None, max_rounds=1, **CHECK)
    return result.labels.select("sent_id", "label")


# Two-round self-training: parameters under which round 2 labels new rows.
ROUND2 = dict(n=1, m=400, n_iter=3, threshold=0.3, alpha=0.05, delta=0.05)


def q_self_train_round2(spark, sf):
    """Two rounds of self-training (the second on the grown labels)."""
    train, _ = _split(spark, sf)
    result = self_train(train, None, max_rounds=2, **ROUND2)
    return result.labels.select("sent_id", "label")


def q_selftrain_output_lines(spark, sf):
    """Labelled-line output after one self-training round (text + marker)."""
    train, _ = _split(spark, sf)
    result = self_train(train, None, max_rounds=1, **CHECK)
    return encode_labelled(result.labelled_text(), keep=("sent_id",))


def q_self_train_round1_n2(spark, sf):
    train, _ = _split(spark, sf)
    result = self_train(train, None, max_rounds=1, **dict(CHECK, n=2))
    return result.labels.select("sent_id", "label")


def q_self_train(spark, sf):
    """Full self-training at the default parameters (no SQL oracle)."""
    train, test = _split(spark, sf)
    result = self_train(train, test)
    return result.labels.select("sent_id", "label")


def q_search_grid(spark, sf):
    """Hyperparameter grid, every configuration run to convergence (no SQL oracle)."""
    train, test = _split(spark, sf)
    return search(train, test, **SEARCH_GRID)


# One-round search: round 1 only (shared ranking, batched training, per
# configuration held-out accuracy); its accuracy depends on m, not on the threshold.
SEARCH_ROUND1_GRID = dict(n=(1, 1, 1), m=(100, 400, 300), num_iter=(3, 3, 1),
                          threshold=(0.5, 0.8, 0.3), alpha=(0.002, 0.002, 0.002),
                          delta=(0.05, 0.05, 0.05))


def q_search_round1(spark, sf):
    train, test = _split(spark, sf)
    out = search(train, test, max_rounds=1, **SEARCH_ROUND1_GRID)
    return out.select("config_id", "m", "threshold", "accuracy")


def q_best_config_round1(spark, sf):
    """The best configuration of the one-round search."""
    train, test = _split(spark, sf)
    out = best_config(search(train, test, max_rounds=1, **SEARCH_ROUND1_GRID))
    return out.select("config_id", "m", "threshold", "accuracy")


# The same grid at the default number of epochs, every configuration to convergence.
SEARCH_GRID_FULL = dict(SEARCH_GRID, num_iter=(100, 100, 100))


def q_search_grid_full(spark, sf):
    train, test = _split(spark, sf)
    return search(train, test, **SEARCH_GRID_FULL)


def q_best_config(spark, sf):
    train, test = _split(spark, sf)
    return best_config(search(train, test, **SEARCH_GRID))


# --- corpus assembly --------------------------------------------------------------

def _corpora(spark, sf):
    docs = read_table(spark, sf, "documents")
    conv = read_table(spark, sf, "conversations")
    bench = read_table(spark, sf, "benchmark")
    return docs, conv, bench


def q_corpus_union(spark, sf):
    docs, conv, bench = _corpora(spark, sf)
    zero = F.lit(0).cast("long")
    return (docs.select(F.lit("documents").alias("corpus"), F.col("doc_id").alias("item_id"), zero.alias("sub_id"), "text")
            .unionByName(conv.select(F.lit("conversations").alias("corpus"), F.col("conv_id").alias("item_id"),
                                     F.col("turn").alias("sub_id"), "text"))
            .unionByName(bench.select(F.lit("benchmark").alias("corpus"), "item_id", zero.alias("sub_id"), "text")))


def q_keyword_filter(spark, sf):
    docs, _, _ = _corpora(spark, sf)
    return keyword_filter(docs, KEYWORD).select("doc_id")


def q_seed_by_marker(spark, sf):
    docs, _, _ = _corpora(spark, sf)
    return docs.select("doc_id", seed_by_marker(F.col("source"), SENSE_POS, SENSE_NEG).alias("marker"))


def q_build_corpus(spark, sf):
    docs, conv, bench = _corpora(spark, sf)
    zero = F.lit(0).cast("long")
    return build_corpus(
        KEYWORD,
        tagged=[("documents", docs, F.col("doc_id"), zero, "text", "source")],
        untagged=[("conversations", conv, F.col("conv_id"), F.col("turn"), "text"),
                  ("benchmark", bench, F.col("item_id"), zero, "text")],
        sense_pos=SENSE_POS, sense_neg=SENSE_NEG)


QUERIES = {
    "scan_sentences": q_scan_sentences,
    "overwrite_outputs": q_overwrite_outputs,
    "line_index": q_line_index,
    "parse_lines": q_parse_lines,
    "parse_lines_strip3": q_parse_lines_strip3,
    "encode_labelled_text": q_encode_labelled_text,
    "label_counts": q_label_counts,
    "split_train_test": q_split_train_test,
    "labelled_only": q_labelled_only,
    "tokenize": q_tokenize,
    "ngrams_n1": q_ngrams_n1,
    "ngrams_n2": q_ngrams_n2,
    "ngrams_n3": q_ngrams_n3,
    "ngram_doc_freq": q_ngram_doc_freq,
    "ngram_class_counts": q_ngram_class_counts,
    "info_gain": q_info_gain,
    "select_vocab": q_select_vocab,
    "select_vocab_n2": q_select_vocab_n2,
    "vocab_semi_filter": q_vocab_semi_filter,
    "featurize": q_featurize,
    "featurize_n2": q_featurize_n2,
    "gradient_step": q_gradient_step,
    "gradient_norm": q_gradient_norm,
    "train_weights_3ep": q_train_weights_3ep,
    "model_table": q_model_table,
    "model_roundtrip": q_model_roundtrip,
    "score_sentences": q_score_sentences,
    "predict_proba": q_predict_proba,
    "threshold_label": q_threshold_label,
    "accuracy": q_accuracy,
    "score_batch": q_score_batch,
    "score_batch_joined": q_score_batch_joined,
    "model_table_full": q_model_table_full,
    "score_batch_full": q_score_batch_full,
    "accuracy_full": q_accuracy_full,
    "self_train_round1": q_self_train_round1,
    "self_train_round1_n2": q_self_train_round1_n2,
    "self_train_round2": q_self_train_round2,
    "selftrain_output_lines": q_selftrain_output_lines,
    "self_train": q_self_train,
    "search_grid": q_search_grid,
    "search_grid_full": q_search_grid_full,
    "search_round1": q_search_round1,
    "best_config": q_best_config,
    "best_config_round1": q_best_config_round1,
    "corpus_union": q_corpus_union,
    "keyword_filter": q_keyword_filter,
    "seed_by_marker": q_seed_by_marker,
    "build_corpus": q_build_corpus,
}
