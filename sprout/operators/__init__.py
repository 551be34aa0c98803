"""DataFrame -> DataFrame operators."""

from .vocab import (Vocabulary, class_counts_with_totals, ngram_class_counts,
                    ngram_doc_freq, rank_vocab, select_vocab, tokenized)
from .features import explode_features, featurize, featurize_by_join
from .scoring import Model, accuracy, model_score, score_by_join, score_features
from .gradient import gradient, gradient_norm

__all__ = [
    "Vocabulary", "class_counts_with_totals", "ngram_class_counts", "ngram_doc_freq",
    "rank_vocab", "select_vocab", "tokenized",
    "explode_features", "featurize", "featurize_by_join",
    "Model", "accuracy", "model_score", "score_by_join", "score_features",
    "gradient", "gradient_norm",
]
