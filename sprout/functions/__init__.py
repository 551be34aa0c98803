"""Column-level building blocks (pure expressions, JVM-side)."""

from .text import TOKEN_PATTERN, WORD_PATTERN, ngrams, tokenize, words
from .stats import binary_target, information_gain, sigmoid, sign_marker, threshold_cut
from .lookup import HashedLookup, collect_lookup, weight_array

__all__ = [
    "TOKEN_PATTERN", "WORD_PATTERN", "ngrams", "tokenize", "words",
    "binary_target", "information_gain", "sigmoid", "sign_marker", "threshold_cut",
    "HashedLookup", "collect_lookup", "weight_array",
]
