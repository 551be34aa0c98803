"""Readers and writers: fixture tables, labelled lines, models, corpora."""

from .fixtures import read_table, sentences, split_train_test, materialize
from .lines import encode_labelled, parse_lines, read_labelled_lines, write_labelled_lines
from .models import read_legacy_model, read_model, write_legacy_model, write_model
from .corpus import build_corpus, corpus_lines, keyword_filter, seed_by_marker

__all__ = [
    "read_table", "sentences", "split_train_test", "materialize",
    "encode_labelled", "parse_lines", "read_labelled_lines", "write_labelled_lines",
    "read_legacy_model", "read_model", "write_legacy_model", "write_model",
    "build_corpus", "corpus_lines", "keyword_filter", "seed_by_marker",
]
