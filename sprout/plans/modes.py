"""The three end-to-end runs: train, search and test, from files to files.

Input is the labelled-line text format (one sentence per line ending in
``+``, ``-`` or ``0``); ids are line positions, so every 5th labelled line is
held out. ``train_mode`` writes the grown labels as lines and the model as
Parquet (plus the legacy ``(ngram,weight)`` text form on request);
``search_mode`` returns every configuration's accuracy and the best one;
``test_mode`` scores a table of texts with a saved model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import defaults
from ..sources.fixtures import split_train_test
from ..sources.lines import read_labelled_lines, write_labelled_lines
from ..sources.models import read_legacy_model, read_model, write_legacy_model, write_model
from .batch import score_batch
from .search import best_config, search
from .selftrain import SelfTrainResult, self_train


def train_mode(spark: SparkSession, input_path: str, output_path: str, model_path: str,
               n: int = defaults.N, m: int = defaults.M, n_iter: int = defaults.NUM_ITER,
               threshold: float = defaults.THRESHOLD, alpha: float = defaults.ALPHA,
               delta: float = defaults.DELTA, legacy_model_path: str | None = None,
               strip_chars: int = 1, refresh_vocab: bool = True) -> SelfTrainResult:
    """Self-train on labelled lines; write labelled lines and the model."""
    sents = read_labelled_lines(spark, input_path, strip_chars=strip_chars, index=True)
    train, test = split_train_test(sents)
    result = self_train(train, test, n=n, m=m, n_iter=n_iter, threshold=threshold,
                        alpha=alpha, delta=delta, refresh_vocab=refresh_vocab)
    write_labelled_lines(result.labelled_text(), output_path)
    frame = result.model_frame(spark)
    write_model(frame, model_path)
    if legacy_model_path:
        write_legacy_model(frame, legacy_model_path)
    return result


def search_mode(spark: SparkSession, input_path: str, strip_chars: int = 1,
                **ranges) -> tuple[DataFrame, DataFrame]:
    """(all configurations, best configuration); ranges are (start, end, step)."""
    sents = read_labelled_lines(spark, input_path, strip_chars=strip_chars, index=True)
    train, test = split_train_test(sents)
    results = search(train, test, **ranges).cache()
    return results, best_config(results)


def test_mode(spark: SparkSession, model_path: str, texts: DataFrame, keys, text: str = "text",
              legacy: bool = False) -> DataFrame:
    """(keys..., score, label '+'/'-') for every row of ``texts``."""
    model = read_legacy_model(spark, model_path) if legacy else read_model(spark, model_path)
    return score_batch(texts, model, keys, text=text)
