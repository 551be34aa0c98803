"""Multi-job plans driven from the driver: training, self-training, search."""

from .train import TrainResult, train_model, train_weights
from .selftrain import SelfTrainResult, label_chain, self_train, self_train_sentences
from .batch import load_model, score_batch

__all__ = [
    "TrainResult", "train_model", "train_weights",
    "SelfTrainResult", "label_chain", "self_train", "self_train_sentences",
    "load_model", "score_batch",
]
