"""sprout: seed-and-grow text labelling on Spark DataFrames.

Tokenize, rank N-grams by information gain, featurize, train logistic
weights by full-batch steps, and grow labels from seeds round by round.
"""

from . import defaults
from .plans import load_model, score_batch, self_train, train_model
from .plans.modes import search_mode, test_mode, train_mode
from .plans.search import best_config, search
from .session import build_session, ensure_checkpoint_dir

__all__ = [
    "build_session", "ensure_checkpoint_dir", "defaults",
    "self_train", "train_model", "score_batch", "load_model", "search", "best_config",
    "train_mode", "search_mode", "test_mode",
]
