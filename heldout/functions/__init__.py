from heldout.functions.hashing import fold_of, is_train
from heldout.functions.text import document_features, line_count, log_length, word_count

__all__ = [
    "document_features", "fold_of", "is_train", "line_count", "log_length",
    "word_count",
]
