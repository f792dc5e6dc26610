"""Repeatable row assignment to train/test and to folds.

Both read only the row's own id, so they run inside the scan's stage, need no
shuffle and give the same answer on any partitioning or re-execution.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A row is in the training part when the first two hex digits
# of md5(id as text) sort below "cc" (204 of 256 values, about 80 %).
TRAIN_PREFIX_BELOW = "cc"


def _md5_of(id_col: str | Column) -> Column:
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(col.cast("string"))


def is_train(id_col: str | Column) -> Column:
    return F.substring(_md5_of(id_col), 1, 2) < F.lit(TRAIN_PREFIX_BELOW)


def fold_of(id_col: str | Column, k: int) -> Column:
    """Fold number 0..k-1 from 15 hex digits of md5(id), the third and on, so
    that folds are even for any k and independent of the train/test split."""
    if k < 2:
        raise ValueError("k must be at least 2")
    number = F.conv(F.substring(_md5_of(id_col), 3, 15), 16, 10).cast("long")
    return F.pmod(number, F.lit(k)).cast("int")
