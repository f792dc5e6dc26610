"""Categorical encodings: frequency index and one-hot counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.operators.ranking import global_row_index
from heldout.session import materialize

# Fixed value: the largest number of distinct values turned into columns unless
# the caller says otherwise (the default of Spark's spark.sql.pivotMaxValues).
MAX_ONE_HOT_VALUES = 10_000


def frequency_index(df: DataFrame, col: str, index_col: str | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """``col, n, index``: 0 for the most frequent value, ties by value.

    Counting is a partially aggregated ``groupBy``; the ranking is a global
    row index over the count table computed without a single-task window, so
    a high-cardinality column works too.  The table is stored.
    """
    index_col = index_col or f"{col}_index"
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(
        F.count(F.lit(1)).alias("n"))
    ranked = global_row_index(counts, [F.col("n").desc(), F.col(col).asc()],
                              index_col, num_partitions)
    return materialize(ranked)


def apply_index(df: DataFrame, col: str, index: DataFrame, index_col: str) -> DataFrame:
    """Add ``index_col`` to every row (null for values not in the index)."""
    return df.join(index.select(col, index_col), col, "left")


def pivot_values(df: DataFrame, col: str, max_values: int = MAX_ONE_HOT_VALUES) -> list:
    """Sorted distinct values of ``col``; an error beyond ``max_values``."""
    rows = (df.select(col).where(F.col(col).isNotNull()).distinct()
            .limit(max_values + 1).collect())
    if len(rows) > max_values:
        raise ValueError(f"{col!r} has more than {max_values} values to one-hot encode")
    return sorted(r[0] for r in rows)


def _column_names(values: list, taken: str) -> list[str]:
    """A column name for each value: its text, with ``_2``, ``_3`` ... behind it if
    the key column or an earlier value has it, whatever the case."""
    used, out = {taken.lower()}, []
    for value in values:
        name, n = str(value), 1
        while name.lower() in used:
            n += 1
            name = f"{value}_{n}"
        used.add(name.lower())
        out.append(name)
    return out


def one_hot_counts(df: DataFrame, key_col: str, col: str,
                   max_values: int = MAX_ONE_HOT_VALUES) -> DataFrame:
    """One row per key, one column per value of ``col`` holding how many of
    the key's rows have that value (0 when none).

    A single grouped aggregation of conditional counts: one shuffle on the
    key, pre-combined, so a hot key is combined in every task.  Columns are
    in order of the values and named by their text; a name that the key column or
    an earlier value has already, in any case, gets ``_2``, ``_3`` and so on
    behind it.  Nulls of ``col`` have no column.  More than
    ``max_values`` values, a documented limit of the caller's choice, are an
    error, since each is a column of the result.
    """
    values = pivot_values(df, col, max_values)
    return df.groupBy(key_col).agg(*[
        F.count(F.when(F.col(col) == F.lit(v), 1)).alias(name)
        for v, name in zip(values, _column_names(values, key_col), strict=True)
    ]) if values else df.select(key_col).distinct()
