"""Fill missing values with the median of the row's group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.operators.quantiles import exact_quantiles


def group_medians(df: DataFrame, group_cols: Sequence[str], value_col: str,
                  **quantile_opts) -> DataFrame:
    """``group_cols + [median]`` over the non-null values of each group.

    The result is a join of two small stored tables (per-group counts
    and the values at the needed ranks), so it needs no cut of its own.
    """
    q = exact_quantiles(df, value_col, [0.5], group_cols, **quantile_opts)
    return q.select(*group_cols, F.col("value").alias("median"))


def impute_group_median(df: DataFrame, group_cols: Sequence[str], value_col: str,
                        out_col: str | None = None, **quantile_opts) -> DataFrame:
    """Add ``out_col`` (value, or the group median where the value is null)
    and ``was_missing``.

    The medians table has one row per group; Spark broadcasts it only when its
    measured bytes are small, otherwise the join shuffles and AQE splits hot
    groups.  A group with no non-null value keeps nulls, and so do rows whose
    group key is NULL (the join uses SQL equality).
    """
    out_col = out_col or f"{value_col}_filled"
    medians = group_medians(df, group_cols, value_col, **quantile_opts)
    joined = df.join(medians, list(group_cols), "left")
    return joined.select(
        *df.columns,
        F.coalesce(F.col(value_col).cast("double"), F.col("median")).alias(out_col),
        F.col(value_col).isNull().alias("was_missing"),
    )
