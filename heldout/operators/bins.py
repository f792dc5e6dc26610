"""Quantile bins: exact cut points, then a comparison per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heldout.operators.quantiles import exact_quantiles


def quantile_cuts(df: DataFrame, col: str, probs: Sequence[float], **quantile_opts) -> list[float]:
    """Exact cut points for ``probs`` (one small row each, read by the driver)."""
    rows = exact_quantiles(df, col, probs, (), **quantile_opts).collect()
    by_prob = {r["prob"]: r["value"] for r in rows}
    return [by_prob.get(float(p)) for p in probs]


def bin_of(x: Column, cuts: Sequence[float | None]) -> Column:
    """Number of cut points strictly below ``x`` (0 .. len(cuts)).

    Null and NaN have no bin (null), and neither has any value where a cut
    point is missing (an empty table has none) or NaN.
    """
    if any(c is None or c != c for c in cuts):
        return F.lit(None).cast("int")
    expr = F.lit(0)
    for c in cuts:
        expr = expr + F.when(x > F.lit(c), 1).otherwise(0)
    return F.when(x.isNotNull() & ~F.isnan(x), expr).cast("int")


def quantile_bin_column(df: DataFrame, col: str, probs: Sequence[float],
                        out_col: str, **quantile_opts) -> DataFrame:
    """Adds the bin of ``col``; NaN values take no part in the cut points."""
    x = F.col(col).cast("double")
    cuts = quantile_cuts(df.where(~F.isnan(x)), col, probs, **quantile_opts)
    return df.withColumn(out_col, bin_of(F.col(col).cast("double"), cuts))
