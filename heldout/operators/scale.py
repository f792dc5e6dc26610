"""Min-max and z-score scaling.

Fitting is one global aggregation that yields one row of statistics; like a
Spark ML scaler model it is kept on the driver, and applying it is a
projection with literal constants (no join, no shuffle).

Nulls and NaNs are left out of the fit; a null scales to null and a NaN to NaN.
Infinities are values like others: they make the statistics infinite or NaN.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScalerStats:
    minimum: float | None
    maximum: float | None
    mean: float | None
    stddev: float | None

    def min_max(self, x: Column) -> Column:
        """(x - min) / (max - min); null when max equals min."""
        if self.minimum is None or self.maximum is None or self.maximum == self.minimum:
            return F.lit(None).cast("double")
        return (x.cast("double") - F.lit(self.minimum)) / F.lit(self.maximum - self.minimum)

    def z_score(self, x: Column) -> Column:
        """(x - mean) / sample standard deviation; null when it is 0."""
        if self.mean is None or not self.stddev:
            return F.lit(None).cast("double")
        return (x.cast("double") - F.lit(self.mean)) / F.lit(self.stddev)


def fit_scalers(df: DataFrame, columns: Sequence[str]) -> dict[str, ScalerStats]:
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.min(x), F.max(x), F.avg(x), F.stddev_samp(x)]
    row = df.agg(*aggs).first()
    return {c: ScalerStats(*row[4 * i: 4 * i + 4]) for i, c in enumerate(columns)}


def scale_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus ``<c>_minmax`` and ``<c>_z`` for every column."""
    stats = fit_scalers(df, columns)
    out = [F.col(k) for k in keep]
    for c in columns:
        out += [
            stats[c].min_max(F.col(c)).alias(f"{c}_minmax"),
            stats[c].z_score(F.col(c)).alias(f"{c}_z"),
        ]
    return df.select(*out)
