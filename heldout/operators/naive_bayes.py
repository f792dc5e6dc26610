"""Gaussian naive Bayes: fit by one grouped aggregation, score by expressions.

Fitting is a ``groupBy(label)`` with ``count``, ``avg`` and ``var_pop`` per
feature; partial aggregation pre-combines every task's rows, so a class with a
third of all rows costs no more than any other.  The fitted model has one row
per class, is checked against ``max_classes`` and is kept on the driver like
any Spark ML model.  Scoring turns it into literal column expressions: no
join, no shuffle, whole-stage code generation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Variance smoothing adds this share of the largest feature
# variance (over all training rows) to every class variance.
VAR_SMOOTHING = 1e-9
# Scoring inlines classes x features constants into the plan, so the model
# size has limits; both are parameters of ``fit_gaussian_nb``.
MAX_CLASSES = 1_000
MAX_MODEL_VALUES = 100_000


@dataclass(frozen=True)
class GaussianNBModel:
    features: tuple[str, ...]
    classes: tuple
    log_priors: tuple[float, ...]
    means: tuple[tuple[float, ...], ...]
    variances: tuple[tuple[float, ...], ...]

    def joint_log_likelihood(self, k: int) -> Column:
        """log P(class k) + sum_j log N(x_j; mean_kj, var_kj); null where a
        feature is null or NaN."""
        const = self.log_priors[k] - 0.5 * sum(
            math.log(2.0 * math.pi * v) for v in self.variances[k])
        expr = F.lit(const)
        for j, feat in enumerate(self.features):
            x = F.col(feat).cast("double")
            diff = F.when(~F.isnan(x), x) - F.lit(self.means[k][j])
            expr = expr - diff * diff / F.lit(2.0 * self.variances[k][j])
        return expr

    def predict(self) -> Column:
        """Class with the largest likelihood; ties go to the smallest class.
        Null where a feature is null or NaN."""
        known = self.joint_log_likelihood(0).isNotNull()
        if len(self.classes) == 1:
            return F.when(known, F.lit(self.classes[0]))
        best = F.greatest(*[
            F.struct(self.joint_log_likelihood(k).alias("s"),
                     F.lit(-k).alias("neg_k"), F.lit(c).alias("c"))
            for k, c in enumerate(self.classes)
        ])
        return F.when(known, best.getField("c"))

    def log_odds(self, positive, negative) -> Column:
        """Log posterior odds of ``positive`` over ``negative``; null where a
        feature is missing, or where either class was not in the training rows."""
        if positive not in self.classes or negative not in self.classes:
            return F.lit(None).cast("double")
        kp = self.classes.index(positive)
        kn = self.classes.index(negative)
        return self.joint_log_likelihood(kp) - self.joint_log_likelihood(kn)

    def transform(self, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
        return df.withColumn(prediction_col, self.predict())


def class_statistics(df: DataFrame, label_col: str, features: Sequence[str],
                     by: Sequence[str] = ()) -> DataFrame:
    """One row per class (within each value of ``by``): count, mean and
    population variance per feature.  Rows with a missing feature are left out."""
    for feat in features:
        df = df.where(F.col(feat).isNotNull() & ~F.isnan(F.col(feat).cast("double")))
    aggs = [F.count(F.lit(1)).alias("n")]
    for feat in features:
        x = F.col(feat).cast("double")
        aggs += [F.avg(x).alias(f"mean_{feat}"), F.var_pop(x).alias(f"var_{feat}")]
    return df.groupBy(*by, label_col).agg(*aggs)


def model_from_statistics(rows, label_col: str, features: Sequence[str],
                          var_smoothing: float = VAR_SMOOTHING) -> GaussianNBModel:
    """Build the model from class rows holding n, mean_* and var_*."""
    rows = sorted(rows, key=lambda r: r[label_col])
    total = sum(r["n"] for r in rows)
    # Variance of each feature over all rows, by the law of total variance.
    overall = []
    for feat in features:
        grand = sum(r["n"] * r[f"mean_{feat}"] for r in rows) / total
        overall.append(sum(
            r["n"] * (r[f"var_{feat}"] + (r[f"mean_{feat}"] - grand) ** 2) for r in rows
        ) / total)
    eps = var_smoothing * max(overall)
    if any(r[f"var_{f}"] + eps <= 0.0 for r in rows for f in features):
        raise ValueError("every feature is constant within a class and overall; "
                         "Gaussian naive Bayes needs some variance")
    return GaussianNBModel(
        features=tuple(features),
        classes=tuple(r[label_col] for r in rows),
        log_priors=tuple(math.log(r["n"] / total) for r in rows),
        means=tuple(tuple(r[f"mean_{f}"] for f in features) for r in rows),
        variances=tuple(tuple(r[f"var_{f}"] + eps for f in features) for r in rows),
    )


def fit_gaussian_nb(df: DataFrame, label_col: str, features: Sequence[str],
                    var_smoothing: float = VAR_SMOOTHING,
                    max_classes: int = MAX_CLASSES,
                    max_values: int = MAX_MODEL_VALUES) -> GaussianNBModel:
    """Fit on the rows that have a label and all features.  More classes than
    ``max_classes`` or constants than ``max_values`` are an error."""
    stats = class_statistics(df.where(F.col(label_col).isNotNull()), label_col, features)
    rows = stats.limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label_col!r}")
    if not rows:
        raise ValueError("no training rows")
    if len(rows) * len(features) * 2 > max_values:
        raise ValueError("model too large to score as column expressions")
    return model_from_statistics(rows, label_col, features, var_smoothing)
