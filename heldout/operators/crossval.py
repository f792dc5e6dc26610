"""K-fold evaluation of Gaussian naive Bayes in one aggregation pass.

Per (fold, class) the pass collects the row count, and the mean and population
variance of each feature (Spark's numerically stable aggregates).  The
training statistics of fold ``f`` merge the other folds' statistics with the
pairwise formula of Chan, Golub and LeVeque (no difference of large sums), so
all ``k`` models come from one ``k x classes`` row table instead of ``k``
separate fits.  Every row is then scored by its own fold's model, expressed as
a ``CASE`` over folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heldout.functions import fold_of
from heldout.operators.naive_bayes import (
    MAX_CLASSES, VAR_SMOOTHING, GaussianNBModel, class_statistics, model_from_statistics,
)


def merge_moments(parts: Sequence[tuple[int, float, float]]) -> tuple[int, float, float]:
    """Combine (count, mean, population variance) of disjoint row sets."""
    n, mean, m2 = 0, 0.0, 0.0
    for nb, mean_b, var_b in parts:
        if nb == 0:
            continue
        total = n + nb
        delta = mean_b - mean
        mean += delta * nb / total
        m2 += var_b * nb + delta * delta * n * nb / total
        n = total
    return n, mean, (m2 / n if n else 0.0)


def fold_models(rows, k: int, label_col: str, features: Sequence[str],
                var_smoothing: float = VAR_SMOOTHING) -> dict[int, GaussianNBModel]:
    classes = sorted({r[label_col] for r in rows})
    models = {}
    for f in range(k):
        train_rows = []
        for c in classes:
            part = sorted((r for r in rows if r[label_col] == c and r["fold"] != f),
                          key=lambda r: r["fold"])
            n = sum(r["n"] for r in part)
            if n == 0:
                continue
            stats = {label_col: c, "n": n}
            for feat in features:
                _, mean, var = merge_moments(
                    [(r["n"], r[f"mean_{feat}"], r[f"var_{feat}"]) for r in part])
                stats[f"mean_{feat}"] = mean
                stats[f"var_{feat}"] = var
            train_rows.append(stats)
        if train_rows:
            models[f] = model_from_statistics(train_rows, label_col, features, var_smoothing)
    return models


def kfold_predictions(df: DataFrame, id_col: str, label_col: str,
                      features: Sequence[str], k: int = 5,
                      max_classes: int = MAX_CLASSES) -> DataFrame:
    """``df`` plus ``fold`` and ``prediction`` (by the model not trained on
    the row's fold) and ``score``, that model's log odds of class 1 over class
    0 (null if the other folds lack either)."""
    with_fold = df.withColumn("fold", fold_of(id_col, k))
    stats = class_statistics(with_fold.where(F.col(label_col).isNotNull()), label_col, features, ["fold"])
    rows = stats.limit(k * max_classes + 1).collect()
    if len(rows) > k * max_classes:
        raise ValueError(f"more than {max_classes} classes in {label_col!r}")
    models = fold_models(rows, k, label_col, features)
    pred: Column = F.lit(None)
    score: Column = F.lit(None).cast("double")
    for f, model in sorted(models.items()):
        pred = F.when(F.col("fold") == F.lit(f), model.predict()).otherwise(pred)
        score = F.when(F.col("fold") == F.lit(f), model.log_odds(1, 0)).otherwise(score)
    return with_fold.withColumn("prediction", pred).withColumn("score", score)
