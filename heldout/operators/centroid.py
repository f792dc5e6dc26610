"""Nearest class centroid for array-valued features.

Centroids come from Spark ML's ``Summarizer.mean`` grouped by class: a
partially aggregated vector sum, so no row is exploded per dimension.  The
model (classes x dimensions) is checked in size, kept on the driver and
broadcast; scoring is a matrix product over Arrow batches, in the scan's stage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heldout.session import materialize, ship

# Limits of a model's size unless the caller says otherwise (the
# values are doubles on the driver and in each Python worker).
MAX_CLASSES = 10_000
MAX_MODEL_VALUES = 20_000_000


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Place of the nearest centroid of each vector; ties go to the first.

    The matrix product settles all but near ties, which are compared by the
    sum of squared differences itself.
    """
    square = (centroids ** 2).sum(axis=1)
    out = np.empty(len(vectors), dtype=np.int64)
    for start in range(0, len(vectors), 256):
        part = vectors[start:start + 256]
        far = square[None, :] - 2 * (part @ centroids.T)
        best = far.min(axis=1)
        doubt = 1e-9 * (1 + square.max() + (part ** 2).sum(axis=1))
        close = far <= (best + doubt)[:, None]
        out[start:start + 256] = far.argmin(axis=1)
        for i in np.flatnonzero(close.sum(axis=1) > 1):
            at = np.flatnonzero(close[i])
            out[start + i] = at[((part[i] - centroids[at]) ** 2).sum(axis=1).argmin()]
    return out


@dataclass(frozen=True)
class CentroidModel:
    feature_col: str
    classes: tuple
    centroids: np.ndarray

    def transform(self, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
        """Adds the class of the nearest centroid; ties go to the smallest
        class.  A null vector, one of another length, or one with a null or NaN
        entry has none (null)."""
        spark = df.sparkSession
        ship(spark)
        sent = spark.sparkContext.broadcast(self.centroids)

        @F.pandas_udf("int")
        def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            centroids = sent.value
            for vectors in batches:
                out = np.zeros(len(vectors), dtype=np.int32)
                rows = [i for i, v in enumerate(vectors) if v is not None and len(v) == centroids.shape[1]]
                if rows and len(centroids):
                    found = np.array([np.asarray(vectors.iloc[i], dtype=float) for i in rows])
                    sound = ~np.isnan(found).any(axis=1)
                    out[np.array(rows)[sound]] = nearest(found[sound], centroids) + 1
                yield pd.Series(out)

        names: Column = F.array(*[F.lit(c) for c in self.classes])
        at = place(F.col(self.feature_col))  # from 1; 0 for none
        return df.withColumn(prediction_col, F.when(at > 0, F.element_at(names, F.greatest(at, F.lit(1)))))


def fit_centroids(df: DataFrame, feature_col: str, label_col: str,
                  max_classes: int = MAX_CLASSES, max_values: int = MAX_MODEL_VALUES) -> CentroidModel:
    """Mean vector of each class, over the rows that have a label and a sound
    vector: of the length that most have (the greater of equally frequent ones), with
    no null or NaN entry.  More classes or values than the limits are an error."""
    vector = F.col(feature_col)
    known = df.where(F.col(label_col).isNotNull() & vector.isNotNull()
                     & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)))
    # one row a length; only the most frequent one reaches the driver
    most = (known.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max(F.struct("n", "size")).alias("top")).first()["top"])
    means = materialize(
        known.where(F.size(vector) == F.lit(most["size"] if most else 0))
        .groupBy(label_col)
        .agg(Summarizer.mean(array_to_vector(F.col(feature_col))).alias("_mean"))
        .select(label_col, vector_to_array("_mean").alias("_mean"))
    )
    # Check the model's size on the cluster before any of it reaches the driver.
    size = means.agg(F.count(F.lit(1)).alias("k"),
                     F.sum(F.size("_mean")).alias("values")).first()
    if size["k"] > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label_col!r}")
    if (size["values"] or 0) > max_values:
        raise ValueError(f"more than {max_values} centroid values")
    rows = sorted(means.collect(), key=lambda r: r[label_col])
    return CentroidModel(feature_col, tuple(r[label_col] for r in rows),
                         np.array([r["_mean"] for r in rows], dtype=float) if rows else np.zeros((0, 0)))
