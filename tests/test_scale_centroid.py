"""Rules for odd values in scaling and in class centroids."""

import math

import pytest
from pyspark.sql import functions as F

from heldout.operators.centroid import fit_centroids
from heldout.operators.scale import scale_columns


def test_nan_and_null_are_left_out_of_the_fit(spark):
    frame = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, float("nan")), (4, None), (5, 2.0)], "k int, x double")
    got = {r["k"]: (r["x_minmax"], r["x_z"]) for r in scale_columns(frame, ["x"], ["k"]).collect()}
    assert got[1] == (0.0, -1.0) and got[2] == (1.0, 1.0) and got[5] == (0.5, 0.0) and got[4] == (None, None)
    assert all(math.isnan(v) for v in got[3])


def test_centroids_are_fitted_on_sound_vectors(spark):
    rows = [("a", [1.0, 1.0]), ("a", [3.0, 1.0]), ("a", [1.0, None]), ("a", [1.0]), ("b", [9.0, 9.0]), ("b", [float("nan"), 0.0]), ("b", None), (None, [5.0, 5.0]),
            ("c", [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "label string, v array<double>")
    model = fit_centroids(frame, "v", "label")
    assert model.classes == ("a", "b") and model.centroids.tolist() == [[2.0, 1.0], [9.0, 9.0]]
    got = [r["prediction"] for r in model.transform(frame).collect()]
    assert got[:2] == ["a", "a"] and got[2:4] == [None, None] and got[4] == "b" and got[5:7] == [None, None] and got[8] is None
    assert fit_centroids(frame.limit(0), "v", "label").classes == ()


def test_a_bound_on_classes_raises(spark):
    frame = spark.range(5).select(F.col("id").alias("label"), F.array(F.lit(1.0)).alias("v"))
    with pytest.raises(ValueError):
        fit_centroids(frame, "v", "label", max_classes=4)
