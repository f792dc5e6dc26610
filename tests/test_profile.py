"""Column profiles keep each column's own values."""

import math

import pytest
from pyspark.sql import functions as F

from heldout.operators.profile import class_balance, column_profile, correlations


def _row(frame, column):
    return {r["column_name"]: r for r in column_profile(frame, frame.columns).collect()}[column]


def test_small_values_keep_their_mean_and_deviation(spark):
    r = _row(spark.range(1000).select((F.col("id") * 1e-10).alias("x")), "x")
    assert r["mean"] == pytest.approx(4.995e-08, rel=1e-12) and r["stddev"] > 0


def test_large_integers_stay_apart(spark):
    big = 2**53
    r = _row(spark.createDataFrame([(big,), (big + 1,), (big + 1,)], "x long"), "x")
    assert (r["n_distinct"], r["min_value"], r["max_value"]) == (2, big, big + 1)


def test_strings_nan_and_nulls(spark):
    frame = spark.createDataFrame([("a", 1.0), ("b", float("nan")), (None, None)], "s string, x double")
    s, x = _row(frame, "s"), _row(frame, "x")
    assert (s["n"], s["n_null"], s["n_distinct"], s["min_value"], s["max_value"], s["mean"]) == (2, 1, 2, "a", "b", None)
    assert x["n"] == 2 and math.isnan(x["mean"]) and x["max_value"] == "NaN"


def test_empty_table(spark):
    r = _row(spark.createDataFrame([], "x double"), "x")
    assert (r["n"], r["n_distinct"], r["mean"]) == (0, 0, None)
    assert class_balance(spark.createDataFrame([], "a int"), ["a"]).count() == 0


def test_dotted_column_names(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double")
    assert correlations(frame, [("a", "b")]).first()["corr"] == pytest.approx(-1.0)


def test_maps_are_profiled_by_their_text(spark):
    frame = spark.createDataFrame([({"a": 1}, [{"b": 2}]), ({"a": 1}, None), (None, [{}])], "m map<string,int>, l array<map<string,int>>")
    one, two = _row(frame, "m"), _row(frame, "l")
    assert (one["n"], one["n_null"], one["n_distinct"], one["min_value"], one["mean"]) == (2, 1, 1, '{"a":1}', None)
    assert (two["n"], two["n_distinct"]) == (2, 2)
