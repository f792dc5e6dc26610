"""Exact quantiles: the narrowing rounds agree with numpy's linear quantile."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, executed_plans
from heldout.operators.quantiles import exact_quantiles


def _numpy_quantiles(pdf, group, value, probs):
    out = {}
    for key, part in pdf.groupby(group):
        vals = part[value].dropna().to_numpy(dtype=float)
        for p in probs:
            out[(key, p)] = float(np.quantile(vals, p))
    return out


@pytest.mark.parametrize("steps,finish", [(4, 1), (4, 7), (16, 50), (1000, 100_000)])
def test_grouped_quantiles_through_narrowing(spark, steps, finish):
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    cust = spark.read.parquet(f"{SF001}/customer.parquet").select("c_mktsegment", "c_acctbal")
    got = exact_quantiles(cust, "c_acctbal", probs, ["c_mktsegment"], steps=steps,
                          finish_rows=finish).collect()
    want = _numpy_quantiles(cust.toPandas(), "c_mktsegment", "c_acctbal", probs)
    assert len(got) == len(want)
    for r in got:
        assert r["value"] == pytest.approx(want[(r["c_mktsegment"], r["prob"])], abs=1e-9)


def test_many_ties_and_a_hot_group(spark):
    # Integer quantities repeat a lot; one group holds about a third of all rows.
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select(
        F.when(F.col("l_linenumber") <= 2, F.lit("hot"))
        .otherwise(F.col("l_returnflag")).alias("g"),
        "l_quantity",
    )
    probs = [0.25, 0.5, 0.75, 0.999]
    got = exact_quantiles(li, "l_quantity", probs, ["g"], steps=5, finish_rows=5).collect()
    want = _numpy_quantiles(li.toPandas(), "g", "l_quantity", probs)
    assert len(got) == len(want)
    for r in got:
        assert r["value"] == pytest.approx(want[(r["g"], r["prob"])], abs=1e-9)


def test_global_quantiles_ignore_nulls(spark):
    orders = spark.read.parquet(f"{SF001}/orders.parquet").select(
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"))
    probs = [0.33, 0.5]
    got = {r["prob"]: r["value"] for r in
           exact_quantiles(orders, "price", probs, steps=8, finish_rows=20).collect()}
    vals = orders.toPandas()["price"].dropna().to_numpy(dtype=float)
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)


def test_hot_group_is_spread_when_joins_shuffle(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").repartition(16).select(
        F.when(F.col("l_linenumber") <= 2, F.lit("hot"))
        .otherwise(F.col("l_returnflag")).alias("g"),
        "l_extendedprice",
    )
    probs = [0.5, 0.9]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with executed_plans(spark) as plans:
            got = exact_quantiles(li, "l_extendedprice", probs, ["g"], steps=8,
                                  finish_rows=200, salts=8).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = _numpy_quantiles(li.toPandas(), "g", "l_extendedprice", probs)
    assert len(got) == len(want)
    for r in got:
        assert r["value"] == pytest.approx(want[(r["g"], r["prob"])], abs=1e-9)
    # the data meets the intervals by group and salt, and is combined before it is
    # dealt by group
    salted = [p for p in plans if "percentile_approx" in p]
    assert salted
    for plan in salted:
        assert re.search(r"hashpartitioning\(_qkey#\d+, _salt#\d+", plan)
        assert "partial_percentile_approx" in plan


def test_rounds_do_not_depend_on_the_spread_of_values(spark):
    base = spark.range(40_000).withColumn("u", (F.col("id") * 7919 % 40_000).cast("double") / 40_000)
    counts = []
    for x in (F.col("u"), F.pow(F.lit(10.0), F.col("u") * 18 - 9)):
        with executed_plans(spark) as plans:
            got = exact_quantiles(base.select(x.alias("x")), "x", [0.5, 0.99], steps=50, finish_rows=100).collect()
        counts.append(sum("percentile_approx" in p for p in plans))
        assert {r["prob"] for r in got} == {0.5, 0.99}
    assert counts[0] == counts[1] > 0


def test_infinities_and_nan_are_values(spark):
    inf = float("inf")
    rows = [(float(i),) for i in range(200)] + [(inf,), (-inf,)]
    got = {r["prob"]: r["value"] for r in exact_quantiles(
        spark.createDataFrame(rows, "x double"), "x", [0.0, 0.5, 0.25, 1.0], steps=4, finish_rows=5).collect()}
    assert got[0.0] == -inf and got[1.0] == inf and got[0.5] == 99.5
    frame = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(frame, "x", [0.0, 0.5, 1.0]).collect()}
    assert got[0.0] == 1.0 and got[0.5] == 2.0 and np.isnan(got[1.0])


def test_null_group_key_is_kept(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select(
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("g"), "l_discount")
    got = exact_quantiles(li, "l_discount", [0.5], ["g"], steps=4, finish_rows=50).collect()
    pdf = li.toPandas()
    want = {k: float(np.quantile(v["l_discount"].to_numpy(dtype=float), 0.5))
            for k, v in pdf.groupby("g", dropna=False)}
    got_map = {r["g"]: r["value"] for r in got}
    assert None in got_map and len(got_map) == len(want)
    for k, v in want.items():
        key = None if k is None or (isinstance(k, float) and np.isnan(k)) else k
        assert got_map[key] == pytest.approx(v, abs=1e-12)
