"""Global running totals and row indexes agree with a single-machine cumsum."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from heldout.operators.ranking import global_row_index, running_totals


@pytest.mark.parametrize("parts", [1, 3, 8, 50])
def test_running_totals_match_cumsum(spark, parts):
    per_cust = (spark.read.parquet(f"{SF001}/orders.parquet")
                .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")))
    got = running_totals(per_cust, [F.col("o_custkey").asc()], ["n"], parts).toPandas()
    got = got.sort_values("o_custkey").reset_index(drop=True)
    expected = got["n"].cumsum() - got["n"]
    assert (got["n_before"] == expected).all()


def test_row_index_descending_with_tiebreak(spark):
    part = spark.read.parquet(f"{SF001}/part.parquet")
    counts = part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    got = global_row_index(counts, [F.col("n").desc(), F.col("p_brand").asc()], "i", 4).toPandas()
    want = counts.toPandas().sort_values(["n", "p_brand"], ascending=[False, True])
    want = want.reset_index(drop=True)
    got = got.sort_values("i").reset_index(drop=True)
    assert list(got["i"]) == list(range(len(want)))
    assert list(got["p_brand"]) == list(want["p_brand"])


def test_one_hot_matches_counting(spark):
    from heldout.operators import encode

    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select(
        "l_suppkey", F.col("l_linenumber").cast("string").alias("line"))
    got = {r["l_suppkey"]: r.asDict() for r in encode.one_hot_counts(li, "l_suppkey", "line").collect()}
    want = li.toPandas().groupby(["l_suppkey", "line"]).size()
    assert sum(sum(v for k, v in r.items() if k != "l_suppkey") for r in got.values()) == want.sum()
    assert all(got[k][line] == n for (k, line), n in want.items())


@pytest.mark.parametrize("kind", ["string", "double"])
def test_one_hot_with_many_dotted_values(spark, kind):
    from heldout.operators import encode

    frame = spark.range(1000).select((F.col("id") % 7).alias("k"), (
        F.concat(F.lit("v."), F.col("id") % 250) if kind == "string" else (F.col("id") % 250) / 4.0).alias("v"))
    got = encode.one_hot_counts(frame, "k", "v")
    assert len(got.columns) == 251
    assert sum(sum(r) - r[0] for r in got.collect()) == 1000


def test_apply_index_matches_frequency_order(spark):
    from heldout.operators.encode import apply_index, frequency_index

    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_orderkey", "l_returnflag")
    index = frequency_index(li, "l_returnflag", "flag_index", num_partitions=3)
    want = li.toPandas()["l_returnflag"].value_counts()
    want = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))
    expected = {flag: i for i, (flag, _) in enumerate(want)}
    rows = apply_index(li, "l_returnflag", index, "flag_index").collect()
    assert len(rows) == li.count()
    assert all(r["flag_index"] == expected[r["l_returnflag"]] for r in rows)


def test_profile_approx_distinct_close_to_exact(spark):
    from heldout.operators.profile import column_profile

    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select(*cols)
    exact = {r["column_name"]: r for r in column_profile(li, cols).collect()}
    approx = {r["column_name"]: r for r in
              column_profile(li, cols, approx_distinct_rsd=0.02).collect()}
    for c in cols:
        assert approx[c]["n_distinct"] == pytest.approx(exact[c]["n_distinct"], rel=0.08)
        assert approx[c]["mean"] == exact[c]["mean"] and approx[c]["n"] == exact[c]["n"]


def test_one_hot_names_that_clash_get_a_number(spark):
    from heldout.operators import encode

    rows = [("x", "a"), ("x", "A"), ("x", "k"), ("y", "a"), ("y", "a_2")]
    got = encode.one_hot_counts(spark.createDataFrame(rows, "K string, v string"), "K", "v")
    assert got.columns == ["K", "A", "a_2", "a_2_2", "k_2"]
    assert sorted(tuple(r) for r in got.select("K", "a", "A_2", "a_2_2", "k_2").collect()) == [("x", 1, 1, 0, 1), ("y", 0, 1, 1, 0)]
