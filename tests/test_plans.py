"""The physical plans have the shape the README claims."""

from pyspark.sql import functions as F

from conftest import SF001, SF0001, executed_plans
from heldout.plans import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_naive_bayes_scoring_adds_no_join_or_udf(spark):
    plan = _plan(QUERIES["nb_quality_holdout"](spark, SF001))
    assert "Join" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # Only the final (actual, predicted) count shuffles.
    assert plan.count("Exchange") == 1


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["order_price_quartile_bins"](spark, SF001))
    assert "ReadSchema: struct<o_totalprice:double>" in plan
    plan = _plan(QUERIES["event_type_one_hot"](spark, SF001))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_one_hot_counts_shuffle_once(spark):
    plan = _plan(QUERIES["event_type_one_hot"](spark, SF001))
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan


def test_split_and_folds_need_no_shuffle(spark):
    from heldout.functions import fold_of, is_train

    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    df = labels.select("doc_id", is_train("doc_id").alias("t"), fold_of("doc_id", 5).alias("f"))
    assert "Exchange" not in _plan(df)


def test_no_global_window_over_input_rows(spark):
    # The rank used for the index runs per range partition; the only
    # partition-less window is over the per-partition totals table.
    plan = _plan(QUERIES["nb_quality_auc"](spark, SF001))
    assert "windowspecdefinition(_part" in plan


def test_no_executed_plan_has_a_cross_join_or_row_udf(spark):
    # every query that runs on the way counts, not only the last one
    for name, query in QUERIES.items():
        with executed_plans(spark) as plans:
            query(spark, SF0001).collect()
        assert plans, name
        for plan in plans:
            assert "CartesianProduct" not in plan, name
            assert "BroadcastNestedLoopJoin" not in plan, name
            assert "BatchEvalPython" not in plan and "InPandas" not in plan, name
            # the centroid model alone scores in Arrow batches
            assert "ArrowEvalPython" not in plan or name == "embedding_nearest_centroid", name


def test_models_read_texts_once(spark):
    for name in ("text_models_auc", "model_comparison"):
        with executed_plans(spark) as plans:
            QUERIES[name](spark, SF0001).collect()
        scans = sum(p.count("documents.parquet") > 0 for p in plans)
        assert scans == 1, name


def test_joins_carry_no_hint(spark):
    # sizes decide: no table is broadcast but by Spark's own threshold
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("acctbal_median_impute", "event_type_indexed", "nb_quality_auc"):
            with executed_plans(spark) as plans:
                QUERIES[name](spark, SF0001).collect()
            assert not any("BroadcastExchange" in p for p in plans), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
