"""Spark ML fits have no SQL oracle: check held-out ROC area against chance
and against the naive Bayes baseline (never training accuracy)."""

import pytest

from conftest import SF001
import __spark_entry__ as entry_mod


@pytest.fixture(scope="module")
def text_aucs(spark):
    rows = entry_mod.queries()["text_models_auc"](spark, SF001).collect()
    return {(r["model"], r["target"]): r for r in rows}


def test_all_models_and_targets_present(text_aucs):
    assert len(text_aucs) == 8
    for r in text_aucs.values():
        assert r["n_test"] == r["n_pos"] + r["n_neg"] > 0


def test_logistic_regression_beats_chance_clearly(text_aucs):
    assert text_aucs[("logistic_regression", "quality")]["auc"] > 0.85


def test_trees_learn_quality(text_aucs):
    for kind in ("decision_tree", "random_forest", "gradient_boosted_trees"):
        assert text_aucs[(kind, "quality")]["auc"] > 0.6, kind


def test_model_comparison_includes_baseline(spark):
    rows = entry_mod.queries()["model_comparison"](spark, SF001).collect()
    models = {r["model"]: r["auc"] for r in rows}
    assert "gaussian_naive_bayes" in models and len(rows) == 5
    assert models["logistic_regression"] > models["gaussian_naive_bayes"]


def test_toxic_is_learned(text_aucs):
    assert text_aucs[("logistic_regression", "toxic")]["auc"] > 0.6


def test_area_does_not_depend_on_partitions(spark, text_aucs):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        rows = entry_mod.queries()["text_models_auc"](spark, SF001).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for r in rows:
        assert r["auc"] == pytest.approx(text_aucs[(r["model"], r["target"])]["auc"], abs=0.02)


def test_grouped_auc_equals_spark_ml_evaluator_on_model_scores(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from heldout.operators.metrics import roc_auc
    from heldout.operators.models import _estimator, text_feature_table

    table = text_feature_table(spark, SF001)
    for target in ("quality", "toxic"):
        train = table.where("is_train").withColumn("label", F.col(target).cast("double"))
        model = _estimator("logistic_regression", "label").fit(train)
        scored = model.transform(table.where("not is_train")).select(
            F.col(target).cast("double").alias("label"),
            vector_to_array("probability")[1].alias("score"))
        ours = roc_auc(scored, "label", "score", positive=1.0).first()["auc"]
        theirs = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="label", numBins=0).evaluate(scored)
        assert ours == pytest.approx(theirs, abs=1e-12), target


def test_training_rows_are_fitted_in_partitions_of_a_bounded_size(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from heldout.operators import models

    rows = [(i, Vectors.dense([float(i % 7), float(i % 2)]), i % 2, i % 5 != 0) for i in range(500)]
    table = spark.createDataFrame(rows, ["doc_id", "features", "quality", "is_train"]).coalesce(1)
    real, seen = models._estimator, []

    class Watched:
        def __init__(self, kind, label):
            self.real = real(kind, label)

        def fit(self, frame):
            seen.append(frame.rdd.glom().map(len).collect())
            return self.real.fit(frame)

    monkeypatch.setattr(models, "_estimator", Watched)
    monkeypatch.setattr(models, "TRAIN_ROWS", 60, raising=False)
    found = models.holdout_auc(table, ["logistic_regression"], ["quality"]).collect()
    assert sum(seen[0]) == 400 and len(seen[0]) == 7 and max(seen[0]) <= 60
    assert [(r["n_test"], r["auc"]) for r in found] == [(100, 1.0)]
    # partitions that are small enough, and tables without rows, stay as they are
    small = table.repartition(10)
    assert models.evenly(small, 60) is small
    none = table.limit(0)
    assert models.evenly(none, 60) is none
