"""Metrics agree with Spark ML's evaluators and with direct counting."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF001
from heldout.operators.metrics import confusion_metrics, roc_auc
from heldout.plans.queries import _nb_scored_test


def test_auc_equals_spark_ml_exact_evaluator(spark):
    scored = _nb_scored_test(spark, SF001)
    ours = roc_auc(scored, "quality", "score").first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC", numBins=0)
    theirs = ev.evaluate(scored.withColumn("label", F.col("quality").cast("double")))
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_auc_with_ties_counts_half(spark):
    # Scores with only a few distinct values force many ties.
    scored = _nb_scored_test(spark, SF001).withColumn("coarse", F.round("score", 0))
    ours = roc_auc(scored, "quality", "coarse", num_partitions=3).first()["auc"]
    pdf = scored.select("quality", "coarse").toPandas()
    pos = pdf[pdf.quality == 1].coarse.to_numpy()
    neg = pdf[pdf.quality != 1].coarse.to_numpy()
    wins = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos)
    assert ours == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_confusion_counts(spark):
    scored = _nb_scored_test(spark, SF001)
    row = confusion_metrics(scored, "quality", "prediction").first()
    pdf = scored.select("quality", "prediction").toPandas()
    assert row["tp"] == int(((pdf.quality == 1) & (pdf.prediction == 1)).sum())
    assert row["tn"] == int(((pdf.quality != 1) & (pdf.prediction != 1)).sum())
    assert row["n"] == len(pdf)


def test_grouped_auc_with_hot_group_matches_pairs(spark):
    scored = _nb_scored_test(spark, SF001).withColumn(
        "g", F.when(F.col("doc_id") % 3 == 0, F.lit("rest")).otherwise(F.lit("hot"))
    ).withColumn("coarse", F.round("score", 1))
    got = {r["g"]: r["auc"] for r in
           roc_auc(scored, "quality", "coarse", group_cols=["g"], num_partitions=5).collect()}
    pdf = scored.select("g", "quality", "coarse").toPandas()
    for g, part in pdf.groupby("g"):
        pos = part[part.quality == 1].coarse.to_numpy()
        neg = part[part.quality != 1].coarse.to_numpy()
        wins = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos)
        assert got[g] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_merged_moments_equal_direct_statistics():
    import numpy as np

    from heldout.operators.crossval import merge_moments

    rng = np.random.default_rng(3)
    chunks = [1e9 + rng.normal(0, 1e-3, size=n) for n in (5, 17, 1, 40)]
    n, mean, var = merge_moments([(len(c), c.mean(), c.var()) for c in chunks])
    allv = np.concatenate(chunks)
    assert n == len(allv)
    assert mean == pytest.approx(allv.mean(), rel=1e-15)
    assert var == pytest.approx(allv.var(), rel=1e-6)


def test_grouped_auc_keeps_null_group(spark):
    scored = _nb_scored_test(spark, SF001).withColumn(
        "g", F.when(F.col("doc_id") % 2 == 0, F.lit("even")))
    got = {r["g"]: r["auc"] for r in roc_auc(scored, "quality", "score", group_cols=["g"]).collect()}
    assert set(got) == {None, "even"}
    pdf = scored.select("g", "quality", "score").toPandas()
    for g, part in pdf.groupby("g", dropna=False):
        key = None if not isinstance(g, str) else g
        pos = part[part.quality == 1].score.to_numpy()
        neg = part[part.quality != 1].score.to_numpy()
        wins = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos)
        assert got[key] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_auc_with_billions_of_each_class(spark, ansi, monkeypatch):
    from heldout.operators import metrics

    n = 4_000_000_000
    table = spark.createDataFrame([(0.1, n // 2, n, 0), (0.9, n // 2, 0, 0)], "score double, pos long, neg long, skipped long")
    monkeypatch.setattr(metrics, "score_counts", lambda *a, **k: table)
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = metrics.roc_auc(spark.range(1), "label", "score").first()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert (row["n_pos"], row["n_neg"]) == (n, n) and row["auc"] == pytest.approx(0.75)


def test_missing_labels_and_scores_are_skipped_alike(spark):
    rows = [(1, 1, 0.9), (0, 0, 0.1), (None, 1, 0.5), (1, None, None), (0, 1, 0.3)]
    frame = spark.createDataFrame(rows, "label int, prediction int, score double")
    c = confusion_metrics(frame, "label", "prediction").first()
    a = roc_auc(frame, "label", "score").first()
    assert (c["n"], c["n_skipped"]) == (3, 2)
    assert (a["n_pos"], a["n_neg"], a["n_skipped"], a["auc"]) == (1, 2, 2, 1.0)


def test_missing_features_have_no_class(spark):
    from heldout.operators.centroid import fit_centroids
    from heldout.operators.naive_bayes import fit_gaussian_nb

    nan = float("nan")
    train = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 8.0), (1, 9.0), (1, None)], "y int, x double")
    model = fit_gaussian_nb(train, "y", ["x"])
    got = model.transform(spark.createDataFrame([(1.5,), (8.5,), (None,), (nan,)], "x double")).collect()
    assert [r["prediction"] for r in got] == [0, 1, None, None]
    vectors = spark.createDataFrame([(0, [0.0, 1.0]), (1, [1.0, 0.0])], "y int, v array<double>")
    asked = spark.createDataFrame([([0.1, 0.9],), (None,), ([1.0],), ([1.0, 0.0, 0.0],), ([nan, 0.0],), ([0.5, 0.5],)], "v array<double>")
    got = fit_centroids(vectors, "v", "y").transform(asked).collect()
    assert [r["prediction"] for r in got] == [0, None, None, None, None, 0]


def test_bins_of_missing_values_and_of_an_empty_table(spark):
    from heldout.operators.bins import quantile_bin_column

    frame = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,), (float("nan"),)], "x double")
    assert [r["b"] for r in quantile_bin_column(frame, "x", [0.5], "b").collect()] == [0, 0, 1, None, None]
    assert quantile_bin_column(frame.limit(0), "x", [0.5], "b").collect() == []


def test_a_fold_with_one_class_has_no_score(spark):
    from heldout.operators.crossval import kfold_predictions

    frame = spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("y"), (F.col("id") * 1.5).alias("x"))
    got = kfold_predictions(frame, "k", "y", ["x"], k=3)
    assert got.where("score is not null").count() == 0 and got.where("prediction = 1").count() == 40
    assert roc_auc(got, "y", "score").first()["n_skipped"] == 40


def test_a_large_centroid_model(spark):
    import numpy as np

    from heldout.operators.centroid import CentroidModel

    draw = np.random.default_rng(2)
    centroids = draw.normal(size=(1000, 768))
    rows = [(i, (centroids[i * 37 % 1000] + 0.01).tolist()) for i in range(50)]
    got = CentroidModel("v", tuple(range(1000)), centroids).transform(
        spark.createDataFrame(rows, "i long, v array<double>")).collect()
    assert [r["prediction"] for r in got] == [i * 37 % 1000 for i in range(50)]
