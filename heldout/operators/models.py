"""Spark ML classifiers on document text, measured by held-out ROC area.

Text becomes hashed term counts (``RegexTokenizer`` + ``HashingTF``) before
the documents meet the labels, so only sparse vectors are shuffled.  The
fits are Spark ML's own distributed estimators; the model sizes are bounded
by the hashed feature count, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import HashingTF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.functions import is_train, line_count, log_length
from heldout.operators.metrics import roc_auc
from heldout.sources import labelled_documents
from heldout.session import materialize

# Tokens split on runs of space, tab, CR and newline, lower-cased;
# 2048 hashed term-count features; 20 iterations; regularisation 0.05.
TOKEN_SPLIT = "[ \\t\\r\\n]+"
NUM_TEXT_FEATURES = 2048
MAX_ITER = 20
REG_PARAM = 0.05
SEED = 7
#: Most training rows of a partition.  The tree fits hold a bin number of each feature
#: of each row, so a row takes many times its stored size (24 KB are read a row).
TRAIN_ROWS = 5_000


def text_features(docs: DataFrame, num_features: int = NUM_TEXT_FEATURES) -> DataFrame:
    """doc_id, one vector (hashed lower-cased term counts of the whole text,
    log length, word count, line count), and log_chars and n_words on their
    own.  The text is split once; its words are counted from the tokens."""
    tokens = RegexTokenizer(inputCol="text", outputCol="tokens", pattern=TOKEN_SPLIT,
                            toLowercase=True).transform(docs)
    hashed = HashingTF(inputCol="tokens", outputCol="terms",
                       numFeatures=num_features).transform(tokens)
    numeric = hashed.select(
        "doc_id", "terms",
        log_length("n_chars").alias("log_chars"),
        F.size("tokens").cast("double").alias("n_words"),
        line_count("text").cast("double").alias("n_lines"),
    )
    return VectorAssembler(
        inputCols=["terms", "log_chars", "n_words", "n_lines"], outputCol="features"
    ).transform(numeric).select("doc_id", "features", "log_chars", "n_words")


def text_feature_table(spark, sf_dir: str, num_features: int = NUM_TEXT_FEATURES) -> DataFrame:
    """doc_id, features, log_chars, n_words, quality, toxic, is_train for
    labelled documents; stored, so every fit reads vectors instead of texts."""
    table = labelled_documents(
        spark, sf_dir, feature_builder=lambda raw: text_features(raw, num_features))
    return materialize(table.withColumn("is_train", is_train("doc_id")))


def _estimator(kind: str, label: str):
    common = dict(featuresCol="features", labelCol=label)
    if kind == "logistic_regression":
        return LogisticRegression(maxIter=MAX_ITER, regParam=REG_PARAM, **common)
    if kind == "decision_tree":
        return DecisionTreeClassifier(maxDepth=5, seed=SEED, **common)
    if kind == "random_forest":
        return RandomForestClassifier(numTrees=20, maxDepth=5, seed=SEED, **common)
    if kind == "gradient_boosted_trees":
        return GBTClassifier(maxIter=MAX_ITER, maxDepth=3, seed=SEED, **common)
    raise ValueError(f"unknown model {kind!r}")


MODEL_KINDS = ("logistic_regression", "decision_tree", "random_forest",
               "gradient_boosted_trees")


def evenly(df: DataFrame, most: int) -> DataFrame:
    """``df`` as it is if no partition has more than ``most`` rows, else dealt out
    over as many partitions as that takes.  Files are split by their bytes, which
    tell little of what a row of sparse vectors takes in a fit."""
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    return df if (largest or 0) <= most else df.repartition(math.ceil(total / most))


def holdout_auc(table: DataFrame, kinds: Sequence[str], targets: Sequence[str],
                parallelism: int = 4) -> DataFrame:
    """One row per (model, target): held-out rows, positives, negatives and
    exact ROC area of the positive-class probability.

    The (model, target) fits are independent, so up to ``parallelism`` of them
    are submitted at once from driver threads, as Spark ML's
    ``CrossValidator(parallelism=...)`` does; they share one persisted copy of
    the training vectors, in partitions of about ``TRAIN_ROWS`` rows at most.  The held-out rows are read once: each fitted model
    adds its score to the same row, and the scores of all models and targets
    are measured by one grouped ROC pass.
    """
    train = evenly(table.where("is_train").select("features", *[
        F.col(t).cast("double").alias(f"label_{t}") for t in targets]), TRAIN_ROWS).persist()

    def fit(task):
        kind, target = task
        return _estimator(kind, f"label_{target}").fit(train)

    tasks = [(kind, target) for target in targets for kind in kinds]
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = list(pool.map(fit, tasks))
    finally:
        train.unpersist()
    scored = table.where(~F.col("is_train")).select("features", *targets)
    for i, model in enumerate(fitted):
        scored = (model.setRawPredictionCol(f"raw_{i}").setProbabilityCol(f"probability_{i}")
                  .setPredictionCol(f"prediction_{i}").transform(scored).drop(f"raw_{i}", f"prediction_{i}"))
    each = [F.struct(F.lit(kind).alias("model"), F.lit(target).alias("target"), F.col(target).alias("actual"),
                     vector_to_array(f"probability_{i}")[1].alias("score"))
            for i, (kind, target) in enumerate(tasks)]
    auc = roc_auc(scored.select(F.inline(F.array(*each))), "actual", "score", group_cols=["model", "target"])
    return auc.select("model", "target", (F.col("n_pos") + F.col("n_neg")).alias("n_test"),
                      "n_pos", "n_neg", "auc")
