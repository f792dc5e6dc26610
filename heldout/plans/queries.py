"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

The scope is a proposal made for this repository (see README): preparing
tables for a classifier, fitting it and measuring it on held-out rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heldout.functions import document_features, is_train
from heldout.operators.bins import quantile_bin_column
from heldout.operators.centroid import fit_centroids
from heldout.operators.crossval import kfold_predictions
from heldout.operators.encode import apply_index, frequency_index, one_hot_counts
from heldout.operators.impute import impute_group_median
from heldout.operators.metrics import confusion_metrics, roc_auc
from heldout.operators.models import MODEL_KINDS, holdout_auc, text_feature_table
from heldout.operators.naive_bayes import fit_gaussian_nb
from heldout.operators.profile import class_balance, column_profile, correlations
from heldout.operators.quantiles import exact_quantiles
from heldout.operators.scale import scale_columns
from heldout.session import materialize
from heldout.sources import labelled_documents, read_table

NB_FEATURES = ("log_chars", "n_words")


def labelled_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, log_chars, n_words, quality, toxic, is_train for labelled docs.

    Features are computed from whole texts before the join, so only numbers
    are shuffled; the result is stored so fitting and scoring read the texts
    once.
    """
    table = labelled_documents(spark, sf_dir, feature_builder=document_features)
    return materialize(table.withColumn("is_train", is_train("doc_id")))


def _nb_scored_test(spark: SparkSession, sf_dir: str, target: str = "quality",
                    table: DataFrame | None = None) -> DataFrame:
    table = labelled_feature_table(spark, sf_dir) if table is None else table
    model = fit_gaussian_nb(table.where("is_train"), target, NB_FEATURES)
    return model.transform(table.where(~F.col("is_train"))).withColumn("score", model.log_odds(1, 0))


def nb_quality_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaussian naive Bayes for ``quality`` from (log length, word count):
    fit on the training part, score the held-out part, count
    (actual, predicted) pairs."""
    scored = _nb_scored_test(spark, sf_dir)
    return scored.groupBy(
        F.col("quality").alias("actual"), F.col("prediction").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def nb_quality_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts and ratios of the naive Bayes held-out predictions."""
    return confusion_metrics(_nb_scored_test(spark, sf_dir), "quality", "prediction").drop("n_skipped")


def nb_quality_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact ROC area of the naive Bayes log-odds on the held-out part."""
    return roc_auc(_nb_scored_test(spark, sf_dir), "quality", "score").drop("n_skipped")


def lineitem_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column profile of all columns of lineitem."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    profile = column_profile(lineitem, lineitem.columns)
    return profile.withColumn("mean", F.round("mean", 9)).withColumn("stddev", F.round("stddev", 9))


def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and share per (quality, toxic) label pair."""
    return class_balance(read_table(spark, sf_dir, "labels", ["quality", "toxic"]),
                         ["quality", "toxic"])


def acctbal_median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative account balances count as missing; fill each with the exact
    median balance of the customer's market segment."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    with_missing = cust.select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
    )
    filled = impute_group_median(with_missing, ["c_mktsegment"], "acctbal", "acctbal_filled")
    return filled.select("c_custkey", "c_mktsegment",
                         F.round("acctbal_filled", 6).alias("acctbal_filled"), "was_missing")


def segment_acctbal_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of account balance per market segment."""
    cust = read_table(spark, sf_dir, "customer", ["c_mktsegment", "c_acctbal"])
    q = exact_quantiles(cust, "c_acctbal", [0.25, 0.5, 0.75], ["c_mktsegment"])
    return q.select("c_mktsegment", "prob", F.round("value", 6).alias("value"))


def part_type_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of part types by frequency (0 = most parts), ties by name."""
    part = read_table(spark, sf_dir, "part", ["p_type"])
    return frequency_index(part, "p_type", "type_index")


def event_type_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the frequency index of its event type (0 = most
    frequent type), fitted on the events table and joined back to its rows."""
    events = read_table(spark, sf_dir, "events", ["event_id", "event_type"])
    index = frequency_index(events, "event_type", "type_index")
    return apply_index(events, "event_type", index, "type_index").select(
        "event_id", "event_type", "type_index")


def event_type_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, one column per event type holding the user's event count."""
    events = read_table(spark, sf_dir, "events", ["user_id", "event_type"])
    return one_hot_counts(events, "user_id", "event_type")


def order_price_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min-max and z-score scaled order totals."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return scale_columns(orders, ["o_totalprice"], ["o_orderkey"]).withColumn(
        "o_totalprice_z", F.round("o_totalprice_z", 6))


def order_price_quartile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders binned by exact quartiles of total price: rows, min, max per bin."""
    orders = read_table(spark, sf_dir, "orders", ["o_totalprice"])
    binned = quantile_bin_column(orders, "o_totalprice", [0.25, 0.5, 0.75], "price_bin")
    return binned.groupBy("price_bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_totalprice").alias("min_price"),
        F.max("o_totalprice").alias("max_price"),
    )


def document_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents per md5 split part and quality class."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id"]).join(
        read_table(spark, sf_dir, "labels", ["doc_id", "quality"]), "doc_id")
    part = F.when(is_train("doc_id"), F.lit("train")).otherwise(F.lit("test"))
    return docs.groupBy(part.alias("part"), "quality").agg(F.count(F.lit(1)).alias("n"))


def lineitem_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlations of chosen lineitem column pairs."""
    pairs = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"),
             ("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")]
    cols = sorted({c for p in pairs for c in p})
    return correlations(read_table(spark, sf_dir, "lineitem", cols), pairs).withColumn("corr", F.round("corr", 9))


def embedding_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest class centroid on embeddings: fit on the md5 training part,
    predict each held-out vector."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    emb = emb.withColumn("is_train", is_train("vec_id"))
    model = fit_centroids(emb.where("is_train"), "embedding", "label")
    test = emb.where(~F.col("is_train"))
    return model.transform(test).select(
        "vec_id", F.col("label").alias("actual"), F.col("prediction").alias("predicted"))


def nb_quality_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold naive Bayes on all labelled documents: confusion counts, ratios
    and exact ROC area per fold."""
    table = labelled_feature_table(spark, sf_dir)
    preds = materialize(kfold_predictions(table, "doc_id", "quality", NB_FEATURES, k=5))
    confusion = confusion_metrics(preds, "quality", "prediction", group_cols=["fold"]).drop("n_skipped")
    auc = roc_auc(preds, "quality", "score", group_cols=["fold"]).select("fold", "auc")
    # Both sides have one row per fold.
    return confusion.join(F.broadcast(auc), "fold", "left")


def text_models_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression, decision tree, random forest and boosted trees on
    hashed text plus length features; held-out ROC area for quality and toxic."""
    return holdout_auc(text_feature_table(spark, sf_dir), MODEL_KINDS, ["quality", "toxic"])


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out ROC area of every model for quality, side by side with naive
    Bayes."""
    table = text_feature_table(spark, sf_dir)
    nb = roc_auc(_nb_scored_test(spark, sf_dir, table=table), "quality", "score").select(
        F.lit("gaussian_naive_bayes").alias("model"), F.lit("quality").alias("target"),
        (F.col("n_pos") + F.col("n_neg")).alias("n_test"), "n_pos", "n_neg", "auc")
    ml = holdout_auc(table, MODEL_KINDS, ["quality"])
    return nb.unionByName(ml)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lineitem_profile": lineitem_profile,
    "label_balance": label_balance,
    "acctbal_median_impute": acctbal_median_impute,
    "segment_acctbal_quartiles": segment_acctbal_quartiles,
    "part_type_index": part_type_index,
    "event_type_indexed": event_type_indexed,
    "event_type_one_hot": event_type_one_hot,
    "order_price_scaled": order_price_scaled,
    "order_price_quartile_bins": order_price_quartile_bins,
    "document_split_counts": document_split_counts,
    "lineitem_correlations": lineitem_correlations,
    "nb_quality_holdout": nb_quality_holdout,
    "embedding_nearest_centroid": embedding_nearest_centroid,
    "text_models_auc": text_models_auc,
    "nb_quality_confusion": nb_quality_confusion,
    "nb_quality_auc": nb_quality_auc,
    "nb_quality_kfold": nb_quality_kfold,
    "model_comparison": model_comparison,
}
