"""A document stream scored by a batch-fitted model gives the batch answer."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from heldout.functions import document_features
from heldout.operators.naive_bayes import fit_gaussian_nb
from heldout.plans.queries import NB_FEATURES, labelled_feature_table
from heldout.streaming import document_stream, score_document_stream


def test_stream_scoring_matches_batch(spark):
    table = labelled_feature_table(spark, SF001)
    model = fit_gaussian_nb(table.where("is_train"), "quality", NB_FEATURES)

    out_dir = tempfile.mkdtemp(prefix="heldout-stream-out-", dir="/tmp")
    stream = document_stream(spark, SF001, file_glob="documents.parquet")
    query = score_document_stream(spark, stream, model, out_dir, "score_docs_test")
    query.awaitTermination(300)
    assert query.exception() is None

    streamed = spark.read.parquet(out_dir).select("doc_id", "prediction")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    batch = model.transform(document_features(docs)).select("doc_id", "prediction")
    assert streamed.count() == docs.count()
    diff = streamed.exceptAll(batch).count() + batch.exceptAll(streamed).count()
    assert diff == 0
    assert streamed.where(F.col("prediction").isNull()).count() == 0


def test_restarted_stream_resumes_from_its_checkpoint(spark):
    table = labelled_feature_table(spark, SF001)
    model = fit_gaussian_nb(table.where("is_train"), "quality", NB_FEATURES)
    out_dir = tempfile.mkdtemp(prefix="heldout-stream-out-", dir="/tmp")
    for _ in range(2):
        stream = document_stream(spark, SF001, file_glob="documents.parquet")
        query = score_document_stream(spark, stream, model, out_dir, "score_docs_restart")
        query.awaitTermination(300)
        assert query.exception() is None
    # The second run found every input file already committed: no duplicates.
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert spark.read.parquet(out_dir).count() == docs.count()
