"""Score arriving documents with a model fitted in batch.

A fitted model here is a set of column expressions, so scoring is a stateless
projection and runs on a streaming DataFrame unchanged: no state store, no
watermark.  Progress is kept in a checkpoint folder under the session's
shared ``spark.checkpoint.dir``, so a restarted query resumes where it
stopped and a lost executor only repeats its own micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from heldout.functions import document_features
from heldout.operators.naive_bayes import GaussianNBModel
from heldout.session import ensure_checkpoint_dir

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def document_stream(spark: SparkSession, directory: str, file_glob: str = "*.parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Documents arriving as Parquet files in ``directory``."""
    reader = (spark.readStream.schema(DOCUMENT_SCHEMA)
              .option("pathGlobFilter", file_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(directory)


def score_document_stream(spark: SparkSession, documents: DataFrame, model: GaussianNBModel,
                          output_dir: str, query_name: str) -> StreamingQuery:
    """Append ``doc_id, log_chars, n_words, prediction`` for every arriving
    document to Parquet files in ``output_dir``; runs until the input present
    at start is processed (``availableNow``)."""
    checkpoint_root = ensure_checkpoint_dir(spark).rstrip("/")
    scored = model.transform(document_features(documents))
    return (
        scored.writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", f"{checkpoint_root}/streams/{query_name}")
        .queryName(query_name)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
