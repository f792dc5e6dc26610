"""Readers for the driver's Parquet tables.

Every reader selects only the columns a job asks for, so the Parquet scan's
``ReadSchema`` holds just those columns and filters reach ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


#: Most labelled ids that texts are filtered by before they are featurised.
FEW_LABELS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def labelled_documents(spark: SparkSession, sf_dir: str, feature_builder=None, few_labels: int = FEW_LABELS) -> DataFrame:
    """Documents that carry a label, joined on ``doc_id``.

    ``feature_builder`` maps the raw ``documents`` frame to ``doc_id`` plus
    feature columns *before* the join, so the join shuffles small per-document
    features instead of whole texts.  With up to ``few_labels`` labels (a few MB,
    which Spark broadcasts) texts without one are left out before that; beyond,
    all are featurised.  How the sides meet is left to Spark: a
    label table of few bytes is broadcast, a large one is shuffled (and AQE
    may still turn that join around from measured sizes).  ``doc_id`` is unique
    on both sides, so the join has no hot key.
    """
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    raw = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    if feature_builder and labels.count() <= few_labels:
        raw = raw.join(labels.select("doc_id"), "doc_id", "left_semi")
    docs = feature_builder(raw) if feature_builder else raw
    return docs.join(labels, "doc_id", "inner").select(
        "doc_id", *[c for c in docs.columns if c != "doc_id"],
        F.col("quality"), F.col("toxic"),
    )
