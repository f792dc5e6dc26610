"""Stored tables: shared folder, few files, early deletion."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from heldout.session import ensure_checkpoint_dir, materialize, release


def _files(df):
    return [f for f in os.listdir(df._stored_at.removeprefix("file:")) if f.endswith(".parquet")]


def test_materialize_cuts_lineage_and_keeps_no_cache(spark):
    df = (spark.read.parquet(f"{SF001}/orders.parquet")
          .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))
    cut = materialize(df)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "heldout-" in plan
    assert sorted(cut.collect()) == sorted(df.collect())
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_small_tables_are_a_few_files_at_many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        cut = materialize(spark.range(1000).groupBy((F.col("id") % 5).alias("k")).count())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(_files(cut)) <= 5 and cut.count() == 5


def test_release_deletes_the_files(spark):
    cut = materialize(spark.range(3))
    assert _files(cut)
    release(cut, spark.range(1), None)
    assert not os.path.exists(cut._stored_at.removeprefix("file:"))


def test_empty_frames_keep_their_schema(spark):
    cut = materialize(spark.createDataFrame([], "a long, b array<string>"))
    assert cut.count() == 0 and cut.dtypes == [("a", "bigint"), ("b", "array<string>")]


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder and folder == spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_a_cluster_needs_a_shared_folder(master):
    class Context:
        def __init__(self):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="checkpoint"):
        ensure_checkpoint_dir(Session())
