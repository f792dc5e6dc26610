"""Column functions agree with plain Python on every document."""

import hashlib
import re

from pyspark.sql import functions as F

from conftest import SF001
from heldout.functions import fold_of, is_train, line_count, log_length, word_count


def test_text_features_match_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", "text", "n_chars",
        word_count("text").alias("w"), line_count("text").alias("l"),
        log_length("n_chars").alias("ll"))
    import math

    for r in docs.collect():
        assert r["w"] == len(re.findall(r"[^ \t\r\n]+", r["text"]))
        assert r["l"] == r["text"].count("\n") + 1
        assert abs(r["ll"] - math.log(r["n_chars"] + 1)) < 1e-12


def test_split_and_folds_match_md5(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select(
        "doc_id", is_train("doc_id").alias("t"), fold_of("doc_id", 5).alias("f"))
    rows = labels.collect()
    for r in rows:
        digest = hashlib.md5(str(r["doc_id"]).encode()).hexdigest()
        assert r["t"] == (digest[:2] < "cc")
        assert r["f"] == int(digest[2:17], 16) % 5
    share = sum(r["t"] for r in rows) / len(rows)
    assert 0.7 < share < 0.9
    assert {r["f"] for r in rows} == set(range(5))


def test_folds_are_even_for_many_folds(spark):
    sizes = [r["count"] for r in spark.range(90_000).groupBy(fold_of("id", 300).alias("f")).count().collect()]
    assert len(sizes) == 300 and min(sizes) > 200 and max(sizes) < 400


def test_folds_and_split_are_independent(spark):
    rows = spark.range(20_000).groupBy(fold_of("id", 4).alias("f")).agg(F.avg(is_train("id").cast("int")).alias("t")).collect()
    assert all(0.76 < r["t"] < 0.84 for r in rows)
