"""Results do not depend on how many partitions the shuffles use."""

import pytest

from heldout.plans import QUERIES
from conftest import SF001

NAMES = ["part_type_index", "segment_acctbal_quartiles", "nb_quality_auc", "nb_quality_kfold",
         "order_price_quartile_bins"]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_for_any_shuffle_partition_count(spark, name):
    query = QUERIES[name]
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "5", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = query(spark, SF001)
            results.append(sorted(tuple(r) for r in df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
