"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.session import materialize, release


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest vertex around u."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a")
    return (tied.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (id, label): the smallest id of its component, for every id that
    has an edge and is not itself the smallest.

    ``edges`` has long columns a, b; order, repeats and loops do not matter.
    Alternating large and small stars halve the distance to the smallest id
    each round, so there are about log(n) rounds; each is two pre-aggregated
    groupings and two joins, whose hot ids AQE splits, and is stored.  Only a
    count and a checksum reach the driver.
    """
    current = materialize(edges.where("a is not null and b is not null and a <> b")
                          .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .distinct())
    sign = None
    while True:
        now = current.agg(F.count(F.lit(1)).alias("n"),
                          F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not now["n"] or (now["n"], now["s"]) == sign:
            return current.select(F.col("a").alias("id"), F.col("b").alias("label"))
        sign = (now["n"], now["s"])
        stored = materialize(_small_star(_large_star(current)))
        release(current)
        current = stored
