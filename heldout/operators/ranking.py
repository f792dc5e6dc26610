"""Global running totals and ranks without a single-task window.

A window with no ``partitionBy`` moves every row into one task.  Here the rows
are range-partitioned on the order instead, each partition computes its own
running totals, and a table with one row per partition (bounded by the
partition count) supplies each partition's starting offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heldout.session import materialize

_PART = "_part"


def running_totals(df: DataFrame, order: Sequence[Column], sum_cols: Sequence[str],
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``<c>_before``: the sum of ``c`` over all rows earlier in ``order``.

    ``order`` must be unique per row (it is, for the aggregated tables this is
    used on), which makes the result independent of partitioning.  The
    range-partitioned rows are stored once, so the offsets and the rows always
    see the same partition assignment, also after a lost executor.  Without
    ``num_partitions`` AQE merges the partitions of a small table.
    """
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    parts = materialize(ranged.withColumn(_PART, F.spark_partition_id()))
    # Partition totals: one row per range partition.
    totals = parts.groupBy(_PART).agg(*[F.sum(c).alias(f"_{c}_t") for c in sum_cols])
    by_part = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _PART,
        *[F.coalesce(F.sum(f"_{c}_t").over(by_part), F.lit(0)).alias(f"_{c}_off")
          for c in sum_cols],
    )
    within = Window.partitionBy(_PART).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = parts.select(
        "*", *[F.sum(c).over(within).alias(f"_{c}_run") for c in sum_cols])
    out = ranked.join(offsets, _PART)
    return out.select(
        *df.columns,
        *[(F.col(f"_{c}_off") + F.col(f"_{c}_run") - F.col(c)).alias(f"{c}_before")
          for c in sum_cols],
    )


def global_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index",
                     num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (which must be unique)."""
    with_one = df.withColumn("_one", F.lit(1).cast("long"))
    return running_totals(with_one, order, ["_one"], num_partitions).select(
        *df.columns, F.col("_one_before").alias(name))
