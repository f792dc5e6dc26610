"""Table summaries: column profile, class balance, correlations.

Each is an aggregation with partial (map-side) aggregation; the small result
is then reshaped to one row per column / class / pair.  Nothing is rounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _rows_from_wide(wide: DataFrame, entries: list[list]) -> DataFrame:
    """Turn the one-row ``wide`` frame into one row per entry."""
    return wide.select(F.inline(F.array(*[F.struct(*cols) for cols in entries])))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_distinct`` for each column, from one scan.

    A single aggregation of ``count_distinct`` per column: Spark expands each
    row once per column, dedups (column, value) pairs map-side before the
    shuffle and counts them per column afterwards.  Kept apart from the other
    statistics, whose buffers would otherwise ride along on every expanded row.
    """
    wide = df.agg(*[F.count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)])
    return _rows_from_wide(wide, [
        [F.lit(c).alias("column_name"), F.col(f"d{i}").cast("long").alias("n_distinct")]
        for i, c in enumerate(columns)])


def _unordered(kind: T.DataType) -> bool:
    """Whether a type, or one inside it, can be neither ordered nor grouped."""
    if isinstance(kind, T.ArrayType):
        return _unordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_unordered(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def column_profile(df: DataFrame, columns: Sequence[str],
                   approx_distinct_rsd: float | None = None) -> DataFrame:
    """One row per column: n, n_null, n_distinct, min, max, mean, stddev.

    Counts, distinct counts, extremes are those of the column's own type.  The
    extremes share one result column: it has the columns' type if they have
    one in common, else they are cast to strings.  Mean (``avg``) and sample
    deviation are doubles, null for columns that are not numbers.  NaN is a
    value: it is counted, is the greatest, and makes mean and deviation NaN.
    Values of types without an order or a grouping (maps, variants, and what
    holds them) are profiled by their JSON text, so equal maps whose entries
    are in another order count as different.

    Plain statistics come from one aggregation pass; exact distinct counts
    from a second (see ``distinct_counts``), and the two results, one row per
    column each, are joined.  With ``approx_distinct_rsd`` set, distinct counts
    are HyperLogLog++ estimates with that relative standard deviation, taken in
    the first pass.  Their state is a few kilobytes per column however large
    the table, so there is no second pass and no shuffle of distinct values.
    """
    df = df.select(*[F.to_json(F.col(c)).alias(c) if _unordered(df.schema[c].dataType) else F.col(c) for c in columns])
    kinds = {c: df.schema[c].dataType for c in columns}
    shown = next(iter(kinds.values())) if len(set(kinds.values())) == 1 else T.StringType()
    aggs, entries = [], []
    for i, c in enumerate(columns):
        x = F.col(c)
        number = isinstance(kinds[c], T.NumericType)
        aggs += [F.count(x).alias(f"n{i}"), (F.count(F.lit(1)) - F.count(x)).alias(f"null{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
                 (F.avg(x).cast("double") if number else F.first(F.lit(None).cast("double"))).alias(f"mean{i}"),
                 (F.stddev_samp(x) if number else F.first(F.lit(None).cast("double"))).alias(f"std{i}")]
        row = [F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"null{i}").alias("n_null"),
               F.col(f"min{i}").cast(shown).alias("min_value"), F.col(f"max{i}").cast(shown).alias("max_value"),
               F.col(f"mean{i}").alias("mean"), F.col(f"std{i}").alias("stddev")]
        if approx_distinct_rsd is not None:
            aggs.append(F.approx_count_distinct(x, approx_distinct_rsd).alias(f"d{i}"))
            row.append(F.col(f"d{i}").alias("n_distinct"))
        entries.append(row)
    stats = _rows_from_wide(df.agg(*aggs), entries)
    if approx_distinct_rsd is None:
        # Both sides have one row per profiled column.
        stats = stats.join(F.broadcast(distinct_counts(df, columns)), "column_name")
    return stats.select("column_name", "n", "n_null", "n_distinct", "min_value", "max_value", "mean", "stddev")


def class_balance(df: DataFrame, label_cols: Sequence[str]) -> DataFrame:
    """Rows and share of rows per combination of label values; the total is
    one number."""
    total = df.count()
    return df.groupBy(*label_cols).agg(F.count(F.lit(1)).alias("n")).select(
        *label_cols, "n", (F.col("n") / F.lit(float(total))).alias("share"))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation for each column pair, in one pass."""
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                    for i, (a, b) in enumerate(pairs)])
    return _rows_from_wide(wide, [[F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr")]
                                  for i, (a, b) in enumerate(pairs)])
