"""Held-out classification metrics as aggregations.

``confusion_metrics`` is one partially aggregated pass.  ``roc_auc`` is exact
(tied scores share credit, the Mann-Whitney form): it first reduces the rows to
one row per distinct score with positive and negative counts, then needs the
number of negatives below each score, a global running total computed by
``running_totals`` without putting all scores in one task.

One rule holds for both: a row counts if it has a label and a prediction (or
score).  Rows that lack either are counted in ``n_skipped`` and nowhere else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heldout.operators.ranking import running_totals
from heldout.session import materialize


def _safe_div(num: Column, den: Column) -> Column:
    """num / den, null where den is 0 (no ANSI error)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def confusion_metrics(df: DataFrame, label_col: str, prediction_col: str,
                      positive=1, group_cols: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn, n, n_skipped, accuracy, precision, recall, f1, mcc.

    Ratios with a zero denominator are null.  They are quotients of exact
    integer counts, so they are not rounded.
    """
    actual = F.col(label_col) == F.lit(positive)
    predicted = F.col(prediction_col) == F.lit(positive)

    def count_if(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    counts = df.groupBy(*group_cols).agg(
        count_if(actual & predicted).alias("tp"),
        count_if(~actual & predicted).alias("fp"),
        count_if(~actual & ~predicted).alias("tn"),
        count_if(actual & ~predicted).alias("fn"),
        count_if(F.col(label_col).isNull() | F.col(prediction_col).isNull()).alias("n_skipped"),
    )
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    mcc = _safe_div(tp * tn - fp * fn,
                    F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    return counts.select(
        *group_cols, "tp", "fp", "tn", "fn", n.cast("long").alias("n"), "n_skipped",
        _safe_div(tp + tn, n).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        mcc.alias("mcc"),
    )


def score_counts(df: DataFrame, label_col: str, score_col: str, positive=1,
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per group and distinct score: positives, negatives and rows
    skipped for want of a label; the row of the null score has those skipped
    for want of a score."""
    is_pos = F.col(label_col) == F.lit(positive)
    counts = F.col(label_col).isNotNull() & F.col(score_col).isNotNull()
    return df.groupBy(
        *group_cols, F.col(score_col).cast("double").alias("score")
    ).agg(
        F.count(F.when(counts & is_pos, 1)).alias("pos"),
        F.count(F.when(counts & ~is_pos, 1)).alias("neg"),
        F.count(F.when(~counts, 1)).alias("skipped"),
    )


def roc_auc(df: DataFrame, label_col: str, score_col: str, positive=1,
            group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Per group (or overall): n_pos, n_neg, n_skipped, auc.

    Exact; a tied (positive, negative) pair counts one half.  The negatives
    below each score are a running total in (group, score) order over all
    groups at once, so a group with most of the rows is still spread over
    many range partitions; each group's starting total (one row per group)
    is then subtracted.
    """
    group_cols = list(group_cols)
    per_score = score_counts(df, label_col, score_col, positive, group_cols)
    order = [F.col(g).asc() for g in group_cols] + [F.col("score").asc()]
    with_below = running_totals(per_score, order, ["neg"], num_partitions)
    if group_cols:
        # Join on one struct key: structs with null fields compare equal, so a
        # NULL group keeps its rows.
        with_below = with_below.withColumn("_gk", F.struct(*group_cols))
        starts = materialize(with_below.groupBy("_gk").agg(
            F.min("neg_before").alias("_start")))
        with_below = with_below.join(starts, "_gk").withColumn(
            "neg_before", F.col("neg_before") - F.col("_start"))
    credit = F.col("pos").cast("double") * (
        F.col("neg_before").cast("double") + F.col("neg").cast("double") / 2.0)
    totals = with_below.groupBy(*group_cols).agg(
        F.sum("pos").cast("long").alias("n_pos"),
        F.sum("neg").cast("long").alias("n_neg"),
        F.sum("skipped").cast("long").alias("n_skipped"),
        F.sum(credit).alias("_credit"),
    )
    return totals.select(
        *group_cols, "n_pos", "n_neg", "n_skipped",
        _safe_div(F.col("_credit"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double")).alias("auc"),
    )
