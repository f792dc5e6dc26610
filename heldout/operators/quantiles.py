"""Exact quantiles (linear interpolation) without holding a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, so
a group with a third of a 100 TB table would not fit.  This operator finds the
values at the needed ranks by narrowing an interval of values around each:

1. count, min and max per group (partial aggregation, one scan);
2. while an interval still holds more than ``finish_rows`` rows, one scan takes
   ``percentile_approx`` cut points of its rows, at equal steps of rank, and
   one counts the rows below, at, between and above the two cuts around the
   rank.  The rank moves into the part that holds it.  Cuts go by rank, so the
   number of rounds does not depend on how the values are spread; rows
   equal to a cut are a part of their own, so ties end a search;
3. the at most ``finish_rows`` values of each final interval are numbered in
   order (a window sort), and the rows at the needed positions are kept.

Groups of more than ``finish_rows`` rows, as the first count shows them, are hot:
in joins of the data with intervals they are salted by the task that read a
row, into as many parts as they have times ``finish_rows`` rows (``salts`` at
most), and what the joins feed is aggregated, so a hot group is spread and
combined before it is shuffled by group.  Other groups have one interval row a
rank.  Statistics and the state after each
round (one row per group and rank) are stored.

With ``n`` values and fraction ``p``, ``h = (n - 1) p`` and the answer is
``v[floor h] + (h - floor h) (v[ceil h] - v[floor h])`` over the sorted values;
where the two are equal or ``h`` is whole it is the value itself.  Nulls are
ignored.  NaN is greater than any other value and infinities are values, as in
Spark's sort order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heldout.session import materialize, release

_KEY = "_qkey"


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), steps: int = 1000,
                    finish_rows: int = 1_000_000, salts: int = 64) -> DataFrame:
    """Return ``group_cols + [prob, value]``, one row per group and fraction.

    A round leaves about ``3 / steps`` of an interval's rows.  With the
    defaults, a group of 4e12 rows (a third of a 100 TB table) needs three
    rounds of two scans; the last step sorts at most 1e6 doubles (8 MB) per
    interval in one task.
    """
    if not probs or any(not 0.0 <= p <= 1.0 for p in probs):
        raise ValueError("probs must be fractions in [0, 1]")
    if steps < 4:
        raise ValueError("steps must be at least 4")
    # All internal joins use one struct key over the group columns: a struct
    # is never null, and structs with null fields compare equal, so a group
    # whose key is NULL is kept, as GROUP BY keeps it.
    key = (F.struct(*[F.col(g) for g in group_cols]) if group_cols
           else F.struct(F.lit(0).alias("all")))
    given = df.select(key.alias(_KEY), F.col(value_col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    data = given.where(~F.isnan("_x"))

    number = F.when(~F.isnan("_x"), F.col("_x"))
    stats = materialize(given.groupBy(_KEY).agg(
        F.count("_x").alias("_all"), F.count(number).alias("_n"), F.min(number).alias("_lo"), F.max(number).alias("_hi")))

    most = stats.agg(F.max("_all").alias("n")).first()["n"] or 0
    # an explode, as a literal would fold the key of a single group away
    hot, once = None, F.explode(F.array(F.lit(0)))
    data = data.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(1)))
    if most > finish_rows and salts > 1:
        # one row a hot group; a hot group's rows may be split in this join by AQE
        parts_of = F.least(F.lit(salts), F.ceil(F.col("_all") / F.lit(finish_rows))).cast("int")
        hot = materialize(stats.where(F.col("_all") > finish_rows).select(_KEY, parts_of.alias("_parts")))
        data = (data.drop("_salt").withColumn("_task", F.spark_partition_id()).join(hot, _KEY, "left")
                .select(_KEY, "_x", F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(
                    F.pmod(F.col("_task"), F.col("_parts"))).alias("_salt")))

    prob_arr = F.array(*[F.lit(float(p)) for p in probs])

    def position(p: Column) -> Column:
        return (F.col("_all") - 1).cast("double") * p

    targets = stats.select(_KEY, "_all", F.explode(prob_arr).alias("_p")).select(
        _KEY, "_p", F.floor(position(F.col("_p"))).cast("long").alias("_rlo"),
        F.ceil(position(F.col("_p"))).cast("long").alias("_rhi"),
        (position(F.col("_p")) - F.floor(position(F.col("_p")))).alias("_frac"))
    # The distinct ranks each group needs, built from its own stats row with
    # array functions, so no aggregation or join is needed.
    needed = F.array_distinct(F.flatten(F.transform(
        prob_arr, lambda p: F.array(F.floor(position(p)).cast("long"), F.ceil(position(p)).cast("long")))))
    ranks = stats.select(_KEY, F.explode(needed).alias("_r"), "_lo", "_hi",
                         F.lit(0).cast("long").alias("_off"), F.col("_n").alias("_cnt"))
    # NaNs lie behind all numbers
    nans = ranks.where("_r >= _cnt").select(_KEY, "_r", F.lit(float("nan")).alias("_v"))
    state = ranks.where("_r < _cnt")

    def in_intervals(intervals: DataFrame) -> DataFrame:
        if hot is None:
            return data.join(intervals.withColumn("_salt", once), [_KEY, "_salt"]).where("_x >= _lo and _x <= _hi")
        salted = intervals.join(hot, _KEY, "left").withColumn("_salt", F.explode(F.sequence(
            F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
        return data.join(salted, [_KEY, "_salt"]).where("_x >= _lo and _x <= _hi")

    is_open = (F.col("_cnt") > finish_rows) & (F.col("_lo") < F.col("_hi"))
    grid = [i / steps for i in range(1, steps)]
    stored = None
    while not (open_ := state.where(is_open)).isEmpty():
        cuts = materialize(
            in_intervals(open_.select(_KEY, "_lo", "_hi").distinct()).groupBy(_KEY, "_lo", "_hi")
            .agg(F.percentile_approx("_x", grid, 10 * steps).alias("_cuts")))
        # the cuts one step below and above the rank's own step
        at = F.floor((F.col("_r") - F.col("_off")) * F.lit(float(steps)) / F.col("_cnt")).cast("int")
        around = open_.join(cuts, [_KEY, "_lo", "_hi"]).select(
            _KEY, "_r", "_lo", "_hi", "_off", "_cnt",
            F.element_at("_cuts", F.greatest(F.lit(1), F.least(F.lit(steps - 2), at - 1))).alias("_a"),
            F.element_at("_cuts", F.greatest(F.lit(2), F.least(F.lit(steps - 1), at + 2))).alias("_b"))
        x, a, b = F.col("_x"), F.col("_a"), F.col("_b")
        inside = (x > a) & (x < b)
        count = lambda c: F.count(F.when(c, 1))
        parts = in_intervals(around).groupBy(_KEY, "_r").agg(
            F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), F.first("_off").alias("_off"),
            F.first("_a").alias("_a"), F.first("_b").alias("_b"),
            count(x < a).alias("_below"), count(x == a).alias("_at_a"), count(inside).alias("_inside"),
            count((x == b) & (b > a)).alias("_at_b"), count(x > b).alias("_above"),
            F.max(F.when(x < a, x)).alias("_max_below"), F.min(F.when(inside, x)).alias("_min_in"),
            F.max(F.when(inside, x)).alias("_max_in"), F.min(F.when(x > b, x)).alias("_min_above"))
        left = F.col("_r") - F.col("_off")
        before, choice = F.lit(0).cast("long"), None
        for size, lo, hi in (("_below", "_lo", "_max_below"), ("_at_a", "_a", "_a"), ("_inside", "_min_in", "_max_in"),
                             ("_at_b", "_b", "_b"), ("_above", "_min_above", "_hi")):
            part = F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"), before.alias("before"), F.col(size).alias("cnt"))
            here = (left >= before) & (left < before + F.col(size))
            choice = F.when(here, part) if choice is None else choice.when(here, part)
            before = before + F.col(size)
        refined = parts.withColumn("_in", choice).select(
            _KEY, "_r", F.col("_in.lo").alias("_lo"), F.col("_in.hi").alias("_hi"),
            (F.col("_off") + F.col("_in.before")).alias("_off"), F.col("_in.cnt").alias("_cnt"))
        # Cut here: the next round must not re-run this round's scans.
        state = materialize(state.where(~is_open).unionByName(refined))
        release(cuts, stored)
        stored = state

    single = state.where("_lo = _hi").select(_KEY, "_r", F.col("_lo").alias("_v"))
    to_sort = state.where("_lo < _hi")
    # Every finishing interval holds at most `finish_rows` values.  They are
    # numbered in order by a window (Spark's spillable sorter, no boxing), and
    # the row at each needed position is kept.
    in_order = Window.partitionBy(_KEY, "_lo", "_hi").orderBy("_x")
    numbered = in_intervals(to_sort.select(_KEY, "_lo", "_hi").distinct()).select(
        _KEY, "_lo", "_hi", "_x", F.row_number().over(in_order).cast("long").alias("_pos"))
    wanted = to_sort.select(_KEY, "_lo", "_hi", "_r", (F.col("_r") - F.col("_off") + 1).alias("_pos"))
    picked = numbered.join(wanted, [_KEY, "_lo", "_hi", "_pos"]).select(_KEY, "_r", F.col("_x").alias("_v"))
    # One row per group and rank; cut so that the two joins below (lower and
    # upper rank) do not each repeat the finishing scan of the data.
    values = materialize(single.unionByName(picked).unionByName(nans))

    lo_v = values.select(_KEY, F.col("_r").alias("_rlo"), F.col("_v").alias("_vlo"))
    hi_v = values.select(_KEY, F.col("_r").alias("_rhi"), F.col("_v").alias("_vhi"))
    between = F.when((F.col("_frac") == 0) | (F.col("_vlo") == F.col("_vhi")), F.col("_vlo")).otherwise(
        F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac"))
    return targets.join(lo_v, [_KEY, "_rlo"]).join(hi_v, [_KEY, "_rhi"]).select(
        *[F.col(_KEY)[g].alias(g) for g in group_cols], F.col("_p").alias("prob"), between.alias("value"))
