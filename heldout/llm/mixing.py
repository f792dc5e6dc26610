"""Mixing sources to target weights with a hierarchy of budgets.

A tree of levels (such as domain, language, source) shares a token budget out
from its root.  A node's children get shares in proportion to their weights; a
child that cannot use its share (tokens below it, times ``max_epochs``) takes
what it can, and its siblings share the rest by weight.  Because a node never
gets more than its children can use together, a shortage is made up among
siblings first, then among the siblings of the parent, and so on up.

A leaf's allotment is read from its documents in seeded epochs: each epoch is
the leaf's documents in an order drawn from (seed, epoch, doc_id).  Whole epochs
come first, then the documents of the last one until the allotment is reached
(the document that reaches it is in).

The tree has one row a leaf.  A parent may have millions of children, so siblings
are not a window: all nodes of a level are put in one order (parent, capacity per
weight) by range partitions, global running totals less those at the parent's
first child are the siblings' own, and the water level of a parent is a
pre-aggregated maximum.
Documents are never sorted as a whole: their order is cut into 4,096 slices by
the draw's leading digits; running totals over slices find the one that holds
a leaf's cut, and only that slice's documents are put in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heldout.operators.ranking import running_totals
from heldout.session import materialize

#: Leading hex digits of a draw that name its slice.
DIGITS = 3


def _weight(levels: Sequence[str], weights: Mapping[str, Mapping[str, float]]) -> Column:
    """Weight of a node by its own level's value; 1 where none is given."""
    given = weights.get(levels[-1]) or {}
    out = F.lit(1.0)
    for value, weight in given.items():
        out = F.when(F.col(levels[-1]) == value, F.lit(float(weight))).otherwise(out)
    return out


def _shared(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Adds ``budget`` to nodes (weight, capacity, given: the parent's budget).

    Siblings in order of capacity per weight: all before some place are full,
    the rest share by weight; a node is full if its share of what is left,
    with all earlier ones full, reaches its capacity.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
    marks = [c for c in nodes.columns if c.startswith("level_")]
    order = [F.col(c) for c in (*parent, "ratio", *[m for m in marks if m not in parent])]
    placed = materialize(running_totals(nodes.withColumn("ratio", ratio), order, ["capacity", "weight"]))
    firsts = placed.groupBy(*parent).agg(F.min("capacity_before").alias("capacity_base"), F.min("weight_before").alias("weight_base"),
                                         F.sum("weight").alias("weights"))
    levelled = (placed.join(firsts, [*parent])
                .withColumn("full", F.col("capacity_before") - F.col("capacity_base"))
                .withColumn("open", F.col("weights") - (F.col("weight_before") - F.col("weight_base")))
                .withColumn("level", F.try_divide(F.col("given") - F.col("full"), F.col("open"))))
    # the level falls behind the first place that is not full
    water = levelled.groupBy(*parent).agg(F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).alias("first_open"))
    return (levelled.join(water, [*parent])
            .withColumn("budget", F.when(F.col("weight") <= 0, F.lit(0.0)).when(
                F.col("ratio") <= F.col("level"), F.col("capacity")).otherwise(F.col("weight") * F.col("first_open"))))


def budgets(leaves: DataFrame, levels: Sequence[str], total: float, weights: Mapping[str, Mapping[str, float]],
            max_epochs: int) -> DataFrame:
    """Leaves (levels, tokens) with ``allotted`` tokens (long).

    A node of weight 0 gets nothing.  If all nodes are full the rest of the
    budget stays unused.
    """
    marks = [f"level_{i}" for i in range(len(levels))]
    tree = leaves.select(*levels, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(m) for c, m in zip(levels, marks, strict=True)],
                         "tokens", (F.col("tokens") * F.lit(float(max_epochs))).alias("capacity"))
    own = [_weight(levels[:i + 1], weights) for i in range(len(levels))]
    for i, weight in enumerate(own):
        tree = tree.withColumn(f"weight_{i}", weight)
    # what a node can use: nothing below a weight of 0
    usable = F.col("capacity")
    for i in range(len(levels)):
        usable = F.when(F.col(f"weight_{i}") > 0, usable).otherwise(F.lit(0.0))
    tree = tree.withColumn("capacity", usable)
    usable = tree.agg(F.sum("capacity").alias("n")).first()["n"] or 0.0
    upper = None
    for i in range(len(levels)):
        nodes = tree.groupBy(*marks[:i + 1]).agg(F.sum("capacity").alias("capacity"), F.max(f"weight_{i}").alias("weight"))
        nodes = nodes.join(upper, marks[:i]) if i else nodes.withColumns({"given": F.lit(min(float(total), usable)), "root": F.lit(0)})
        upper = _shared(nodes, marks[:i] or ["root"]).select(*marks[:i + 1], F.col("budget").alias("given"))
    # a millionth, so that sums in another order cut alike
    return (tree.join(upper, marks).select(*levels, "tokens", F.floor(F.col("given") + F.lit(1e-6)).cast("long").alias("allotted")))


def draw(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place in an epoch, as hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")))


def mix(docs: DataFrame, levels: Sequence[str], total_share: float, weights: Mapping[str, Mapping[str, float]],
        max_epochs: int = 4, seed: int = 11) -> DataFrame:
    """Rows (doc_id, tokens, the levels, epochs), one for each row of ``docs``
    (doc_id, text, the levels; other columns are ignored): how often the mix
    takes the document.

    The budget is ``total_share`` of all tokens (words between ASCII white
    space).  A null level is a node of its own.  Null and blank texts have no
    tokens; they are taken once if their leaf gets any budget and are in front
    of its cut.  Rows with one doc_id and leaf have one place in the order;
    if the cut falls among them all of them are in.  A null doc_id is drawn as
    an empty id.
    """
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    counted = materialize(docs.select("doc_id", *levels, tokens.alias("tokens")))
    leaves = materialize(counted.groupBy(*levels).agg(F.sum("tokens").alias("tokens")))
    total = leaves.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    shares = materialize(
        budgets(leaves, levels, total * total_share, weights, max_epochs)
        .withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("allotted") / F.col("tokens"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("allotted") - F.col("whole") * F.col("tokens")).drop("tokens"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in levels]
    on = same[0]
    for x in same[1:]:
        on = on & x
    placed = (counted.alias("d").join(shares.alias("s"), on)
              .select("d.*", "s.whole", "s.rest", draw(seed, F.col("s.whole"), F.coalesce(F.col("d.doc_id").cast("string"), F.lit(""))).alias("draw"))
              .withColumn("slice", F.substring("draw", 1, DIGITS)))
    placed = materialize(placed)
    before = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (placed.groupBy(*levels, "slice").agg(F.sum("tokens").alias("here"), F.max("rest").alias("rest"))
              .withColumn("ahead", F.coalesce(F.sum("here").over(before), F.lit(0))))
    cut = materialize(slices.where("ahead < rest and ahead + here >= rest")
                      .select(*[F.col(c).alias(f"_{c}") for c in levels], F.col("slice").alias("cut"), "ahead"))
    leaf = F.lit(True)
    for c in levels:
        leaf = leaf & F.col(c).eqNullSafe(F.col(f"_{c}"))
    sided = placed.join(cut, leaf, "left").drop(*[f"_{c}" for c in levels])
    within = (Window.partitionBy(*levels).orderBy("draw")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    at_cut = (sided.where("slice = cut")
              .withColumn("end", F.sum("tokens").over(within))
              # the running total before a place that rows share
              .withColumn("start", F.col("ahead") + F.col("end") - F.sum("tokens").over(Window.partitionBy(*levels, "draw")))
              .withColumn("more", (F.col("start") < F.col("rest")).cast("long")))
    others = (sided.where("cut is null or slice <> cut")
              .withColumn("more", F.coalesce((F.col("slice") < F.col("cut")), F.lit(False)).cast("long")))
    columns = ["doc_id", "tokens", *levels]
    return (at_cut.select(*columns, (F.col("whole") + F.col("more")).alias("epochs"))
            .unionByName(others.select(*columns, (F.col("whole") + F.col("more")).alias("epochs"))))
