"""Merkle manifest of a dataset, rolled up in nested structs.

A row's leaf is a hash of its columns.  Leaves of one group ascend by an order
column; every ``arity`` consecutive nodes become their hash until one is left,
the group's subroot; subroots in order of the group's bytes become the root in
the same way.

A leaf's rank has one digit a level.  Ranks of ``digits`` digits make a block,
and a block's nodes are shuffled to one task together.  There the digit
columns are grouped away one after another: nodes with equal leading
digits become one row, with its children in an array of structs, which hold
theirs, down to the leaves.  A block's hash is a node of the next tier, whose
rank has those digits fewer; tiers go on until each group is one node.

On the way back each tier's blocks learn the siblings above them, a row a block,
and one transform over the nested structs, then one explode, give each
node its own path: no join per leaf, and no row larger than a block.
Blocks (``arity ** digits`` leaves) bound what is nested, so a group that holds
a third of all rows is many rows in many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heldout.session import materialize, release

ARITY = 16
#: Levels that a block nests.
DIGITS = 2


def leaf_hash(*columns: Column | str) -> Column:
    """Hash of a row: of its columns, each ``-`` if null, else the number of its
    text's UTF-8 bytes, a colon and the text."""
    def told(c: Column | str) -> Column:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*map(told, columns)), 256)


def siblings(proof: Column) -> Column:
    """All hashes of a proof, level by level, left to right."""
    return F.flatten(F.transform(proof, lambda step: F.concat(step["left"], step["right"])))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof's hashes give."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(
        F.concat(F.array_join(step["left"], ""), node, F.array_join(step["right"], "")), 256))


def _ranked(leaves: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0) and ``size`` within each ``name``, in order of
    (at, hash), by range partitions: each counts its own rows of a name, and
    a table of those counts gives what lies ahead."""
    order = [F.col("at").asc_nulls_first(), F.col("hash")]
    parts = materialize(leaves.repartitionByRange("name", *order).withColumn("part", F.spark_partition_id()))
    by_name = Window.partitionBy("name")
    ahead = by_name.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("part", "name").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "name", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"), F.sum("n").over(by_name).alias("size"))
    here = F.row_number().over(Window.partitionBy("part", "name").orderBy(*order))
    return (parts.withColumn("here", here).join(counts, ["part", "name"])
            .select("name", (F.col("ahead") + F.col("here") - 1).alias("rank"), "size", "hash", "item"))


def _nodes_at(level: int, arity: int) -> Column:
    """Nodes of the group that are left after some levels."""
    return F.ceil(F.col("size") / F.lit(arity ** level)).cast("long")


def _blocks(nodes: DataFrame, arity: int, digits: int) -> DataFrame:
    """Rows (name, block, size, hash, kids): nodes (name, rank, size, hash,
    item), grouped by one digit of their rank after another."""
    def digit(i: int) -> Column:
        return (F.floor(F.col("rank") / F.lit(arity ** i)) % arity).cast("int").alias(f"digit_{i}")
    names = [f"digit_{i}" for i in range(digits)]
    rows = (nodes.select("name", F.floor(F.col("rank") / F.lit(arity ** digits)).cast("long").alias("block"), "size",
                         *map(digit, range(digits)), "hash", F.col("item").alias("kids"))
            # all levels of a block are grouped where it is: no shuffle between them
            .repartition("name", "block"))
    for i in range(digits):
        kid = F.struct(F.col(names[i]).alias("digit"), "hash", "kids")
        joined = F.array_join(F.transform("kids", lambda k: k["hash"]), "")
        rows = (rows.groupBy("name", "block", "size", *names[i + 1:]).agg(F.array_sort(F.collect_list(kid), _by_digit).alias("kids"))
                .withColumn("hash", F.when(_nodes_at(i, arity) > 1, F.sha2(joined, 256)).otherwise(F.col("kids")[0]["hash"])))
    return rows.select("name", "block", "size", "hash", "kids")


def _by_digit(a: Column, b: Column) -> Column:
    return a["digit"] - b["digit"]


def _unfolded(kids: Column, level: int, path: Column, arity: int) -> Column:
    """Array of (item, hash, path) of all nodes below nested ``kids``."""
    hashes = F.transform(kids, lambda k: k["hash"])

    def one(kid: Column, i: Column) -> Column:
        step = F.struct(F.slice(hashes, F.lit(1), i).alias("left"), F.slice(hashes, i + 2, F.lit(arity)).alias("right"))
        own = F.when(_nodes_at(level, arity) > 1, F.concat(F.array(step), path)).otherwise(path)
        if level:
            return _unfolded(kid["kids"], level - 1, own, arity)
        return F.array(F.struct(kid["kids"].alias("item"), kid["hash"].alias("hash"), own.alias("path")))
    return F.flatten(F.transform(kids, one))


class _Forest:
    """Tiers of blocks over the nodes of some groups."""

    def __init__(self, nodes: DataFrame, arity: int, digits: int) -> None:
        self.arity, self.digits, self.tiers = arity, digits, []
        most = nodes.agg(F.max("size").alias("n")).first()["n"] or 0
        while most:
            blocks = materialize(_blocks(nodes, arity, digits).withColumn("left", _nodes_at(digits, arity)))
            self.tiers.append(blocks)
            most = -(-most // arity ** digits)
            if most == 1:
                break
            nodes = blocks.where("left > 1").select("name", F.col("block").alias("rank"), F.col("left").alias("size"), "hash",
                                                    F.lit(0).alias("item"))

    def tops(self) -> DataFrame:
        """Rows (name, hash, tier) of the groups' last nodes."""
        each = [t.where("left = 1").select("name", "hash", F.lit(i).alias("tier")) for i, t in enumerate(self.tiers)]
        out = each[0]
        for x in each[1:]:
            out = out.unionByName(x)
        return out

    def paths(self, tops: DataFrame) -> DataFrame:
        """Rows (name, item, hash, path, subroot, root) of the first tier's
        nodes, from (name, tier, path, subroot, root) of the groups' last ones."""
        below = None
        for tier in range(len(self.tiers) - 1, -1, -1):
            above = tops.where(F.col("tier") == tier).select("name", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
            if below is not None:
                above = above.unionByName(below.select("name", F.col("rank").alias("block"), "path", "subroot", "root"))
            kids = _unfolded(F.col("kids"), self.digits - 1, F.col("path"), self.arity)
            below = (self.tiers[tier].select("name", "block", "size", "kids").join(above, ["name", "block"])
                     .select("name", "block", "subroot", "root", F.posexplode(kids).alias("place", "node"))
                     .select("name", (F.col("block") * self.arity ** self.digits + F.col("place")).alias("rank"), "subroot", "root",
                             "node.item", "node.hash", "node.path"))
        return below


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "source",
             order: str = "doc_id", carry: Mapping[str, Column] | None = None, arity: int = ARITY, digits: int = DIGITS) -> DataFrame:
    """Rows (``order``, the columns named in ``carry``, leaf, subroot, root,
    proof), one for each row of ``docs``.  ``proof`` has a struct (left, right) of
    sibling hashes for every level from the leaf to the root; ``fold`` gives the
    root from it.

    Leaves are hashes of ``columns``.  Groups ascend by the UTF-8 bytes of their
    text, a null group first; in a group null orders come first and rows with
    one order go by their leaves, so equal rows may change places without
    changing a hash.  A run of one node at the end of a level is hashed, too; a
    group of one row is its leaf.  An empty table gives no rows.  Texts are
    read once; only hashes, the order and ``carry`` are shuffled.
    """
    carry = dict(carry or {})
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    item = F.struct(F.col(order).alias("order"), *[c.alias(f"carry_{i}") for i, c in enumerate(carry.values())])
    leaves = materialize(docs.select(name.alias("name"), F.col(order).alias("at"), leaf_hash(*columns).alias("hash"), item.alias("item")))
    ranked = materialize(_ranked(leaves))
    release(leaves)
    if ranked.isEmpty():
        none = F.array().cast("array<struct<left:array<string>,right:array<string>>>")
        below = ranked.select("item", "hash", F.lit("").alias("subroot"), F.lit("").alias("root"), none.alias("path"))
    else:
        own = _Forest(ranked, arity, digits)
        tops = materialize(own.tops())
        # the subroots are the leaves of one more group
        last = _Forest(materialize(_ranked(tops.select(F.lit("").alias("name"), F.col("name").alias("at"), "hash",
                                                       F.struct("name", "tier").alias("item")))), arity, digits)
        root = last.tops().select("name", "tier", F.array().cast("array<struct<left:array<string>,right:array<string>>>").alias("path"),
                                  F.col("hash").alias("subroot"), F.col("hash").alias("root"))
        heads = materialize(last.paths(root).select("item.name", "item.tier", "path", F.col("hash").alias("subroot"), "root"))
        below = own.paths(heads)
    return below.select(F.col("item.order").alias(order), *[F.col(f"item.carry_{i}").alias(c) for i, c in enumerate(carry)],
                        F.col("hash").alias("leaf"), "subroot", "root", F.col("path").alias("proof"))
