"""Embedding near-duplicates with a forest of random-projection trees.

A tree splits the vectors again and again by their projection on a random
direction (one a level and tree).  Vectors within ``spill`` of a split go to
both sides, so close vectors seldom part.  A split's threshold is the one that
leaves the fewest pairs within the sides, of those that send at most
``MOST_SPILT`` times the vectors on; where there is none (a dense cluster) the
direction is passed over, so that clusters are not copied to both sides again and
again.  A path whose splits have sent on ``COPIES`` times its vectors splits
without overlap from there on, which bounds the copies of a vector in a tree.

1. Upper levels are fitted on a bounded sample, as far as it can tell (at least
   ``TELLING`` sampled vectors a node); this is all that is broadcast, and it does
   not grow with the input.  Vectors of each length have trees of their own.
2. Nodes that still hold many vectors are grown in Spark: each is a group, its
   own count and a bounded sample of its own vectors fix the next ``LEVELS`` levels,
   which meet the node's vectors by a join; so on, until no node can be split.
3. Each vector then carries the names of all its leaves.  In each leaf all
   pairs are compared by cosine (in single precision, and those not far below
   the threshold in double), in blocks of at most about ``block`` vectors (a cluster
   of near copies).  A pair is counted in the smallest leaf name that both carry, so
   nothing is counted twice and no list of pairs leaves the task, which itself holds
   at most about ``PAIRS`` and those of one slice of rows: per block each vector has
   its count of links and one edge to the smallest vector that links lead to there.

Vectors that are equal entry by entry are compared once and counted as often as
they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.llm import common
from heldout.llm.components import connected_components
from heldout.session import materialize, release, ship

#: Vectors that the upper splits are fitted on, and those that a node grown in Spark is.
SAMPLE, NODE_SAMPLE = 20_000, 2_000
TREES, LEAF, BLOCK = 10, 400, 2_000
#: A node of more vectors than so many leaves' is grown further.
CROWDED = 3
#: Width of the overlap on each side of a split, in standard deviations of the
#: projections' difference of two vectors at the threshold.
SPILL = 0.5
#: A split sends at most so many times a node's vectors to its sides together,
#: and leaves at most so much of the pairs.
MOST_SPILT, WORTH = 1.3, 0.95
#: Bound of the mean number of a tree's leaves that a vector is in.
COPIES = 10
#: Least sampled vectors of a node that its own split is fitted on.
TELLING = 32
#: Levels that a node grows by at a time in Spark, and deepest level of all.
LEVELS, DEEPEST = 5, 60
#: Linked pairs that a task gathers before it adds them up.
PAIRS = 500_000
SEED = 5


@lru_cache(maxsize=4096)
def direction(size: int, tree: int, level: int) -> np.ndarray:
    """The unit vector that a level of a tree splits vectors of ``size`` entries by."""
    out = np.random.Generator(np.random.PCG64([SEED, size, tree, level])).standard_normal(size)
    return out / np.linalg.norm(out)


@dataclass
class Tree:
    """Nodes by (level, path): threshold and overlap of a split (infinite if the
    level is passed over); the share of vectors that paths have sent on."""

    size: int
    number: int
    splits: dict[tuple[int, int], tuple[float, float]] = field(default_factory=dict)
    spent: dict[tuple[int, int], float] = field(default_factory=dict)

    def leaves(self, unit: np.ndarray, top: tuple[int, int] = (0, 0)) -> list[tuple[int, int, np.ndarray]]:
        """Leaves (level, path, rows) below ``top`` that the unit vectors are in."""
        at: dict[int, np.ndarray] = {}
        found, todo = [], [(*top, np.arange(len(unit)))]
        while todo:
            level, path, rows = todo.pop()
            split = self.splits.get((level, path))
            if split is None:
                found.append((level, path, rows))
                continue
            if level not in at:
                at[level] = unit @ direction(self.size, self.number, level)
            side = at[level][rows] - split[0]
            for bit, keep in ((0, side < split[1]), (1, side >= -split[1])):
                if keep.any():
                    todo.append((level + 1, path << 1 | bit, rows[keep]))
        return found


def _threshold(at: np.ndarray, spill: float) -> tuple[float, float, float] | None:
    """A split of a node's sample, and the shares that go to each side: the one
    that leaves the fewest pairs to compare, of those that send few to both
    sides.  None if no split along this direction helps."""
    at = np.sort(at)
    tries = np.concatenate([np.quantile(at, np.linspace(0.02, 0.98, 49)), np.linspace(at[0], at[-1], 34)[1:-1]])
    left = np.searchsorted(at, tries + spill) / len(at)
    right = 1 - np.searchsorted(at, tries - spill) / len(at)
    pairs = np.where(left + right <= MOST_SPILT, left ** 2 + right ** 2, 1)
    best = int(pairs.argmin())
    return (float(tries[best]), float(left[best]), float(right[best])) if pairs[best] < WORTH else None


def overlap(size: int, threshold: float) -> float:
    return SPILL * math.sqrt(max(0.0, 2 - 2 * threshold) / max(size, 1))


def grow(tree: Tree, sample: np.ndarray, total: float, threshold: float, leaf: int, deepest: int,
         top: tuple[int, int] = (0, 0), spent: float = 1.0) -> Tree:
    """Split the node ``top`` of ``total`` unit vectors as a sample of them tells."""
    spill, each = overlap(tree.size, threshold), total / max(len(sample), 1)
    at: dict[int, np.ndarray] = {}
    todo = [(*top, np.arange(len(sample)), spent)]
    while todo:
        level, path, rows, sent_on = todo.pop()
        tree.spent[level, path] = sent_on
        if len(rows) < TELLING or len(rows) * each <= leaf or level >= deepest:
            continue
        if level not in at:
            at[level] = sample @ direction(tree.size, tree.number, level)
        own = at[level][rows]
        wide = spill if sent_on * MOST_SPILT <= COPIES else 0.0
        split = _threshold(own, wide)
        if split is None:  # all go one way, to the next level's direction
            tree.splits[level, path] = (math.inf, 0.0)
            todo.append((level + 1, path << 1, rows, sent_on))
            continue
        tree.splits[level, path] = (split[0], wide)
        sides = (own < split[0] + wide, own >= split[0] - wide)
        for bit in (0, 1):
            todo.append((level + 1, path << 1 | bit, rows[sides[bit]], sent_on * (split[1] + split[2])))
    return tree


def fit(sample: np.ndarray, total: int, threshold: float, trees: int = TREES, leaf: int = LEAF) -> list[Tree]:
    """Upper levels of all trees of ``total`` unit vectors of one length.  Their
    number of nodes follows from the sample alone."""
    depth = min(DEEPEST, max(0, math.ceil(math.log2(max(1.0, total / leaf)))) + 6)
    return [grow(Tree(sample.shape[1], t), sample, total, threshold, leaf, depth) for t in range(trees)]


def _unit(vectors: list[bytes], size: int) -> np.ndarray:
    """Unit vectors of one length; entries are of single precision where that
    holds them."""
    kinds = [len(v) // size for v in vectors]
    if min(kinds, default=8) == max(kinds, default=8):
        flat = np.frombuffer(b"".join(vectors), dtype="<f8" if not kinds or kinds[0] == 8 else "<f4").reshape(-1, size).astype(float)
    else:
        flat = np.array([np.frombuffer(v, dtype="<f8" if k == 8 else "<f4") for v, k in zip(vectors, kinds, strict=True)], dtype=float)
    # scaled first, so that very large and very small entries keep their squares
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pack(x) -> bytes:
        full = np.asarray(x, dtype="<f8")
        with np.errstate(over="ignore"):
            short = full.astype("<f4")
        return (short if (short == full).all() else full).tobytes()

    for batch in batches:
        yield pa.RecordBatch.from_arrays([
            *map(batch.column, ("vec_id", "copies", "size")),
            pa.array([pack(x) for x in batch.column("e").to_pylist()], pa.binary())], names=["vec_id", "copies", "size", "vector"])


@lru_cache(maxsize=1 << 16)
def _name(size: int, tree: int, level: int, path: int) -> int:
    x = np.array([size], dtype=np.uint64)
    for part in (tree, level, path):
        x = common.mix(x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(part))
    return int(x.view(np.int64)[0])


_NODE = "size int, tree int, level int, path long, spent double"


def _node_columns(nodes: list[tuple]) -> dict[str, pa.Array]:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64())
    names = ("size", "tree", "level", "path", "spent")
    return {c: pa.array([x[i] for x in nodes], k) for i, (c, k) in enumerate(zip(names, kinds, strict=True))}


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def _route(sent, trees: int):
    """Each vector with the names of its leaves of the upper levels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                batch = whole.slice(start, 2_000)
                names: list[list[int]] = [[] for _ in range(batch.num_rows)]
                for size, own in _by_size(batch):
                    unit = _unit(batch.column("vector").take(pa.array(own)).to_pylist(), size)
                    for t in range(trees):
                        # a length that the sample did not show has bare roots
                        tree = sent.value[size][t] if size in sent.value else Tree(size, t)
                        for level, path, rows in tree.leaves(unit):
                            name = _name(size, t, level, path)
                            for r in own[rows]:
                                names[r].append(name)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([sorted(x) for x in names], pa.list_(pa.int64()))],
                                                 names=[*batch.schema.names, "leaves"])
    return run


def _named(sent, trees: int):
    """The nodes that the leaves of the upper levels are, for each length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size in batch.column("size").to_pylist():
                for t in range(trees):
                    tree = sent.value[size][t] if size in sent.value else Tree(size, t)
                    ends = [(size, t, *at, spent) for at, spent in (tree.spent or {(0, 0): 1.0}).items() if at not in tree.splits]
                    yield pa.RecordBatch.from_pydict({"leaf": pa.array([_name(*x[:4]) for x in ends], pa.int64()), **_node_columns(ends)})
    return run


def _grown(threshold: float, leaf: int):
    """(leaf, cuts) of a node: the next levels' splits, from a sample of its vectors."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        size, number, level, path, spent, n = (table.column(c)[0].as_py() for c in ("size", "tree", "level", "path", "spent", "n"))
        unit = _unit(table.column("vector").to_pylist(), size)
        tree = grow(Tree(size, number), unit, n, threshold, leaf, min(DEEPEST, level + LEVELS), (level, path), spent)
        if all(math.isinf(cut) for cut, _ in tree.splits.values()):  # no direction tells the vectors apart
            return pa.table({"leaf": pa.array([], pa.int64()), "cuts": pa.array([], pa.list_(pa.float64()))})
        cuts = [float(x) for (lv, p), (cut, wide) in tree.splits.items() for x in (lv, p - (path << (lv - level)), cut, wide, tree.spent[lv, p])]
        cuts += [float(x) for (lv, p), s in tree.spent.items() if (lv, p) not in tree.splits
                 for x in (lv, p - (path << (lv - level)), math.nan, 0.0, s)]
        return pa.table({"leaf": pa.array([key[0].as_py()], pa.int64()), "cuts": pa.array([cuts], pa.list_(pa.float64()))})
    return run


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of split nodes, in the nodes that they go on to."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2_000):
            batch = whole.slice(start, 2_000)
            leaf = batch.column("leaf").to_numpy()
            rows_out, nodes = [], []
            for name in np.unique(leaf):
                own = np.flatnonzero(leaf == name)
                size, number, level, path = (batch.column(c)[int(own[0])].as_py() for c in ("size", "tree", "level", "path"))
                cuts = np.array(batch.column("cuts")[int(own[0])].as_py()).reshape(-1, 5)
                tree = Tree(size, number)
                for lv, p, cut, wide, spent in cuts:
                    at = (int(lv), int(p) + (path << (int(lv) - level)))
                    tree.spent[at] = spent
                    if not math.isnan(cut):
                        tree.splits[at] = (cut, wide)
                unit = _unit(batch.column("vector").take(pa.array(own)).to_pylist(), size)
                for lv, p, rows in tree.leaves(unit, (level, path)):
                    rows_out.append(own[rows])
                    nodes += [(size, number, lv, p, tree.spent[lv, p], _name(size, number, lv, p))] * len(rows)
            rows = pa.array(np.concatenate(rows_out) if rows_out else np.empty(0, np.int64))
            yield pa.RecordBatch.from_pydict({
                "origin": batch.column("origin").take(rows), "vec_id": batch.column("vec_id").take(rows),
                "vector": batch.column("vector").take(rows), "leaf": pa.array([x[5] for x in nodes], pa.int64()), **_node_columns(nodes)})


def _joined(least: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches, given that without the links
    between ``one`` and ``two``."""
    while True:
        a, b = least[one], least[two]
        apart = a != b
        if not apart.any():
            return least
        one, two, a, b = one[apart], two[apart], a[apart], b[apart]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while (least[least] != least).any():
            least = least[least]


def _compare(threshold: float):
    def exact(a: np.ndarray, b: np.ndarray) -> bool:
        dot = math.fsum(a * b)
        return dot >= threshold * math.sqrt(math.fsum(a * a) * math.fsum(b * b))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        leaf, n, bi, bj = (x.as_py() for x in key)
        table = table.sort_by("vec_id")
        ids, copies = table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
        leaves = table.column("leaves").combine_chunks()
        unit = _unit(table.column("vector").to_pylist(), table.column("size")[0].as_py())
        cell = common.mix(ids.astype(np.uint64)) >> np.uint64(8)
        cell = (cell % np.uint64(n)).astype(np.int64)
        # single precision rules out what is far off; the rest is told in double
        rough = unit.astype(np.float32)
        counts = np.zeros(len(ids), dtype=np.int64)
        least = np.arange(len(ids))

        def add_up(one: np.ndarray, two: np.ndarray) -> None:
            nonlocal least
            least = _joined(least, one, two)
            # counted in the block and in the smallest leaf that both are in
            first = (np.minimum(cell[one], cell[two]) == bi) & (np.maximum(cell[one], cell[two]) == bj)
            one, two = one[first], two[first]
            if not len(one):
                return
            hit = np.unique(np.concatenate([one, two]))
            x, y = np.searchsorted(hit, one), np.searchsorted(hit, two)
            earlier = common.carried(leaf, leaves.take(pa.array(hit)))
            first = np.ones(len(one), dtype=bool)
            for i in range(0, len(hit) if earlier.shape[1] else 0, 256):
                mine = np.flatnonzero((x >= i) & (x < i + 256))
                if len(mine):
                    first[mine] = (earlier[i:i + 256] @ earlier.T)[x[mine] - i, y[mine]] == 0
            np.add.at(counts, one[first], copies[two[first]])
            np.add.at(counts, two[first], copies[one[first]])

        held, pairs = [], 0
        for start in range(0, len(ids), 512):
            a, b = np.nonzero(rough[start:start + 512] @ rough[start:].T >= threshold - 1e-4)
            keep = a < b
            a, b = a[keep] + start, b[keep] + start
            near = np.concatenate([np.einsum("ij,ij->i", unit[a[i:i + 50_000]], unit[b[i:i + 50_000]])
                                   for i in range(0, max(len(a), 1), 50_000)])
            sure = near >= threshold + 1e-9
            for x in np.flatnonzero(np.abs(near - threshold) < 1e-9):
                sure[x] = exact(unit[a[x]], unit[b[x]])
            held.append((a[sure], b[sure]))
            pairs += len(held[-1][0])
            if pairs >= PAIRS:
                add_up(*map(np.concatenate, zip(*held, strict=True)))
                held, pairs = [], 0
        if pairs:
            add_up(*map(np.concatenate, zip(*held, strict=True)))
        said = np.flatnonzero((counts > 0) | (least < np.arange(len(ids))))
        return pa.table({"vec_id": ids[said], "links": counts[said], "near": ids[least[said]]})
    return run


def _grow_in_spark(routed: DataFrame, nodes: DataFrame, named: DataFrame, threshold: float, leaf: int, room: int) -> DataFrame | None:
    """Rows (vec_id, origin, leaf): for vectors of crowded leaves ``origin`` of the
    upper levels, the leaves that take their place.  None if no leaf is crowded.

    Every round's nodes are groups; their cuts are joined to their vectors by name,
    with a hot node's rows split by AQE.  Only counts of nodes reach the driver.
    """
    crowded = materialize(nodes.where(F.col("n") > room).join(named, "leaf").select("leaf", "n", *_COLUMNS))
    if not crowded.count():
        return None
    ends = []
    here = routed.select("vec_id", "vector", F.explode("leaves").alias("leaf")).withColumn("origin", F.col("leaf"))
    while True:
        now = here.select("origin", "vec_id", "vector", "leaf").join(crowded, "leaf")
        drawn = now.where(F.pmod(F.xxhash64("vec_id", "leaf"), F.lit(1 << 30)) < F.lit(NODE_SAMPLE * float(1 << 30)) / F.col("n"))
        cuts = materialize(drawn.groupBy("leaf").applyInArrow(_grown(threshold, leaf), "leaf long, cuts array<double>"))
        if not cuts.count():
            break
        moved = materialize(now.join(cuts, "leaf").mapInArrow(_moved, f"origin long, vec_id long, vector binary, leaf long, {_NODE}"))
        sizes = moved.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in _COLUMNS])
        ends.append((cuts, moved))
        here, crowded = moved, materialize(sizes.where(F.col("n") > room).select("leaf", "n", *_COLUMNS))
        if not crowded.count():
            break
    out = None
    for i, (cuts, moved) in enumerate(ends):
        own = moved.select("vec_id", "origin", "leaf")
        if i + 1 < len(ends):  # not the nodes that the next round has split
            own = own.join(ends[i + 1][0].select("leaf"), "leaf", "left_anti").select("vec_id", "origin", "leaf")
        out = own if out is None else out.unionByName(own)
    return out


_COLUMNS = ("size", "tree", "level", "path", "spent")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF,
                 block: int = BLOCK) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of
    ``vectors`` (vec_id long, embedding array of numbers; other columns are
    ignored).

    Two vectors of one length are linked if their cosine is at least
    ``threshold`` (checked in double precision) and a tree brings them together.
    ``n_links`` counts the other rows linked with a row, ``component_id`` is the
    smallest vec_id reachable by links, ``kept`` says that it is the row's own.
    Vectors that are null, empty or zero, or hold null or non-finite entries,
    link with nothing, nor do vectors with a null vec_id (component_id null,
    kept).  Rows with one vec_id are rows like others; their links are the
    vec_id's.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    sound = (F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("e", lambda x: x != 0))
    # a zero is a zero, whatever its sign; equal vectors have equal keys of 128 bits
    rows = (rows.withColumn("e", F.when(F.coalesce(sound, F.lit(False)), F.transform("e", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))))
            .withColumn("h1", F.when(F.col("e").isNotNull(), F.xxhash64("e")))
            .withColumn("h2", F.when(F.col("e").isNotNull(), F.xxhash64(F.lit(1), "e"))))
    # one row for each different vector: smallest id, number of rows
    grouped = rows.where("e is not null").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("e").alias("e"))
    distinct = materialize(grouped.select("vec_id", "copies", F.size("e").alias("size"), "e").mapInArrow(
        _packed, "vec_id long, copies long, size int, vector binary"))
    total = distinct.count()
    share = min(1.0, sample / max(total, 1))
    drawn = (distinct.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30)) < int(share * (1 << 30)))
             .select("vec_id", "size", "vector").limit(2 * sample).collect())
    drawn = sorted(drawn, key=lambda r: (r["size"], r["vec_id"]))
    forest = {}
    for size in {r["size"] for r in drawn}:
        own = [bytes(r["vector"]) for r in drawn if r["size"] == size]
        if len(own) >= TELLING:
            forest[size] = fit(_unit(own, size), round(len(own) / share), threshold, trees, leaf)
    sent = spark.sparkContext.broadcast(forest)

    routed = materialize(distinct.mapInArrow(_route(sent, trees), "vec_id long, copies long, size int, vector binary, leaves array<long>"))
    nodes = materialize(routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")))
    named = distinct.select("size").distinct().mapInArrow(_named(sent, trees), f"leaf long, {_NODE}")
    deeper = _grow_in_spark(routed, nodes, named, threshold, leaf, CROWDED * leaf)
    if deeper is not None:
        deeper = materialize(deeper.groupBy("vec_id").agg(F.collect_set("origin").alias("gone"), F.collect_set("leaf").alias("new")))
        routed = materialize(routed.join(deeper, "vec_id", "left").withColumn("leaves", F.when(F.col("new").isNull(), F.col("leaves")).otherwise(
            F.concat(F.array_except("leaves", "gone"), F.col("new")))).drop("gone", "new"))
        nodes = materialize(routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")))
    # how many vectors a leaf has is counted: a sample does not show a small dense cluster
    blocks = materialize(nodes.where(F.col("n") > 1).select("leaf", F.ceil(F.col("n") / block).cast("int").alias("n")))
    cells = (routed.withColumn("leaf", F.explode("leaves")).join(blocks, "leaf")
             .mapInArrow(_cells, "leaf long, n int, i int, j int, vec_id long, copies long, size int, vector binary, leaves array<long>"))
    found = materialize(cells.groupBy("leaf", "n", "i", "j").applyInArrow(_compare(threshold), "vec_id long, links long, near long"))
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links")).where("links > 0")
    labels = materialize(connected_components(found.select(F.col("vec_id").alias("a"), F.col("near").alias("b"))))

    groups = grouped.select("h1", "h2", F.col("vec_id").alias("rep"), "copies")
    placed = (rows.select("vec_id", "h1", "h2").join(groups, ["h1", "h2"], "left")
              .join(links.withColumnRenamed("vec_id", "rep"), "rep", "left")
              .join(labels.withColumnRenamed("id", "rep"), "rep", "left"))
    return placed.select(
        "vec_id", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("label", "rep", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A leaf's vectors by pairs of blocks: each goes to all that hold its block."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2_000):
            batch = whole.slice(start, 2_000)
            many = batch.column("n").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(many)), many)
            other = common.spans(np.zeros(len(many), dtype=np.int64), many)
            mine = ((common.mix(batch.column("vec_id").to_numpy().astype(np.uint64)) >> np.uint64(8)) % many.astype(np.uint64)).astype(np.int64)[row]
            for i in range(0, len(row), 50_000):
                at = pa.array(row[i:i + 50_000])
                x, y = mine[i:i + 50_000], other[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in ("leaf", "n")), pa.array(np.minimum(x, y), pa.int32()), pa.array(np.maximum(x, y), pa.int32()),
                     *(batch.column(c).take(at) for c in ("vec_id", "copies", "size", "vector", "leaves"))],
                    names=["leaf", "n", "i", "j", "vec_id", "copies", "size", "vector", "leaves"])
