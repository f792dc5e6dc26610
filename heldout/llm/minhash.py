"""Near-duplicate documents: MinHash bands for candidates, odd sketches to
verify them, full shingle sets to confirm them.

1. One Python pass turns a text into its set of word shingles, ``bands x rows``
   MinHash samples, a key per band and an odd sketch: the ``SAMPLES`` least
   members under one hash are MinHash samples, too, and each of them toggles one
   bit of a bitmap.  Samples that two documents share cancel in the XOR; its
   population count c gives their number of different samples, -m/2 ln(1 - 2c/m)
   (m bits), and with the set sizes the similarity.  The estimate is sharpest
   where similarity is high.
2. Documents with equal sets are one representative (smallest id) from here on.  A
   doc_id that is the smallest of several sets stands for one of them, each
   of the others goes by a 64-bit hash of its own until the components are known.
3. Representatives that share a band key meet in a bucket.  In the first round
   each is compared with the smallest member of its buckets, and the best of
   them by odd sketch is confirmed on full sets: linear in the bucket.
4. Members of a bucket that now carry one label need no further comparison.
   Buckets with more than ``LARGE`` members outside their largest label (texts
   that share much, but not enough, such as a template) give way to finer ones:
   their members' shingles are put in one order, rare ones first, and each
   member is filed under the first of them, so many that two sets with
   the threshold similarity must share one (a prefix index; exact, whatever the
   order).  What many share is seldom in a prefix.  Frequencies are counted in
   ``SLOTS`` hash slots; buckets that are still large are counted anew among
   their own members, as long as that at least halves them.
5. In buckets with several labels, each member outside the bucket's largest
   label is compared by odd sketch with every member of another label, in
   blocks of bounded size; the best ``fan`` of each are confirmed.  A pair that has
   several keys in common counts under the smallest of them.  Rounds go on,
   with a wider fan, until no untested pair is left.  So every pair with
   a common band key and a sketch within the bound is either confirmed, refuted,
   or joined by other links; no pair list of a group is ever made.

Chances to miss a link at exactly the threshold 0.8: no band in common
(1 - 0.8^4)^28 = 4e-7; a sketch beyond its bound (6 deviations) about 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.llm import common
from heldout.llm.common import U64
from heldout.llm.components import connected_components
from heldout.session import materialize, release, ship

BANDS, ROWS = 28, 4
#: Samples that an odd sketch takes, its bits, and the bits it is folded to for
#: a first look.
SAMPLES, BITS, FOLDED = 1024, 4096, 512
#: How many standard deviations beyond the threshold a sketch may be.
DEVIATIONS = 6
#: Most members of a bucket that are compared with one another in one group.
BLOCK = 2_000
#: Members outside the largest label from which a bucket gives way to a prefix index.
LARGE = 256
#: Slots (a power of 2) in which shingles are counted for the order of the index; a
#: byte each is broadcast.
SLOTS = 1 << 20
_SIGNATURE = "doc_id long, told long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Distinct hashes of each text's runs of ``n`` words, sorted.  A-Z are
    lower-cased and words end at ASCII white space; fewer words are one
    shingle, no words an empty set."""
    (hashes,), at = common.word_hashes([t.lower() for t in texts])
    runs, out = common.gram_hashes(hashes, n), []
    for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = runs[start:end - n + 1] if end - start >= n else common.gram_hashes(hashes[start:end], end - start)
        out.append(np.unique(own) if end > start else hashes[:0])
    return out


def _samples(sets: list[np.ndarray], k: int) -> np.ndarray:
    """MinHash samples (32 bits) of non-empty sets, one row each."""
    flat = (np.concatenate(sets) >> U64(32)).astype(np.uint32)
    at = common.offsets([len(s) for s in sets])[:-1]
    draws = np.random.Generator(np.random.PCG64(20_240_229)).integers(0, 2**32, (2, k), dtype=np.uint32)
    out, room = np.empty((len(sets), k), dtype=np.uint32), np.empty_like(flat)
    for i in range(k):
        np.multiply(flat, draws[0, i] | np.uint32(1), out=room)
        np.add(room, draws[1, i], out=room)
        out[:, i] = np.minimum.reduceat(room, at)
    return out


def odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Parity bitmap of each sorted set's least members, in 64-bit words."""
    few = [s[:SAMPLES] for s in sets]
    where = (common.mix(np.concatenate(few) + U64(0x0DD5)) % U64(BITS)).astype(np.int64)
    where += np.repeat(np.arange(len(few), dtype=np.int64) * BITS, [len(s) for s in few])
    odd = np.bincount(where, minlength=len(few) * BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(few), BITS), axis=1).view(np.int64)


def estimate(count: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of sets of ``a`` and ``b`` members from the population count
    of their sketches' XOR."""
    differ = -BITS / 2 * np.log(np.maximum(1 - 2 * np.asarray(count, dtype=float) / BITS, 1e-9))
    share = np.minimum(1, SAMPLES / np.maximum(a, b))
    both = (np.minimum(a, SAMPLES) + np.minimum(b, SAMPLES) - differ) / 2 / share
    return both / (a + b - both)


def bound(a: np.ndarray, b: np.ndarray, threshold: float, bits: int = BITS) -> np.ndarray:
    """Largest population count that sets of ``a`` and ``b`` members with the
    threshold similarity reach; -1 where sizes rule it out."""
    large = np.maximum(a, b)
    both = threshold * (a + b) / (1 + threshold)
    share = np.minimum(1, SAMPLES / large)
    rate = np.minimum(1, both / large)
    doubt = DEVIATIONS * np.sqrt(np.minimum(large, SAMPLES) * rate * (1 - rate) * (1 - share))
    differ = np.minimum(a, SAMPLES) + np.minimum(b, SAMPLES) - 2 * share * both + 2 * doubt
    y = np.maximum(differ, 0) / bits
    most = bits / 2 * (1 - np.exp(-2 * y)) + DEVIATIONS * np.sqrt(bits / 4 * (1 - (1 + 4 * y) * np.exp(-4 * y))) + 1
    return np.where(both > np.minimum(a, b) + 1e-6, -1, most)


def _signatures(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, "text", 1 << 20):
            sets = shingle_sets(common.text_bytes(piece), n)
            full = [i for i, s in enumerate(sets) if len(s)]
            a, b = [None] * len(sets), [None] * len(sets)
            keys, sketch = [None] * len(sets), [None] * len(sets)
            if full:
                own = [sets[i] for i in full]
                flat, at = np.concatenate(own), common.offsets([len(s) for s in own])[:-1]
                # sums over a set of scrambled members: equal sets, equal sums
                one, two = (common.signed(np.add.reduceat(common.mix(flat ^ U64(s)), at)) for s in (0x51ED, 0xA7C3))
                samples = _samples(own, bands * rows)
                band = np.zeros((len(own), bands), dtype=U64)
                for r in range(rows):
                    band = common.mix(band + samples[:, r::rows].astype(U64)) * U64(0x9E3779B97F4A7C15)
                band = common.signed(common.mix(band + np.arange(bands, dtype=U64)))
                odd = odd_sketches(own)
                for j, i in enumerate(full):
                    a[i], b[i], keys[i], sketch[i] = one[j], two[j], band[j], odd[j]
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), piece.column("told"), pa.array([len(s) for s in sets], pa.int64()), pa.array(a, pa.int64()),
                pa.array(b, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64())),
            ], names=["doc_id", "told", "n_shingles", "set_a", "set_b", "bands", "sketch"])
    return run


def _confirm(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, "text_a", 1 << 21):
            texts = {}
            for side in ("a", "b"):
                texts |= dict(zip(piece.column(side).to_pylist(), common.text_bytes(piece, f"text_{side}"), strict=True))
            sets = dict(zip(texts, shingle_sets(list(texts.values()), n), strict=True))
            linked = []
            for a, b in zip(piece.column("a").to_pylist(), piece.column("b").to_pylist(), strict=True):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                linked.append(100 * both >= percent * (len(sets[a]) + len(sets[b]) - both))
            yield pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b"), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])
    return run


def _words(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().view(U64).reshape(len(column), -1)


def _star_pairs(threshold: float):
    """Bits by which each pair's sketches are beyond the bound (or within)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = np.bitwise_count(_words(batch.column("sketch")) ^ _words(batch.column("other"))).sum(axis=1)
            over = count - bound(*(batch.column(c).to_numpy() for c in ("n", "n_other")), threshold)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("center"), pa.array(over, pa.float64())],
                                             names=["rep", "center", "over"])
    return run


def _met_before(key: int, lists: pa.Array, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether the rows of each pair have a key below ``key`` in common."""
    hit = np.unique(np.concatenate([one, two]))
    x, y = np.searchsorted(hit, one), np.searchsorted(hit, two)
    carried = common.carried(key, lists.take(pa.array(hit)))
    out = np.zeros(len(one), dtype=bool)
    for i in range(0, len(hit) if carried.shape[1] else 0, 256):
        mine = np.flatnonzero((x >= i) & (x < i + 256))
        if len(mine):
            out[mine] = (carried[i:i + 256] @ carried.T)[x[mine] - i, y[mine]] > 0
    return out


def _close_pairs(threshold: float, fan: int):
    """Per block of a bucket: for each query the ``fan`` closest targets of
    another label whose sketches are within the bound; ``more`` if there were
    others."""
    def run(table: pa.Table) -> pa.Table:
        ids, labels, n = (table.column(c).to_numpy() for c in ("rep", "label", "n"))
        key, lists = table.column("key")[0].as_py(), table.column("keys").combine_chunks()
        ask = np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False))
        words = _words(table.column("sketch"))
        folded = np.bitwise_xor.reduce(words.reshape(len(ids), BITS // FOLDED, -1), axis=1)
        a, b, more = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
        for start in range(0, len(ask), 128):
            q = ask[start:start + 128]
            far = np.zeros((len(q), len(ids)), dtype=np.int32)
            for w in range(folded.shape[1]):
                far += np.bitwise_count(folded[q, w][:, None] ^ folded[None, :, w])
            close = far <= bound(n[q][:, None], n[None, :], threshold, FOLDED)
            close &= labels[q][:, None] != labels[None, :]
            one, two = np.nonzero(close)
            over = np.empty(len(one))
            for i in range(0, len(one), 20_000):
                x, y = q[one[i:i + 20_000]], two[i:i + 20_000]
                over[i:i + 20_000] = np.bitwise_count(words[x] ^ words[y]).sum(axis=1) - bound(n[x], n[y], threshold)
            one, two, over = one[over <= 0], two[over <= 0], over[over <= 0]
            if len(one):
                first = ~_met_before(key, lists, q[one], two)
                one, two, over = one[first], two[first], over[first]
            order = np.lexsort((ids[two], over, one))
            one, two = one[order], two[order]
            size = np.bincount(one, minlength=len(q))
            nth = np.arange(len(one)) - np.repeat(np.cumsum(size) - size, size)
            one, two = one[nth < fan], two[nth < fan]
            a.append(ids[q[one]])
            b.append(ids[two])
            more.append(size[one] > fan)
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "more": np.concatenate(more)})
    return run


def _slots(hashes: np.ndarray, turn: int) -> np.ndarray:
    return (common.mix(hashes ^ U64(0xF1E0 + turn)) & U64(SLOTS - 1)).astype(np.int64)


def _slot_counts(n: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for piece in common.pieces(batches, "text", 1 << 20):
            total += np.bincount(_slots(np.concatenate(shingle_sets(common.text_bytes(piece), n)), turn), minlength=SLOTS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(met, pa.int32()), "n": pa.array(total[met])})
    return run


def _prefixes(sent, n: int, percent: int, turn: int):
    """(rep, key) for each of a set's first members in the order of ``sent``, as
    many as two sets with the threshold similarity must share one of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, "text", 1 << 20):
            sets = shingle_sets(common.text_bytes(piece), n)
            size = np.array([len(s) for s in sets], dtype=np.int64)
            flat = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), size)
            order = np.lexsort((flat, sent.value[_slots(flat, turn)], owner))
            first = order[common.spans(common.offsets(size)[:-1], np.minimum(size, size - -(-percent * size // 100) + 1))]
            yield pa.RecordBatch.from_pydict({"rep": piece.column("rep").to_numpy()[owner[first]],
                                              "key": common.signed(common.mix(flat[first] + U64(0x9E1D + turn)))})
    return run


def _met(members: DataFrame) -> DataFrame:
    """Rows (key, rep, center) of the keys with several members."""
    shared = (members.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last"))
              .where("center < last").select("key", "center"))
    return materialize(members.join(shared, "key").select("key", "rep", "center"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of
    ``docs`` (doc_id long, text string; other columns are ignored).

    Two documents are linked if 100 x common shingles >= percent x all
    shingles.  ``component_id`` is the smallest doc_id reachable by links,
    ``kept`` says that it is the row's own.  Null and blank texts have no
    shingles and no links.  Rows that repeat a doc_id count as one document: a
    link of any of them is a link of all.  A null doc_id is never linked
    and is kept, with a null component_id.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    threshold = percent / 100
    # ``told`` tells the texts of one doc_id apart
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("told"))
    signed = materialize(docs.mapInArrow(_signatures(n, bands, rows), _SIGNATURE))
    sets = materialize(signed.where("doc_id is not null and n_shingles > 0").groupBy("set_a", "set_b").agg(
        F.min(F.struct("doc_id", "told")).alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")).select("set_a", "set_b", "least.*", "n", "bands", "sketch"))
    # doc_ids that are the smallest of several sets: one set goes by the doc_id, the others by a hash
    crowded = materialize(sets.groupBy("doc_id").agg(F.min(F.struct("set_a", "set_b")).alias("own"), F.count(F.lit(1)).alias("sets"))
                          .where("sets > 1").select("doc_id", "own"))
    other = F.col("own").isNotNull() & (F.struct("set_a", "set_b") != F.col("own"))
    reps = (sets.join(crowded, "doc_id", "left").withColumn("hashed", F.coalesce(other, F.lit(False)))
            .withColumn("rep", F.when(F.col("hashed"), F.xxhash64("set_a", "set_b")).otherwise(F.col("doc_id"))))
    hashed = materialize(reps.where("hashed").select("rep"))
    placed = materialize(signed.join(reps.select("set_a", "set_b", "rep"), ["set_a", "set_b"], "left")
                         .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")))
    release(signed)
    sketches = reps.select("rep", "n", "sketch")

    buckets = _met(reps.select("rep", F.explode("bands").alias("key")).distinct())
    # one text of each representative, however many rows repeat it
    texts = materialize(docs.join(reps.select("doc_id", "told", "rep").join(buckets.select("rep").distinct(), "rep", "left_semi"),
                                  ["doc_id", "told"]).groupBy("doc_id", "told").agg(F.first("rep").alias("rep"), F.first("text").alias("text"))
                        .select("rep", "text"))

    def stars(of: DataFrame) -> DataFrame:
        return (of.where("rep <> center").select("rep", "center").distinct().join(sketches, "rep")
                .join(sketches.select(F.col("rep").alias("center"), F.col("n").alias("n_other"), F.col("sketch").alias("other")),
                      "center")
                .mapInArrow(_star_pairs(threshold), "rep long, center long, over double").where("over <= 0")
                .groupBy("rep").agg(F.min(F.struct("over", "center")).alias("best"))
                .select(F.col("best.center").alias("a"), F.col("rep").alias("b")))

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
        two = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
        return materialize(pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
                           .mapInArrow(_confirm(n, percent), "a long, b long, linked boolean"))

    # a doc_id with several texts ties their sets together
    several = (placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"))
               .where("a < z").select("doc_id", "a"))
    ties = materialize(placed.join(several, "doc_id").select("a", F.col("rep").alias("b")))
    tested: list[DataFrame] = []

    def so_far() -> DataFrame:
        every = tested[0]
        for t in tested[1:]:
            every = every.unionByName(t)
        return every

    def labelled(stale: DataFrame | None) -> DataFrame:
        """Labels with the latest links: those between labels make components of
        the labels that there were."""
        links = tested[-1].where("linked").select("a", "b")
        if stale is None:
            return materialize(connected_components(links.unionByName(ties)))
        for end in ("a", "b"):
            links = (links.join(stale.select(F.col("id").alias(end), F.col("label").alias("root")), end, "left")
                     .withColumn(end, F.coalesce("root", end)).drop("root"))
        merged = materialize(connected_components(links))
        moved = merged.select(F.col("id").alias("label"), F.col("label").alias("new"))
        # an old label is in no row of its own, so a merged one gets one here
        new = materialize(stale.join(moved, "label", "left").select("id", F.coalesce("new", "label").alias("label")).unionByName(merged))
        release(stale, merged)
        return new

    def named(of: DataFrame) -> DataFrame:
        return (of.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
                .select("key", "rep", "center", F.coalesce("label", "rep").alias("label")))

    def sizes(of: DataFrame) -> DataFrame:
        """Keys with several labels: the largest, all members, those outside it."""
        return (of.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"),
                                    F.count(F.lit(1)).alias("labels")).where("labels > 1")
                .select("key", F.col("top.label").alias("main"), "all", (F.col("all") - F.col("top.n")).alias("outside")))

    tested.append(confirmed(stars(buckets)))
    labels = labelled(None)
    fine, turn, most = buckets, 0, None
    while True:
        large = materialize(sizes(named(fine)).where(F.col("outside") > LARGE).select("key"))
        crowd = materialize(fine.join(large, "key", "left_semi").select("rep").distinct())
        many = crowd.count()
        if not many or (most is not None and 2 * many > most):
            release(large, crowd)
            break
        asked = texts.join(crowd, "rep", "left_semi")
        counts = asked.mapInArrow(_slot_counts(n, turn), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        scale = np.zeros(SLOTS, dtype=np.uint8)  # eighths of a doubling are told apart, a byte each
        scale[counts.column("slot").to_numpy()] = np.minimum(255, 1 + 8 * np.log2(counts.column("n").to_numpy()))
        finer = _met(asked.mapInArrow(_prefixes(spark.sparkContext.broadcast(scale), n, percent, turn), "rep long, key long"))
        rest = materialize(buckets.join(large, "key", "left_anti").unionByName(finer))
        tested.append(confirmed(stars(finer).join(so_far().select("a", "b"), ["a", "b"], "left_anti")))
        labels = labelled(labels)
        release(buckets, large, crowd, *([fine] if turn else []))
        buckets, fine, turn, most = rest, finer, turn + 1, many
    if turn:
        release(fine)

    fan, linked = 8, False
    keys = materialize(buckets.groupBy("rep").agg(F.collect_list("key").alias("keys")))
    while True:
        every = so_far()
        if linked:
            labels = labelled(labels)
        own = named(buckets)
        mixed = (own.join(sizes(own).select("key", "main", F.ceil(F.col("all") / BLOCK).cast("int").alias("there"),
                                            F.ceil(F.col("outside") / BLOCK).cast("int").alias("asking")), "key").join(sketches, "rep").join(keys, "rep")
                 .withColumn("asks", F.col("label") != F.col("main"))
                 .withColumn("slot", F.xxhash64("rep")))
        targets = (mixed.withColumn("i", F.pmod("slot", "there").cast("int"))
                   .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)))
                   .withColumn("asks", F.lit(False)))
        asking = (mixed.where("asks").withColumn("j", F.pmod("slot", "asking").cast("int"))
                  .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("there") - 1))))
        columns = ["key", "i", "j", "rep", "label", "asks", "n", "sketch", "keys"]
        close = (targets.select(columns).unionByName(asking.select(columns)).groupBy("key", "i", "j")
                 .applyInArrow(_close_pairs(threshold, fan), "a long, b long, more boolean"))
        pairs = materialize(close.groupBy("a", "b").agg(F.max("more").alias("more")))
        fresh = confirmed(pairs.select("a", "b").join(every.select("a", "b").distinct(), ["a", "b"], "left_anti"))
        left = pairs.agg(F.max("more").alias("more")).first()["more"]
        new = fresh.agg(F.count(F.lit(1)).alias("n"), F.max("linked").alias("linked")).first()
        release(pairs)
        linked = bool(new["linked"])
        if not left and not linked:
            release(fresh)
            break
        tested.append(fresh)
        fan *= 8

    # a hashed set is tied to its doc_id, so its component's smallest doc_id is there, too
    renamed = materialize(labels.join(hashed.select(F.col("rep").alias("label")), "label", "left_semi")
                          .join(hashed.select(F.col("rep").alias("id")), "id", "left_anti")
                          .groupBy("label").agg(F.min("id").alias("smallest")))
    release(sets, crowded, hashed, buckets, keys, texts, ties, *tested)
    return (placed.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
            .withColumn("label", F.coalesce("label", "rep")).join(renamed, "label", "left")
            .select("doc_id", "n_shingles", F.coalesce("smallest", "label", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
