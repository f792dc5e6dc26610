"""Document fingerprints from prefix polynomial hashes.

A text's code points are the coefficients of a polynomial; its prefix sums
modulo two primes below 2^31 answer the hash of any span by one subtraction
and one product.  So spans are compared without being read again, and the
longest common extension of two places is found by binary search on its
length.

A fingerprint is the hash of the whole text and the ``KEEP`` least of the
scrambled hashes of all its spans of ``SPAN`` code points.  The share that two
fingerprints have in the least of their union estimates how many spans of both
texts are common (standard deviation about 0.06).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heldout.llm import common
from heldout.llm.common import U64
from heldout.session import materialize, ship

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_566_083_941)
SPAN, KEEP = 12, 64


class _Powers:
    """Powers of a base and of its inverse modulo a prime, as far as asked."""

    def __init__(self, base: int, prime: int) -> None:
        self._base, self._prime = base, prime
        self._up = self._down = np.ones(1, dtype=np.int64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self._up) < n:
            m = len(self._up)
            up, down = pow(self._base, m, self._prime), pow(self._base, -m, self._prime)
            self._up = np.concatenate([self._up, self._up * up % self._prime])
            self._down = np.concatenate([self._down, self._down * down % self._prime])
        return self._up, self._down


_POWERS = [_Powers(b, p) for b, p in zip(BASES, PRIMES, strict=True)]


class PrefixHashes:
    """Prefix hash arrays over code points (32-bit)."""

    def __init__(self, points: np.ndarray) -> None:
        self.n = len(points)
        self._sums, self._down = [], []
        for powers, prime in zip(_POWERS, PRIMES, strict=True):
            up, down = powers.get(self.n + 1)
            sums = np.zeros(self.n + 1, dtype=np.int64)
            np.cumsum((points.astype(np.int64) + 1) * up[:self.n] % prime, out=sums[1:])
            sums %= prime
            self._sums.append(sums)
            self._down.append(down)

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end), alike wherever they lie."""
        one, two = ((sums[end] - sums[start]) % prime * down[start] % prime
                    for sums, down, prime in zip(self._sums, self._down, PRIMES, strict=True))
        return common.mix((one << 31 | two).astype(U64) + np.asarray(end - start).astype(U64) * U64(0x9E3779B97F4A7C15))

    def all_spans(self, size: int) -> np.ndarray:
        """Hashes of all spans of ``size`` code points."""
        m = max(0, self.n - size + 1)
        one, two = ((sums[size:size + m] - sums[:m]) % prime * down[:m] % prime
                    for sums, down, prime in zip(self._sums, self._down, PRIMES, strict=True))
        return common.mix((one << 31 | two).astype(U64) + U64(size * 0x9E3779B97F4A7C15 % (1 << 64)))

    def common_extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest equal spans that start at ``a`` and ``b``, up
        to ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.span(a, a + middle) == self.span(b, b + middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low


def sketches(texts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], PrefixHashes, np.ndarray]:
    """Whole-text hashes, least span hashes in order, the texts' prefix hashes
    one after another, and where each text starts."""
    at = common.offsets([len(t) for t in texts])
    hashes = PrefixHashes(np.concatenate(texts) if texts else np.empty(0, np.uint32))
    whole = hashes.span(at[:-1], at[1:])
    spans, least = hashes.all_spans(SPAN), []
    for i in range(len(texts)):
        own = spans[at[i]:at[i + 1] - SPAN + 1] if at[i + 1] - at[i] >= SPAN else whole[i:i + 1][:len(texts[i])]
        own = own >> U64(32)
        if len(own) > 8 * KEEP:  # equal spans may be among the least
            bound = np.partition(own, 4 * KEEP)[4 * KEEP]
            few = np.unique(own[own <= bound])
            own = few if len(few) >= KEEP else own
        least.append(np.unique(own)[:KEEP].astype(">u4"))
    return whole, least, hashes, at


def likeness(whole_a: int, least_a: np.ndarray, whole_b: int, least_b: np.ndarray) -> float:
    """Share of common spans, from two fingerprints; 1 for equal texts."""
    if whole_a == whole_b:
        return 1.0
    both = np.union1d(least_a, least_b)[:KEEP]
    if not len(both):
        return 1.0
    common_ = np.intersect1d(least_a, least_b, assume_unique=True)
    return len(np.intersect1d(both, common_, assume_unique=True)) / len(both)


def _compared(docs: list, points: list[np.ndarray], nexts: list[np.ndarray]) -> dict[str, pa.Array]:
    """Columns for documents and the texts behind them."""
    edited = []
    for own, nxt in zip(points, nexts, strict=True):
        swap = len(own) // 4
        edited.append(np.concatenate([own[:len(own) - swap], nxt[:swap]]))
    n = len(points)
    whole, least, hashes, at = sketches([*points, *edited])
    next_whole, next_least, _, _ = sketches(nexts)
    size = np.diff(at)
    return {
        "doc_id": pa.array(docs, pa.int64()), "n_chars": pa.array(size[:n], pa.int64()),
        "edited": pa.array([x.astype("<u4").tobytes().decode("utf-32-le") for x in edited], pa.string()),
        "print": pa.array([w.tobytes() + x.tobytes() for w, x in zip(whole[:n].astype(">u8"), least[:n], strict=True)], pa.binary()),
        "edited_print": pa.array([w.tobytes() + x.tobytes() for w, x in zip(whole[n:].astype(">u8"), least[n:], strict=True)], pa.binary()),
        "near_edited": pa.array([likeness(whole[i], least[i], whole[n + i], least[n + i]) for i in range(n)], pa.float64()),
        "near_next": pa.array([likeness(whole[i], least[i], next_whole[i], next_least[i]) for i in range(n)], pa.float64()),
        "same_edited": pa.array(hashes.common_extension(at[:n], at[n:2 * n], np.minimum(size[:n], size[n:])), pa.int64()),
    }


_KINDS = ("done", "last", "first")
_COLUMNS = ("doc_id long, n_chars long, edited string, print binary, edited_print binary, near_edited double, "
            "near_next double, same_edited long")


def _points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), dtype="<u4")


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each text of a sorted partition with the one behind it; hands
    on the first, and the last, whose next is in another partition."""
    part, held = TaskContext.get().partitionId(), None

    def row(kind: str, doc, text: np.ndarray) -> pa.RecordBatch:
        blank = {n: pa.nulls(1, t) for n, t in (("n_chars", pa.int64()), ("edited", pa.string()), ("print", pa.binary()),
                 ("edited_print", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("same_edited", pa.int64()))}
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "kind": [kind], "text": [
            text.tobytes().decode("utf-32-le")], "doc_id": pa.array([doc], pa.int64()), **blank})

    for piece in common.pieces(batches, "text", 1 << 20):
        docs = piece.column("doc_id").to_pylist()
        points = [_points(t) for t in piece.column("text").to_pylist()]
        if held is None:
            yield row("first", docs[0], points[0])
        else:
            docs, points = [held[0], *docs], [held[1], *points]
        held = docs[-1], points[-1]
        n = len(docs) - 1
        if n:
            done = _compared(docs[:-1], points[:-1], points[1:])
            yield pa.RecordBatch.from_pydict({"part": pa.array([part] * n, pa.int32()), "kind": ["done"] * n,
                                              "text": pa.nulls(n, pa.string()), **done})
    if held is not None:
        yield row("last", *held)


def _over_seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in common.pieces(batches, "text", 1 << 20):
        yield pa.RecordBatch.from_pydict(_compared(piece.column("doc_id").to_pylist(), *(
            [_points(t) for t in piece.column(c).to_pylist()] for c in ("text", "next"))))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, same_edited), one for each row of ``docs``
    (doc_id, text; other columns are ignored).

    The edited text has the last quarter of its code points (rounded down)
    replaced by the first as many, or all, of the next document's in ascending
    doc_id order, the first following the last.  ``near_`` columns are the
    likeness of fingerprints; ``same_edited`` is the number of code points from
    the start that the edit left alone.  Null texts are empty; two empty texts
    are equal.  Null doc_ids come first; rows with one doc_id follow one
    another in order of a hash of their text.  A single row follows itself.

    The texts are range-partitioned once; where a partition ends, its last row
    meets the next partition's first (one row each a partition).
    """
    ship(docs.sparkSession)
    order = ("doc_id", "tie")
    compared = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
                .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
                .mapInArrow(_in_order, f"part int, kind string, text string, {_COLUMNS}"))
    shown = [c.split()[0] for c in _COLUMNS.split(", ")]
    rows = materialize(compared.select("part", "kind", "text", *[c for c in shown if c != "edited"],
                                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")))
    firsts = rows.where("kind = 'first'").select("part", F.col("text").alias("next"))
    # the part behind each; one row a partition
    parts = firsts.select("part").withColumn("only", F.lit(0))
    behind = parts.select("part", F.coalesce(
        F.lead("part").over(Window.partitionBy("only").orderBy("part")),
        F.min("part").over(Window.partitionBy("only"))).alias("behind"))
    seams = (rows.where("kind = 'last'").select("part", "doc_id", "text").join(behind, "part")
             .join(firsts.withColumnRenamed("part", "behind"), "behind").select("doc_id", "text", "next")
             .mapInArrow(_over_seams, _COLUMNS)
             .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited"))
    done = rows.where("kind = 'done'").drop("part", "kind", "text")
    return done.unionByName(seams).select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"), "near_edited", "near_next", "same_edited")
