"""Resampling documents towards a target distribution by importance weights.

Features are runs of one to ``most`` consecutive words, hashed into buckets.
A bucket's gain is the scaled log ratio of its share in the target texts to
its share in all documents; a document's weight is the mean gain of its
features.  Documents are drawn by weight plus Gumbel noise that is seeded by
their ids, which draws without replacement in proportion to exp(weight).

Texts go through Arrow kernels: ascii_lower, split_pattern_regex, list_flatten
and dictionary_encode turn a batch into word indices; indices that are shifted
against one another make longer runs, of which only distinct ones are hashed
(CRC-32, carried on from the run one word shorter); take and a segment sum
over documents give the weights.

The corpus is read twice: counts of buckets (one bounded array a task, added
up over tasks), then weights.  The gains are a table of ``buckets`` numbers,
which bounds what is collected and broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.llm import common
from heldout.operators.ranking import global_row_index
from heldout.session import materialize, ship

BUCKETS = 10_000
#: What lies between words, once A-Z are lower-cased (fixed value).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Gains and noise are whole thousandths.
SCALE = 1000


def grams(texts: pa.Array, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... ``most`` words: the row and bucket of every run of
    every text, in order of rows."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")), pattern=BETWEEN)
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # a text that begins or ends between words has an empty piece there
    there = pc.not_equal(flat, "")
    coded = flat.filter(there).dictionary_encode()
    row = row.filter(there).to_numpy()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    index = coded.indices.to_numpy().astype(np.int64)
    crc = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
    run = index
    yield row, crc[run] % buckets
    spaced = [b" " + w for w in words] if most > 1 else []
    for n in range(2, most + 1):
        # run i of n - 1 words goes on with word i + n - 1, if that is in the same text
        m = max(0, len(row) - n + 1)
        inside = np.flatnonzero(row[:m] == row[n - 1:])
        pairs = pa.array(run[inside] * len(words) + index[inside + n - 1]).dictionary_encode()
        first, last = np.divmod(pairs.dictionary.to_numpy(), max(len(words), 1))
        crc = np.fromiter((zlib.crc32(spaced[b], int(crc[a])) for a, b in zip(first.tolist(), last.tolist(), strict=True)),
                          dtype=np.int64, count=len(first))
        run = np.zeros(len(row), dtype=np.int64)
        run[inside] = pairs.indices.to_numpy()
        yield row[inside], crc[run[inside]] % buckets


def _counter(most: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for piece in common.pieces(batches, "text", 1 << 20):
            for _, bucket in grams(piece.column("text"), most, buckets):
                total += np.bincount(bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": met, "n": total[met]})
    return run


def bucket_counts(texts: DataFrame, most: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, n): how many runs of all texts fall in each bucket that
    has any.  A task sends at most ``buckets`` rows."""
    ship(texts.sparkSession)
    return (texts.select("text").mapInArrow(_counter(most, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, floored."""
    total, wanted = sum(source.values()) + buckets, sum(target.values()) + buckets
    return np.array([math.floor(SCALE * math.log(float((target.get(b, 0) + 1) * total) / float((source.get(b, 0) + 1) * wanted)))
                     for b in range(buckets)], dtype=np.int64)


def _weigher(sent, most: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = pa.array(sent.value)
        for piece in common.pieces(batches, "text", 1 << 20):
            n, total = np.zeros(piece.num_rows, dtype=np.int64), np.zeros(piece.num_rows, dtype=np.int64)
            words = None
            for row, bucket in grams(piece.column("text"), most, buckets):
                own = np.bincount(row, minlength=piece.num_rows)
                words = own if words is None else words
                n += own
                if len(row):
                    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                    total[row[head]] += np.add.reduceat(gain.take(pa.array(bucket)).to_numpy(), head)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, (words, n, weight))],
                                             names=["doc_id", "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most: int = 1,
             buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score, rank), one for each
    row of ``docs`` (doc_id, text; other columns are ignored), weighted towards
    the texts of ``target`` (text).

    Of the documents with at least ``least_words`` words ``percent`` in a
    hundred (floored) are drawn, those with the highest scores, ties to the
    smaller doc_id; ``rank`` is their place from 1, null for all others.  Null,
    empty and wordless texts have no features and weight 0.  Rows with one
    doc_id have the same noise, and go by their feature counts if their
    scores are equal, too.  A null doc_id draws as an empty one, behind equal
    scores.  With an empty target all gains follow from smoothing alone; an
    empty ``docs`` gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most ``buckets`` rows each
    source, wanted = (dict(map(tuple, bucket_counts(t, most, buckets).collect())) for t in (docs, target))
    sent = spark.sparkContext.broadcast(gains(source, wanted, buckets))
    weighed = docs.mapInArrow(_weigher(sent, most, buckets), "doc_id long, n_words long, n_features long, weight long")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(1 << 32))))).cast("long")
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise))
    able = F.col("n_words") >= least_words
    count = scored.where(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "n_words"]
    placed = global_row_index(scored.where(able), [F.col(c) if isinstance(c, str) else c for c in order], "place")
    return (placed.withColumn("rank", F.when(F.col("place") < count, F.col("place") + 1)).drop("place")
            .unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long"))))
