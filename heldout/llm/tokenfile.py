"""Token ids of documents in shards with Elias-Fano coded document boundaries.

A dataset is a folder of Parquet files written by Spark, so tasks commit it
safely on any file system that Spark writes to.  Each row is a shard (part,
seq, n_docs, n_ids, payload): shards in order of (part, seq) hold the documents
in ascending doc_id order.  A payload is little-endian:

    8 bytes   "HOTOKEN1"
    u64 x 5   documents, ids, bytes per id, documents with a null doc_id, least doc_id (as u64)
    sequence  ends of the documents in the id array
    sequence  doc_id less the least one, nulls left out
    ids       one array of all documents' ids

and a sequence of n ascending numbers below 2^64 is Elias-Fano coded:

    u64 x 3   n, low bits l, bytes of the high part
    low       the l low bits of every number, packed
    high      a 1 bit at place (number >> l) + i for the i-th number
    samples   u32: the place of every 64th 1 bit

That is about 2 + log2(largest / n) bits a number in place of 64.  Select of one
number reads one sample and scans on from there; select of many counts the 1 bits
of the high part's bytes once and looks each number's byte up.  Documents are
read by their offsets from select, all of a shard or chosen ones.
"""

from __future__ import annotations

import os
import struct
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heldout.llm import common
from heldout.llm.bpe import Bpe, Remembered, _sent, byte_letters
from heldout.session import ship

MAGIC = b"HOTOKEN1"
#: Ids that a shard holds, unless one document alone has more.
SHARD_IDS = 1_000_000
SAMPLE = 64
#: Place of the k-th 1 bit of each byte.
_NTH_BIT = np.array([([i for i in range(8) if b >> i & 1] + [8] * 8)[:8] for b in range(256)], dtype=np.int64)


class EliasFano:
    """An ascending sequence of unsigned numbers; any one by its place."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.low_bits, self._low, self._high, self._samples = n, low_bits, low, high, samples
        self._ones: np.ndarray | None = None

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        numbers = np.asarray(numbers, dtype=np.uint64)
        n = len(numbers)
        top = int(numbers[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.zeros(0, dtype=np.uint8)
        if bits and n:
            each = (numbers[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(each.astype(np.uint8).ravel(), bitorder="little")
        place = (numbers >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        mark = np.zeros((int(place[-1]) + 1 + 7) // 8 * 8 if n else 0, dtype=np.uint8)
        mark[place] = 1
        return cls(n, bits, low, np.packbits(mark, bitorder="little"), place[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack("<3Q", self.n, self.low_bits, len(self._high)) + self._low.tobytes() \
            + self._high.tobytes() + self._samples.tobytes()

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The sequence that starts at byte ``at``, and the byte behind it."""
        n, bits, size = struct.unpack_from("<3Q", data, at)
        at += 24
        parts = []
        for count, kind in (((n * bits + 7) // 8, np.uint8), (size, np.uint8), (-(-n // SAMPLE), "<u4")):
            parts.append(np.frombuffer(data, dtype=kind, count=count, offset=at))
            at += parts[-1].nbytes
        return cls(n, bits, *parts), at

    def _low_of(self, i: int) -> int:
        if not self.low_bits:
            return 0
        bit = i * self.low_bits
        raw = int.from_bytes(self._low[bit >> 3:(bit + self.low_bits + 7) >> 3].tobytes(), "little")
        return raw >> (bit & 7) & (1 << self.low_bits) - 1

    def select(self, i: int) -> int:
        """The i-th number."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte = place >> 3
        word = int(self._high[byte]) >> (place & 7) << (place & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self._high[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return (place - i) << self.low_bits | self._low_of(i)

    def selects(self, places: np.ndarray) -> np.ndarray:
        """The numbers at some places."""
        places = np.asarray(places, dtype=np.int64)
        if len(places) and not 0 <= places.min() <= places.max() < self.n:
            raise IndexError(places)
        if self._ones is None:
            self._ones = common.offsets(np.bitwise_count(self._high))
        byte = np.searchsorted(self._ones, places, side="right") - 1
        bit = byte * 8 + _NTH_BIT[self._high[byte], places - self._ones[byte]]
        out = (bit - places).astype(np.uint64) << np.uint64(self.low_bits)
        for i in range(self.low_bits):
            at = places * self.low_bits + i
            out |= ((self._low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(i)
        return out


class Shard:
    """A shard's documents, from its payload."""

    def __init__(self, payload: bytes) -> None:
        data = memoryview(payload)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a shard of token ids")
        self.n_docs, self.n_ids, width, self._nulls, least = struct.unpack_from("<5Q", data, 8)
        self.ends, at = EliasFano.read(data, 48)
        self._doc_ids, at = EliasFano.read(data, at)
        self._least = least
        self.ids = np.frombuffer(data, dtype=f"<u{width}", count=self.n_ids, offset=at)

    @staticmethod
    def pack(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
        """The payload of documents whose ids ascend, nulls first."""
        known = [x for x in doc_ids if x is not None]
        least = known[0] if known else 0
        rest = np.array([x - least for x in known], dtype=np.uint64)
        flat = np.concatenate(ids) if ids else np.empty(0)
        return b"".join([MAGIC, struct.pack("<5Q", len(ids), len(flat), width, len(doc_ids) - len(known), least % (1 << 64)),
                         EliasFano.of(np.cumsum([len(x) for x in ids], dtype=np.uint64)).to_bytes(),
                         EliasFano.of(rest).to_bytes(), flat.astype(f"<u{width}").tobytes()])

    def doc(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]

    def spans(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of some documents start and end."""
        ends = self.ends.selects(places).astype(np.int64)
        start = np.zeros(len(places), dtype=np.int64)
        start[places > 0] = self.ends.selects(places[places > 0] - 1).astype(np.int64)
        return start, ends

    def doc_ids(self) -> list[int | None]:
        known = (self._doc_ids.selects(np.arange(self._doc_ids.n)) + np.uint64(self._least)).view(np.int64)
        return [None] * self._nulls + known.tolist()

    def places(self, doc_ids: np.ndarray) -> np.ndarray:
        """Places of the documents that have one of some ids."""
        known = (self._doc_ids.selects(np.arange(self._doc_ids.n)) + np.uint64(self._least)).view(np.int64)
        return np.flatnonzero(np.isin(known, doc_ids)) + self._nulls


#: The letters that stand for bytes.
_BYTES = dict(enumerate(byte_letters()))


def _letters(chunk: str) -> bool:
    """Whether normalising leaves a chunk as it is, and it is one run of letters."""
    return chunk.isalpha() and chunk == chunk.lower() and unicodedata.is_normalized("NFC", chunk)


class _Encoder:
    """Ids of texts from the tokenizers library."""

    def __init__(self, source: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_str(source)
        self._library.no_truncation()
        self._library.no_padding()
        self.size = self._library.get_vocab_size()
        try:  # a kind of file whose texts may be cut into chunks
            rules = Bpe(source)
        except ValueError:
            self._known = None
            return
        self._known = Remembered(self._chunks, rules.special)
        # of such a file, bare lower-case letters pass all steps before the model as
        # they are, but for the letters that stand for their bytes, so the library's
        # model alone gives their ids
        self._bare = Tokenizer(self._library.model)
        self._bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._last = np.array([t.endswith(rules.end) for t in rules.tokens])

    def _chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        bare = np.array([c.isalpha() and c.islower() or _letters(c.decode()) for c in chunks], dtype=bool)
        plain = [c.decode() if c.isascii() else c.decode("latin-1").translate(_BYTES)
                 for c, b in zip(chunks, bare, strict=True) if b]
        joined = self._bare.encode_batch_fast([" ".join(plain[i:i + 500]) for i in range(0, len(plain), 500)],
                                              add_special_tokens=False)
        first = np.array([i for x in joined for i in x.ids], dtype=np.int64)
        # each chunk is one word and ends with the only token that ends one
        ends = np.flatnonzero(self._last[first]) + 1
        lists = self._lists([c.decode() for c, b in zip(chunks, bare, strict=True) if not b])
        size = np.empty(len(chunks), dtype=np.int64)
        size[bare] = np.diff(ends, prepend=0)
        size[~bare] = [len(x) for x in lists]
        ids = np.concatenate([first, np.array([i for x in lists for i in x], dtype=np.int64)])
        start = np.empty(len(chunks), dtype=np.int64)
        start[bare] = np.cumsum(size[bare]) - size[bare]
        start[~bare] = len(first) + np.cumsum(size[~bare]) - size[~bare]
        return ids[common.spans(start, size)], size

    def _lists(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if self._known:
            return self._known.encode(texts)
        return [np.array(x, dtype=np.int64) for x in self._lists([t.decode() for t in texts])]


_SHARD = "part int, seq int, n_docs long, n_ids long, first_doc long, last_doc long, payload binary"
_ENCODERS: dict[int, _Encoder] = {}


def _packer(sent, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(sent.value)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = _Encoder(sent.value)
        encoder = _ENCODERS[key]
        width = 2 if max(encoder.size - 1, end_id) < 1 << 16 else 4
        part, seq, docs, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_docs": pa.array([len(docs)], pa.int64()), "n_ids": pa.array([held], pa.int64()),
                "first_doc": pa.array([next((d for d in docs if d is not None), None)], pa.int64()), "last_doc": pa.array([docs[-1]], pa.int64()),
                "payload": pa.array([Shard.pack(docs, ids, width)], pa.binary())})

        for piece in common.pieces(batches, "text", 1 << 20):
            for doc, own in zip(piece.column("doc_id").to_pylist(), encoder.encode(common.text_bytes(piece)), strict=True):
                if docs and held + len(own) + 1 > SHARD_IDS:
                    yield shard()
                    seq, docs, ids, held = seq + 1, [], [], 0
                docs.append(doc)
                ids.append(np.append(own, end_id))
                held += len(own) + 1
        if docs:
            yield shard()
    return run


def write_tokens(docs: DataFrame, tokenizer: str, to: str, end_id: int) -> None:
    """Encode every whole text of ``docs`` (doc_id, text; other columns are
    ignored) with the tokenizers library, append ``end_id``, and write the
    dataset at ``to``.

    Null and empty texts are the end id alone.  Rows without a doc_id come
    first; rows with one doc_id follow one another in order of a hash of their
    text.  An empty table gives a dataset without shards.
    """
    order = ("doc_id", "tie")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(_packer(_sent(docs, tokenizer), end_id), _SHARD)
     .write.option("compression", "zstd").parquet(to))


def _unpacker(chosen: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(c) for c in ("part", "seq", "payload")), strict=True):
                shard = Shard(payload.as_py())
                places = np.arange(shard.n_docs) if chosen is None else shard.places(chosen)
                start, ends = shard.spans(places)
                docs = pa.array(shard.doc_ids(), pa.int64()).take(pa.array(places))
                ids = [shard.ids[a:b].astype("<u4").tobytes() for a, b in zip(start, ends, strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part.as_py()] * len(places), pa.int32()), "seq": pa.array([seq.as_py()] * len(places), pa.int32()),
                    "doc_id": docs, "at": pa.array(start), "n_tokens": pa.array(ends - start), "ids": pa.array(ids, pa.binary())})
    return run


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """Rows (part, seq, doc_id, at, n_tokens, ids) of a dataset: ``at`` counts
    the ids of the documents before in the same shard, ``ids`` are
    little-endian u32.  With ``doc_ids`` only of documents with one of them: shards
    that cannot have one are not read (by the files' statistics), and of
    the others only those documents' ids are."""
    ship(spark)
    shards, chosen = spark.read.schema(_SHARD).parquet(path), None
    if doc_ids is not None:
        chosen = np.unique(np.array(list(doc_ids), dtype=np.int64))
        if not len(chosen):
            shards = shards.limit(0)
        else:
            shards = shards.where((F.col("last_doc") >= int(chosen[0])) & (F.col("first_doc") <= int(chosen[-1])))
    return shards.select("part", "seq", "payload").mapInArrow(
        _unpacker(chosen), "part int, seq int, doc_id long, at long, n_tokens long, ids binary")


def with_starts(docs: DataFrame, path: str) -> DataFrame:
    """Rows of ``read_tokens`` with ``start``, the ids of all documents before,
    in place of part, seq and at.

    Running totals go over parts (as many as the write had tasks), then over
    the shards of each part.  The join shuffles what columns ``docs`` has left,
    so take digests of long ones first.
    """
    shards = docs.sparkSession.read.schema(_SHARD).parquet(path).select("part", "seq", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(
        before(Window.partitionBy(F.lit(0)).orderBy("part"))), F.lit(0)).alias("base"))
    bases = shards.join(parts, "part").select("part", "seq", (F.col("base") + F.coalesce(F.sum("n_ids").over(
        before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))).alias("base"))
    return (docs.join(bases, ["part", "seq"]).withColumn("start", F.col("base") + F.col("at"))
            .drop("part", "seq", "at", "base"))
