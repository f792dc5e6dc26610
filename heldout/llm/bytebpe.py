"""Byte-level BPE through a sentencepiece model made from the rank file.

A rank file lists byte strings by rank.  It is serialised as a sentencepiece BPE
model, field by field: each byte string becomes a piece of letters (one stands
for each byte), with minus its rank as score, and the normaliser is the identity,
without dummy prefix or white-space rules.  Sentencepiece merges the adjacent
pair with the best score, the leftmost among equals, which is the rank file's
own rule.  Byte strings that their own merges would not reach are looked up
first, as that rule has it.

A text is cut into pre-tokens by the pattern of the vocabulary; each is
encoded once per worker and remembered, up to a number of bytes.  Decoding turns
pieces back into bytes by the inverse of the letters.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heldout.llm import common
from heldout.session import ship

#: Signs of text that are cut and looked up at a time.
BLOCK = 1 << 18
#: A place where no match goes on: white space behind another sign.
_SEAM = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n])")
#: Letters that stand for bytes: visible ASCII for itself, U+0100 and on for the rest.
LETTERS = [chr(b) if 0x21 <= b < 0x7F else chr(0x100 + b) for b in range(256)]
_TO_LETTERS = dict(enumerate(LETTERS))
_TO_BYTES = {ord(c): b for b, c in enumerate(LETTERS)}


def read_ranks(source: str) -> dict[bytes, int]:
    """Ranks of a file of lines: byte string in base 64, rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(str.split, filter(None, source.splitlines()))}


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(tag: int, value: bytes | float | int) -> bytes:
    """A protocol buffer field: bytes, a float or a number."""
    if isinstance(value, bytes):
        return _number(tag << 3 | 2) + _number(len(value)) + value
    if isinstance(value, float):
        return _number(tag << 3 | 5) + struct.pack("<f", value)
    return _number(tag << 3) + _number(value % (1 << 64))


def serialised(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose id i is the byte string of rank i; the id
    behind the last is the unknown piece, which any byte string avoids."""
    order = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in order] != list(range(len(order))) or len(order) >= 1 << 24 or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be 0, 1, 2 ... and hold every byte")
    # fixed values: numbers and kinds of the public model format
    normal, unknown, bpe, none = 1, 2, 2, -1
    pieces = [_field(1, _field(1, in_letters(t).encode()) + _field(2, -float(i)) + _field(3, normal)) for i, t in enumerate(order)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(order)) + _field(41, none) + _field(42, none) + _field(43, none)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


def in_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_LETTERS)


def stand_ins(classes: tuple[str, ...] = (r"\p{L}", r"\p{N}", r"\s")) -> dict[str, str]:
    """Signs that the splitting library and the vocabulary's own class in
    different ways, as their Unicode versions differ, by a sign of the class that
    the latter has them in: ranges as the body of a character set."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    theirs = [{*bytes(tiktoken.Encoding("class", pat_str=c, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()} for c in classes]
    ours = [{*regex.findall(c, every)} for c in classes]
    odd = set().union(*(a ^ b for a, b in zip(theirs, ours, strict=True)))
    out = {}
    for sign, group in zip(("ª", "²", " ", "¤"), [*theirs, set(every).difference(*theirs)], strict=True):
        points, ranges = sorted(map(ord, odd & group)), []
        for p in points:
            if ranges and ranges[-1][1] == p - 1:
                ranges[-1][1] = p
            else:
                ranges.append([p, p])
        if ranges:
            out[sign] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
    return out


class Codec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, source: str, pattern: str, odd: dict[str, str]) -> None:
        ranks = read_ranks(source)
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialised(ranks))
        self._pattern = regex.compile(pattern)
        self._odd = [(sign, re.compile(f"[{body}]")) for sign, body in odd.items()]
        pieces = [self._model.id_to_piece(i) for i in range(len(ranks))]
        self.tokens = [p.translate(_TO_BYTES).encode("latin-1") for p in pieces]
        found = self._model.encode(pieces, num_threads=1)
        self._whole = {p: [i] for i, (p, ids) in enumerate(zip(pieces, found, strict=True)) if ids != [i]}
        self._memory = common.Memory(self._chunks)

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        told = text
        if not text.isascii():
            for sign, pattern in self._odd:
                told = pattern.sub(sign, told)
        if told is text or told == text:
            return self._pattern.findall(text)
        return [text[m.start():m.end()] for m in self._pattern.finditer(told)]

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = [in_letters(c.encode()) for c in chunks]
        lists = self._model.encode(pieces, num_threads=1)
        if self._whole:
            lists = [self._whole.get(p, ids) for p, ids in zip(pieces, lists, strict=True)]
        size = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(size.sum())), size

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, looked up a block at a time."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        group: list[tuple[int, list[str]]] = []
        held = 0

        def look_up() -> None:
            ends = common.offsets([len(x) for _, x in group])
            flat, size = self._memory.ids(chain.from_iterable(x for _, x in group), int(ends[-1]))
            at = common.offsets(size)[ends]
            for j, (i, _) in enumerate(group):
                out[i].append(flat[at[j]:at[j + 1]])

        for i, text in enumerate(texts):
            for block in blocks(text):
                group.append((i, self.split(block)))
                held += len(block)
                if held >= BLOCK:
                    look_up()
                    group, held = [], 0
        if group:
            look_up()
        return [np.concatenate(x) if len(x) > 1 else x[0] for x in out]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def blocks(text: str) -> Iterator[str]:
    """Parts of a text of at least ``BLOCK`` signs (but the last) whose
    pre-tokens, one after another, are the text's."""
    start = 0
    while len(text) - start > BLOCK:
        seam = _SEAM.search(text, start + BLOCK)
        if not seam:
            break
        yield text[start:seam.start()]
        start = seam.start()
    yield text[start:]


_KNOWN: dict[int, Codec] = {}


def _loaded(sent) -> Codec:
    key = hash((sent[0], sent[1]))
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Codec(*sent)
    return _KNOWN[key]


def _encoder(sent, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _loaded(sent.value)
        for piece in common.pieces(batches, "text", 1 << 20):
            ids = codec.encode([t or "" for t in piece.column("text").to_pylist()])
            columns = [piece.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                       pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
            if decode:
                columns.append(pa.array(map(codec.decode, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"][:len(columns)])
    return run


def _sent(df: DataFrame, path: str, pattern: str):
    ship(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast((Path(path).read_text(encoding="ascii"), pattern, stand_ins()))


def encode(docs: DataFrame, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """Rows (doc_id, n_tokens, ids), one for each row of ``docs`` (doc_id,
    text; other columns are ignored): the ids of the whole text as
    little-endian unsigned 32-bit integers in one binary, no special tokens.
    With ``decode`` also ``decoded``, the bytes that those ids stand for.

    ``path`` is the rank file on the driver (its content, under 1 MB for
    50,000 ranks, is broadcast), ``pattern`` cuts texts into pre-tokens; matches
    of it must end where white space follows another sign.  Null and empty
    texts have no ids.  Rows keep null and repeated ids.  No shuffle; a worker
    holds a batch's texts and ids, and its memory of pre-tokens.
    """
    schema = "doc_id long, n_tokens long, ids binary" + ", decoded binary" * decode
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_encoder(_sent(docs, path, pattern), decode), schema))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows (doc_id, decoded) from rows (doc_id, ids); null ids are empty."""
    sent = _sent(encoded, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _loaded(sent.value)
        for piece in common.pieces(batches, "ids", 1 << 21):
            raw = [codec.decode(np.frombuffer(x or b"", dtype="<u4")) for x in piece.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "decoded"])
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, decoded binary")
