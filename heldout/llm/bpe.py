"""BPE encoding and decoding with merge rounds in numpy.

A tokenizer file of the tokenizers library is read as plain data: vocabulary,
ranked merges, word-end suffix and special strings.  Texts are cut into words
as that file asks (NFC, white space, lower case; contractions, letters, single
digits, other signs), and the words' bytes become symbols.  All new words of a
batch lie in one flat symbol array.  A round looks every adjacent pair up by
binary search over the sorted pair keys, takes the lowest rank of each word and
merges it wherever it stands, left to right; words without a known pair leave.

Chunks between ASCII white space are encoded once per worker and remembered, up
to a number of bytes (long chunks never):
no rule of such a file looks across white space, nor from an ASCII letter to an
ASCII sign behind it, so a text is also cut there.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from heldout.llm import common
from heldout.session import ship

#: Pre-tokenizer pattern of the file format (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTER, _SIGN = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*range(0x61, 0x7B)]] = True
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_NO_RANK = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 signs stand for
    themselves, the others for U+0100 and on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(other)) for b in range(256)]


class Bpe:
    """Vocabulary and merges of one tokenizer file."""

    def __init__(self, source: str) -> None:
        data = json.loads(source)
        model = data["model"]
        steps = [x["type"] for x in (data["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or data["decoder"] is not None \
                or not model["end_of_word_suffix"] or WORDS not in json.dumps(data["pre_tokenizer"]).encode().decode("unicode_escape"):
            raise ValueError("not a lower-casing word BPE file without a decoder")
        vocab = model["vocab"]
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in (*vocab.items(), *self.special.items()):
            self.tokens[i] = token.encode()
        end = model["end_of_word_suffix"]
        self.end = end.encode()
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.final = np.array([vocab[x + end] for x in letters], dtype=np.int64)
        left, right, made = [], [], []
        for a, b in model["merges"]:
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        keys = np.array(left, dtype=np.int64) << 32 | np.array(right, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, np.array(made, dtype=np.int64)[order]
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self._words = regex.compile(WORDS)
        self._compose, self._lower = normalizers.NFC(), normalizers.Lowercase()
        self._newer = pre_tokenizers.Split(Regex(WORDS), "removed", invert=True)

    def _split(self, chunk: str) -> list[bytes | int]:
        """Words (bytes) and special ids of a chunk, in order."""
        out: list[bytes | int] = []
        for i, part in enumerate(self._cut.split(chunk) if self._cut else [chunk]):
            if i % 2:
                out.append(self.special[part])
            elif part:
                if not part.isascii() and "Cn" in map(unicodedata.category, part):
                    # signs newer than Python's tables: what the library's own tables say
                    part = self._lower.normalize_str(self._compose.normalize_str(part))
                    words = [w for w, _ in self._newer.pre_tokenize_str(part)]
                else:
                    part = unicodedata.normalize("NFC", part)
                    # sign by sign: a sigma is lower-cased alike wherever it stands
                    part = part.lower() if "Σ" not in part else "".join(map(str.lower, part))
                    words = self._words.findall(part)
                out += [w.encode() for w in words]
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words, one after another, and how many each has."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        out_size = size.copy()
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids, word = self.inner[raw], np.repeat(np.arange(len(words)), size)
        if len(words):
            last = np.cumsum(size) - 1
            ids[last] = self.final[raw[last]]
        done_ids, done_word = [], []
        while len(ids):
            pair = np.full(len(ids), _NO_RANK)
            same = np.flatnonzero(word[1:] == word[:-1])
            key = ids[same] << 32 | ids[same + 1]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            pair[same[known]] = self.ranks[at[known]]
            new = np.full(len(ids), -1, dtype=np.int64)
            new[same[known]] = self.made[at[known]]
            head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.append(head, len(ids)))
            least = np.minimum.reduceat(pair, head)
            going = np.repeat(least != _NO_RANK, length)
            done_ids.append(ids[~going])
            done_word.append(word[~going])
            hit = going & (pair == np.repeat(least, length))
            # equal pairs that overlap (aaa): every other one of a run, from the left
            place = np.flatnonzero(hit)
            run = np.flatnonzero(np.concatenate([[True], np.diff(place) > 1])) if len(place) else place
            if len(run):
                nth = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
                place = place[nth % 2 == 0]
            ids[place] = new[place]
            going[place + 1] = False
            ids, word = ids[going], word[going]
        if done_word:
            ids, word = np.concatenate(done_ids), np.concatenate(done_word)
            order = np.argsort(word, kind="stable")
            ids, out_size = ids[order], np.bincount(word, minlength=len(words))
        return ids, out_size

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks, one after another, and how many each has."""
        # bare lower-case ASCII letters are one word as they stand
        parts = [[c] if c.isalpha() and c.islower() else self._split(c.decode()) for c in chunks]
        index: dict[bytes, int] = {}
        place = [index.setdefault(w, len(index)) if isinstance(w, bytes) else -1 - w for p in parts for w in p]
        ids, size = self.merge(list(index))
        start, place = common.offsets(size), np.array(place, dtype=np.int64)
        word = place >= 0
        many = np.ones(len(place), dtype=np.int64)
        many[word] = size[place[word]]
        # special ids lie behind the words' ids
        extra = -1 - place[~word]
        first = np.empty(len(place), dtype=np.int64)
        first[word] = start[place[word]]
        first[~word] = len(ids) + np.arange(len(extra))
        flat = np.concatenate([ids, extra])[common.spans(first, many)]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        return flat, np.bincount(owner, weights=many, minlength=len(parts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens joined by one space, as a file without a decoder asks."""
        return b" ".join([self.tokens[i] for i in ids.tolist()])


class Remembered:
    """Encoder of whole texts from an encoder of chunks, remembering chunks."""

    def __init__(self, encode_chunks: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 special: Iterable[str]) -> None:
        self._memory = common.Memory(encode_chunks)
        self._special = [x.lower().encode() for x in special]

    def _cut(self, text: bytes) -> list[bytes]:
        """Chunks of a text, lower-cased; as they are if it may hold special
        strings, whose case counts."""
        lower = text.lower()
        if any(x in lower for x in self._special):
            return text.split()
        raw = np.frombuffer(lower, dtype=np.uint8)
        seams = np.flatnonzero(_LETTER[raw[:-1]] & _SIGN[raw[1:]]) + 1
        return np.insert(raw, seams, 0x20).tobytes().split()

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [self._cut(t) for t in texts]
        ends = common.offsets([len(w) for w in split])
        flat, size = self._memory.ids(chain.from_iterable(split), int(ends[-1]))
        ends = common.offsets(size)[ends]
        return [flat[ends[i]:ends[i + 1]] for i in range(len(split))]


_KNOWN: dict[int, tuple[Bpe, Remembered]] = {}


def _loaded(source: str) -> tuple[Bpe, Remembered]:
    key = hash(source)
    if key not in _KNOWN:
        _KNOWN.clear()
        bpe = Bpe(source)
        _KNOWN[key] = bpe, Remembered(bpe.encode_chunks, bpe.special)
    return _KNOWN[key]


def _runner(sent, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = _loaded(sent.value)
        for piece in common.pieces(batches, "text", 1 << 20):
            ids = known.encode(common.text_bytes(piece))
            columns = [piece.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                       pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
            if decode:
                columns.append(pa.array([bpe.decode(x) for x in ids], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"][:len(columns)])
    return run


def _sent(docs: DataFrame, path: str):
    ship(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def encode(docs: DataFrame, path: str, decode: bool = False) -> DataFrame:
    """Rows (doc_id, n_tokens, ids), one for each row of ``docs`` (doc_id,
    text; other columns are ignored): the ids of the whole text, as
    little-endian unsigned 32-bit integers in one binary.  With ``decode`` also
    ``decoded``, the text that those ids give.  Null and empty texts have no
    ids.  ``path`` is the tokenizer file on the driver; its content (about
    2 MB) is broadcast.  No shuffle; rows keep null and repeated ids.
    """
    schema = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_runner(_sent(docs, path), decode), schema))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, decoded) from rows (doc_id, ids); null ids are empty."""
    sent = _sent(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = _loaded(sent.value)
        for piece in common.pieces(batches, "ids", 1 << 21):
            texts = [bpe.decode(np.frombuffer(x or b"", dtype="<u4")) for x in piece.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "decoded"])
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, decoded string")
