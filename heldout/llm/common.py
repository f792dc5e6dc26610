"""Helpers shared by the operators: word hashes, batch slicing, row groups."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
#: Bytes that a worker's memory of words or chunks takes before it starts anew.
MEMORY = 64 << 20
#: Longest word or chunk that is remembered at all, and about what an entry takes
#: beside its key.
LONGEST, ENTRY = 64, 110


class Numbers(dict):
    """Key to its number, in order of first sight.  ``fresh`` lists keys that
    were new; keys too long to remember are in ``long``, number -1 and down,
    each time that they are met."""

    def __init__(self) -> None:
        self.fresh: list[Hashable] = []
        self.long: list[Hashable] = []
        self.held = 0

    def __missing__(self, key) -> int:
        if len(key) > LONGEST:
            self.long.append(key)
            return -len(self.long)
        number = self[key] = len(self)
        self.fresh.append(key)
        self.held += sys.getsizeof(key) + ENTRY
        return number


class Memory:
    """An encoder of chunks (a list of them to their ids, one after another, and
    how many each has) that remembers what it has encoded, up to ``MEMORY`` bytes
    and what one call brings."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]]) -> None:
        self._encode = encode
        self._forget()

    def _forget(self) -> None:
        self._numbers = Numbers()
        self._ids, self._at = np.empty(1 << 16, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def ids(self, chunks: Iterable, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``count`` chunks and how many each has."""
        if self._numbers.held + self._ids.nbytes + self._at.nbytes > MEMORY:
            self._forget()
        numbers = self._numbers
        place = np.fromiter(map(numbers.__getitem__, chunks), dtype=np.int64, count=count)
        at, known = self._at, len(self._at) - 1
        if numbers.fresh or numbers.long:
            fresh = len(numbers.fresh)
            ids, size = self._encode(numbers.fresh + numbers.long)
            used = int(at[-1])
            while used + len(ids) > len(self._ids):
                self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
            self._ids[used:used + len(ids)] = ids
            at = np.concatenate([at, used + np.cumsum(size)])
            self._at = at[:known + fresh + 1]
            place = np.where(place < 0, known + fresh - 1 - place, place)
            numbers.fresh, numbers.long = [], []
        size = at[place + 1] - at[place]
        return self._ids[spans(at[place], size)], size


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``limit`` bytes (or
    one row, if that row alone is longer)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
#: Letters' values and bases of two independent hashes of words; the values are drawn.
_VALUES = np.random.Generator(np.random.PCG64(77)).integers(1, 2**64, (2, 256), dtype=U64)
_BASES = (0x9E3779B97F4A7C55, 0xD1B54A32D192ED03)
#: Bytes of text that are hashed at a time.
HASHED = 1 << 18


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as asked."""

    def __init__(self, base: int) -> None:
        self._base = base
        self._up = self._down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            m = 1 << (n - 1).bit_length()
            self._up, self._down = (np.concatenate([np.ones(1, U64), np.cumprod(np.full(m - 1, b, dtype=U64))])
                                    for b in (self._base, pow(self._base, -1, 1 << 64)))
        return self._up, self._down


_POWERS = [Powers(b) for b in _BASES]


def word_hashes(texts: list[bytes], kinds: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all texts' words (runs of bytes that are no ASCII white space), one
    after another, ``kinds`` independent ones, and where each text's words start.

    A word of up to ``LONGEST`` bytes is a polynomial of its bytes' values, from prefix
    sums over the text; of longer ones, whose polynomials modulo 2^64 could be made
    to collide, it is the bytes' own 64-bit hash.
    """
    joined = b"\n".join([*texts, b""])
    raw = np.frombuffer(joined, dtype=np.uint8)
    gap = _GAP[raw]
    before = np.concatenate([[True], gap[:-1]])
    start, end = np.flatnonzero(before & ~gap), np.flatnonzero(gap & ~before)
    at = np.searchsorted(start, offsets([len(t) + 1 for t in texts]))
    size = end - start
    out = [np.empty(len(start), dtype=U64) for _ in range(kinds)]
    i = 0
    while i < len(start):
        low = int(start[i])
        j = max(i + 1, int(np.searchsorted(start, low + HASHED)))
        part = raw[low:min(int(end[j - 1]), low + HASHED + LONGEST)]
        # beyond the part there are ends of long words only
        one, two = start[i:j] - low, np.minimum(end[i:j] - low, len(part))
        for k in range(kinds):
            up, down = _POWERS[k].get(HASHED + LONGEST + 1)
            sums = np.zeros(len(part) + 1, dtype=U64)
            np.cumsum(_VALUES[k][part] * up[:len(part)], out=sums[1:])
            out[k][i:j] = mix((sums[two] - sums[one]) * down[one] + size[i:j].astype(U64))
        i = j
    for i in np.flatnonzero(size > LONGEST):
        word = joined[start[i]:end[i]]
        for k in range(kinds):
            out[k][i] = xxhash.xxh64_intdigest(word, seed=k)
    return out, at


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and shift rounds)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (``len - n + 1``)."""
    m = max(0, len(hashes) - n + 1)
    acc = np.full(m, n, dtype=U64)
    for j in range(n):
        acc = mix(acc + hashes[j:j + m]) * U64(0x9E3779B97F4A7C15)
    return acc


def offsets(lengths) -> np.ndarray:
    """0 followed by the running totals of the lengths."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, dtype=U64).view(np.int64)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1``, one after another."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    at = np.arange(total, dtype=np.int64)
    return at + np.repeat(np.asarray(starts, dtype=np.int64) - (np.cumsum(lengths) - lengths), lengths)


def carried(below: int, lists: pa.Array) -> np.ndarray:
    """Row by row, which of the numbers less than ``below`` that several lists
    hold each list holds (0 or 1)."""
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    flat = lists.flatten().to_numpy()
    row, flat = row[flat < below], flat[flat < below]
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[place] > 1
    out = np.zeros((len(lists), int((count > 1).sum())), dtype=np.float32)
    out[row[keep], shared[place[keep]]] = 1
    return out
