"""Substring dedup by recompression.

Every text is rewritten in rounds: runs of one symbol become one symbol, then
pairs (left, right) become one, where each name's hash says on which side it
stands.  A new symbol's name is a hash of its parts, so all tasks of a Spark
pass give equal parts equal names, with no dictionary to shuffle.  With each symbol
goes the interval of words that decided it (itself and the neighbours that were
looked at).  Where two texts share a passage, all symbols whose intervals lie
inside it are the same in both; only the rims differ.

Spark's rounds go from high symbols to low ones:

1. Symbols of high levels (``HIGH``; some 30 words and more) that hold a window
   (``width`` consecutive words).  Where a text with a smaller doc_id has the same
   symbol, all windows inside are settled at once: a long passage is a few symbols
   however long it is, and the symbol's name and a second, independent hash of
   its words must both agree.
2. Windows that are left (rims of passages, what is not shared, and the passage
   in the text that keeps it) are filed under one symbol of low level whose
   interval lies inside the window: of the window's highest level, the one with
   the least hash.  Equal windows are filed under equal symbols; symbols met in one
   text only end here.
3. The windows filed under the other symbols are compared by two independent
   hashes of all their words: the smallest doc_id keeps the passage, all others
   lose it.  The smallest document that has a window never settles it, so each
   window that is left meets it here.
4. The spans found are cut from the texts.

Texts that are equal as a whole are one text in 1 to 3; of them, all but the
smallest doc_id lose every window.  Blocks are combined before each shuffle: a
symbol (or window) that occurs often in one task leaves it once, so a passage
in a third of all texts meets as one entry per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heldout.llm import common
from heldout.llm.common import U64
from heldout.session import materialize, ship

WIDTH = 13
#: Low levels, and the high ones; a level has about three quarters of the symbols
#: of the level below.
LEVELS = 2
HIGH = (12, 18, 24, 30, 36, 42, 48)
#: Entries that a task gathers before it sends them off as blocks.
HELD = 1_500_000
#: Text bytes that one group of blocks is meant for.
GROUP_BYTES = 16 << 20
_BASES = (0x9E3779B97F4A7C55, 0xA0761D6478BD642F)
_GAP = re.compile(rb"([\x20\x09-\x0D]+)")
_POWERS = [common.Powers(b) for b in _BASES]


class Words:
    """Word hashes of some texts, one after another; any span's two independent
    hashes from prefix sums."""

    def __init__(self, texts: list[bytes], kinds: int = 2) -> None:
        hashes, self.at = common.word_hashes(texts, kinds)
        self.hashes, n = hashes[0], len(hashes[0])
        self._sums, self._down = [], []
        for own, powers in zip(hashes, _POWERS[:kinds], strict=True):
            up, down = powers.get(n + 1)
            sums = np.zeros(n + 1, dtype=U64)
            np.cumsum(own * up[:n], out=sums[1:])
            self._sums.append(sums)
            self._down.append(down)

    def span(self, start: np.ndarray, end: np.ndarray, kind: int = 0) -> np.ndarray:
        sums = self._sums[kind]
        return common.mix((sums[end] - sums[start]) * self._down[kind][start] + (end - start).astype(U64))


class Symbols:
    """Symbols in order: name, interval of deciding words [low, high), text, first
    own word (the last lies before the next symbol's first), level that made it."""

    def __init__(self, name, low, high, text, start, born) -> None:
        self.name, self.low, self.high, self.text, self.start, self.born = name, low, high, text, start, born

    def _before(self, at: np.ndarray) -> np.ndarray:
        """Low end with the symbol before ``at``; beyond the text's rim there
        is one word that no window holds."""
        there = (at > 0) & (self.text[at - 1] == self.text[at])
        return np.where(there, self.low[at - 1], self.low[at] - 1)

    def _after(self, at: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(self.name) - 1)
        there = (after > at) & (self.text[after] == self.text[at])
        return np.where(there, self.high[after], self.high[at] + 1)

    def runs(self, level: int) -> Symbols:
        """Runs of one name become one symbol."""
        if not len(self.name):
            return self
        same = (self.name[1:] == self.name[:-1]) & (self.text[1:] == self.text[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        size = np.diff(np.append(first, len(self.name)))
        name = self.name[first]
        name = np.where(size > 1, common.mix(name + size.astype(U64) * U64(_BASES[0])), name)
        return Symbols(name, self._before(first), self._after(first + size - 1), self.text[first], self.start[first],
                       np.where(size > 1, level, self.born[first]))

    def pairs(self, level: int) -> Symbols:
        """Adjacent left and right names become one symbol."""
        if not len(self.name):
            return self
        side = common.mix(self.name ^ U64(0x243F6A8885A308D3 + level))
        right = (side >> U64(63)).astype(bool)
        joint = np.zeros(len(self.name), dtype=bool)
        joint[:-1] = ~right[:-1] & right[1:] & (self.text[1:] == self.text[:-1])
        taken = np.concatenate([[False], joint[:-1]])
        at = np.flatnonzero(~taken)
        pair, nxt = joint[at], np.minimum(at + 1, len(self.name) - 1)
        name = np.where(pair, common.mix(common.mix(self.name[at] + U64(level)) + self.name[nxt]), self.name[at])
        low = np.where(~pair & right[at], self._before(at), self.low[at])
        high = np.where(pair, self.high[nxt], np.where(right[at], self.high[at], self._after(at)))
        return Symbols(name, low, high, self.text[at], self.start[at], np.where(pair, level, self.born[at]))


def levels(words: Words, upto: int = LEVELS) -> Iterator[Symbols]:
    """The texts' symbols before any round, and after each."""
    place = np.arange(len(words.hashes), dtype=np.int64)
    text = np.repeat(np.arange(len(words.at) - 1), np.diff(words.at))
    now = Symbols(words.hashes, place, place + 1, text, place, np.zeros(len(place), dtype=np.int64))
    yield now
    for level in range(1, upto + 1):
        now = now.runs(level).pairs(level)
        yield now


def passages(words: Words, width: int = WIDTH, high: tuple[int, ...] = HIGH) -> tuple[np.ndarray, ...]:
    """Text, name, second hash, first window and number of windows of all
    symbols of the high levels that hold a window."""
    out, last = [], 0
    for level, s in enumerate(levels(words, high[-1])):
        if level not in high:
            continue
        end = np.append(s.start[1:], len(words.hashes))
        # symbols that no round since the last high level has made were told there
        keep = np.flatnonzero((end - s.start >= width) & (s.born > last))
        start, end = s.start[keep], end[keep]
        out.append((s.text[keep], common.mix(s.name[keep] + U64(0xB10C)), words.span(start, end, 1), start, end - start - width + 1))
        last = level
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def filed(words: Words, width: int = WIDTH, upto: int = LEVELS, settled: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Text, symbol key, first window and number of windows, for every stretch
    of consecutive windows, but those marked as settled (by first word), that are
    filed under one symbol occurrence."""
    size = np.diff(words.at)
    many = np.maximum(size - width + 1, 0)
    window = common.spans(words.at[:-1], many)
    text = np.repeat(np.arange(len(size)), many)
    if settled is not None:
        open_ = ~settled[window]
        window, text = window[open_], text[open_]
    key, which = np.zeros(len(window), dtype=U64), np.zeros(len(window), dtype=np.int64)
    todo = np.arange(len(window))
    own_levels = list(levels(words, upto))
    for level in range(upto, -1, -1):
        if not len(todo):
            break
        s = own_levels[level]
        at = window[todo]
        first = np.searchsorted(s.low, at, side="left")
        last = np.searchsorted(s.high, at + width, side="right") - 1
        fits = last >= first
        low, high = np.maximum(s.low, 0), np.minimum(s.high, len(words.hashes))
        own = common.mix(words.span(low, high) + s.name + U64(level))
        # the least hash in each range, the symbol's place in the low half
        order = (common.mix(own) & ~U64(0xFFFFFFFF)) | np.arange(len(own), dtype=U64)
        tables = [order]
        # a window holds at most ``width`` symbols
        for k in range(int(width).bit_length() - 1):
            t = tables[-1].copy()
            t[:-(1 << k) or None] = np.minimum(t[:-(1 << k)], t[1 << k:]) if len(t) > 1 << k else t[:-(1 << k)]
            tables.append(t)
        first, last, rows = first[fits], last[fits], todo[fits]
        reach = np.log2(last - first + 1).astype(np.int64) if len(first) else first
        best = np.empty(len(first), dtype=U64)
        for k, t in enumerate(tables):
            here = np.flatnonzero(reach == k)
            best[here] = np.minimum(t[first[here]], t[last[here] - (1 << k) + 1])
        place = (best & U64(0xFFFFFFFF)).astype(np.int64)
        key[rows], which[rows] = own[place], place * (upto + 1) + level
        todo = todo[~fits]
    if not len(window):
        return text, key, window, window
    new = np.concatenate([[True], (which[1:] != which[:-1]) | (text[1:] != text[:-1]) | (window[1:] != window[:-1] + 1)])
    head = np.flatnonzero(new)
    return text[head], key[head], window[head], np.diff(np.append(head, len(window)))


def _settled(piece: pa.RecordBatch, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By first word, whether a window is settled; text and span (start and number
    of windows in one) of each settled stretch."""
    lists = piece.column("settled")
    size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    text = np.repeat(np.arange(len(size)), size)
    start, many = (lists.flatten().field(c).to_numpy() for c in ("start", "many"))
    marks = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    np.add.at(marks, words.at[text] + start, 1)
    np.add.at(marks, words.at[text] + start + many, -1)
    return np.cumsum(marks)[:-1] > 0, text, _span(start, many)


def _span(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.asarray(start, dtype=np.int64) << 32 | np.asarray(many, dtype=np.int64)


def _blocks(part: np.ndarray, kind: int, columns: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    order = np.argsort(part, kind="stable")
    part = part[order]
    head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    for i, start in enumerate(head):
        stop = head[i + 1] if i + 1 < len(head) else len(part)
        rows = order[start:stop]
        yield int(part[start]), kind, b"".join(c[rows].tobytes() for c in columns)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                                       pa.array(payload, pa.binary())], names=["part", "kind", "payload"])


_BLOCK = "part int, kind int, payload binary"
#: Kinds of blocks: met once in the task; met in several texts of the task; settled
#: symbols or windows; settled spans on their way to the end.
_ONCE, _OFTEN, _SETTLED, _SPANS = 0, 1, 2, 3


def _symbol_blocks(width: int, upto: int, parts: int):
    def send(key: np.ndarray, text: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        keep = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])]) if len(key) else []
        key, text = key[keep], text[keep]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
        count = np.diff(np.append(head, len(key)))
        once, often = head[count == 1], head[count > 1]
        rest = np.ones(len(key), dtype=bool)
        rest[head] = False
        rows = []
        for kind, at in ((_ONCE, once), (_OFTEN, often), (_SETTLED, np.flatnonzero(rest))):
            by = text if kind == _SETTLED else key
            rows += _blocks((by[at] % U64(parts)).astype(np.int32), kind, [key[at], text[at]])
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for piece in common.pieces(batches, "text", 1 << 20):
            words = Words(common.text_bytes(piece), 1)
            settled, whose, span = _settled(piece, words)
            own = piece.column("t1").to_numpy().view(U64)
            if len(span):
                yield _batch([*_blocks((own[whose] % U64(parts)).astype(np.int32), _SPANS, [own[whose], span])])
            text, key, _, _ = filed(words, width, upto, settled)
            held.append((key, own[text]))
            n += len(key)
            if n >= HELD:
                yield send(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield send(*map(np.concatenate, zip(*held, strict=True)))
    return run


def _shared_symbols(table: pa.Table) -> pa.Table:
    """Of a part's symbols, (t1, key) of those that occur in several texts; and
    (t1, span) of what is settled."""
    keys, texts, often, out, spans = [], [], [], [], []
    for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True):
        both = np.frombuffer(payload, dtype=U64).reshape(2, -1)
        if kind == _SPANS:
            spans.append(both)
        elif kind == _SETTLED:
            out.append(both)
        else:
            keys.append(both[0])
            texts.append(both[1])
            often.append(np.full(both.shape[1], kind == _OFTEN))
    if keys:
        key, text, often = np.concatenate(keys), np.concatenate(texts), np.concatenate(often)
        order = np.lexsort((text, key))
        key, text, often = key[order], text[order], often[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        # within a key texts are in order, so the ends differ if any differ
        last = np.append(head[1:], len(key)) - 1
        several = (text[head] != text[last]) | np.logical_or.reduceat(often, head)
        keep = np.repeat(several, np.diff(np.append(head, len(key))))
        out.append(np.stack([key[keep], text[keep]]))
    key, text = np.concatenate(out, axis=1) if out else (np.empty(0, U64),) * 2
    own, span = np.concatenate(spans, axis=1) if spans else (np.empty(0, U64),) * 2
    none = np.zeros(len(key) + len(span), dtype=bool)
    none[len(key):] = True
    return pa.table({"t1": common.signed(np.concatenate([text, own])),
                     "key": pa.array(common.signed(np.concatenate([key, span])), mask=none),
                     "span": pa.array(common.signed(np.concatenate([key, span])), mask=~none)})


def _sender(parts: int):
    """Blocks of (window or symbol, second hash, doc_id, t1, span): those that a
    smaller document of the task has, too, are settled."""
    def send(key, check, doc, own, span) -> pa.RecordBatch:
        order = np.lexsort((span, doc, check, key))
        key, check, doc, own, span = (x[order] for x in (key, check, doc, own, span))
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
        lost = doc > np.repeat(doc[head], np.diff(np.append(head, len(key))))
        columns = [key, check, doc, own, span]
        rows = []
        for kind, at, by in ((_ONCE, np.flatnonzero(~lost), key), (_SETTLED, np.flatnonzero(lost), own)):
            rows += _blocks((by[at] % U64(parts)).astype(np.int32), kind, [c[at] for c in columns])
        return _batch(rows)
    return send


def _passage_blocks(width: int, parts: int):
    send = _sender(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for piece in common.pieces(batches, "text", 1 << 20):
            words = Words(common.text_bytes(piece))
            text, key, check, start, many = passages(words, width)
            held.append((key, check, piece.column("rep").to_numpy()[text], piece.column("t1").to_numpy().view(U64)[text],
                         _span(start - words.at[text], many)))
            n += len(key)
            if n >= HELD // 2:
                yield send(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield send(*map(np.concatenate, zip(*held, strict=True)))
    return run


def _window_blocks(width: int, upto: int, parts: int):
    send = _sender(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for piece in common.pieces(batches, "text", 1 << 20):
            words = Words(common.text_bytes(piece))
            settled, whose, span = _settled(piece, words)
            own = piece.column("t1").to_numpy().view(U64)
            if len(span):
                none = np.zeros(len(span), dtype=U64)
                yield _batch([*_blocks((own[whose] % U64(parts)).astype(np.int32), _SETTLED, [none, none, none, own[whose], span])])
            text, key, start, many = filed(words, width, upto, settled)
            lists = piece.column("keys")
            size = lists.value_lengths().to_numpy()
            # a text's own shared symbols: compare (text, key) pairs
            salt = common.mix(np.arange(len(size), dtype=U64))
            shared = lists.flatten().to_numpy().view(U64) ^ np.repeat(salt, size)
            keep = np.isin(key ^ salt[text], shared)
            text, key, start, many = text[keep], key[keep], start[keep], many[keep]
            at = common.spans(start, many)
            text = np.repeat(text, many)
            held.append((words.span(at, at + width), words.span(at, at + width, 1), piece.column("rep").to_numpy()[text], own[text],
                         _span(at - words.at[text], np.ones(len(at), dtype=np.int64))))
            n += len(at)
            if n >= HELD // 2:
                yield send(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield send(*map(np.concatenate, zip(*held, strict=True)))
    return run


def _lost_spans(table: pa.Table) -> pa.Table:
    """(t1, start, many): windows of a part whose words also start in a text
    with a smaller doc_id, consecutive ones together."""
    parts, out = [], []
    for kind, payload in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True):
        (out if kind == _SETTLED else parts).append(np.frombuffer(payload, dtype=np.int64).reshape(5, -1))
    own, span = [x[3] for x in out], [x[4] for x in out]
    if parts:
        key, check, doc, text, at = np.concatenate(parts, axis=1)
        order = np.lexsort((doc, check, key))
        key, check, doc, text, at = (x[order] for x in (key, check, doc, text, at))
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
        lost = doc > np.repeat(doc[head], np.diff(np.append(head, len(key))))
        own.append(text[lost])
        span.append(at[lost])
    own, span = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (own, span))
    # stretches that touch or overlap become one
    order = np.lexsort((span, own))
    own, start = own[order], span[order] >> 32
    end = start + (span[order] & 0xFFFFFFFF)
    if not len(own):
        return pa.table({"t1": own, "start": start, "many": end})
    text = np.cumsum(np.concatenate([[0], own[1:] != own[:-1]]))
    # the furthest end so far within the text; texts are kept apart by an offset
    reach = int(end.max()) + 2
    furthest = np.maximum.accumulate(end + text * reach)
    head = np.flatnonzero(np.concatenate([[True], start[1:] + text[1:] * reach > furthest[:-1]]))
    last = np.append(head[1:], len(own)) - 1
    return pa.table({"t1": own[head], "start": start[head], "many": furthest[last] - text[last] * reach - start[head]})


def _cut(width: int, layout: bool, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, "text", 1 << 22):
            n_words, n_removed, kept = [], [], []
            copies, lost = piece.column("copy").to_pylist(), piece.column("lost").to_pylist()
            raw = piece.column("text").cast(pa.binary()).to_pylist()
            for text, copy, spans in zip(raw, copies, lost, strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if copy and len(words) >= width:
                    gone[0] = 1
                else:
                    for span in spans or ():
                        gone[span["start"]] += 1
                        gone[span["start"] + span["many"] + width - 1] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                n_removed.append(int(gone.sum()))
                if not layout:
                    kept.append(b" ".join([w for w, g in zip(words, gone, strict=True) if not g] if gone.any() else words))
                elif not gone.any():
                    kept.append(text)
                else:  # a word goes with the white space after it
                    cells = _GAP.split(text)
                    lead = cells[0] == b""
                    first = 2 if lead else 0
                    out = [cells[1]] if lead else []
                    for i, g in enumerate(gone):
                        if not g:
                            out += cells[first + 2 * i:first + 2 * i + 2]
                    kept.append(b"".join(out))
            yield pa.RecordBatch.from_arrays(
                [*map(piece.column, carry), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=[*carry, "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, layout: bool = True, upto: int = LEVELS,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept), one for each row of ``docs``
    (doc_id long, text string; other columns are ignored, apart from those
    named in ``carry``, which stand behind doc_id).

    A word is removed if a window of ``width`` words that covers it also
    starts, word for word, in a document with a smaller doc_id.  Windows are
    judged on the input.  ``kept`` is the text without those words: with
    ``layout``, each goes with the white space after it and an untouched text
    is unchanged (null stays null); else the kept words joined by one space
    (null: empty).

    Texts of fewer words than ``width``, blank and null texts lose nothing.
    Rows with one doc_id never cost each other anything.  Equality is that of two
    independent 64-bit hashes of the words.  A row with a null
    doc_id loses nothing and costs no other row anything.  An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    carried = [f"carried_{i}" for i in range(len(carry))]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *[F.col(c).alias(x) for c, x in zip(carry, carried, strict=True)],
                       F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    known = docs.where("doc_id is not null and text is not null")
    reps = materialize(known.groupBy("t1", "t2").agg(F.min("doc_id").alias("rep"),
                                                     F.max(F.octet_length("text")).alias("size")))
    size = reps.agg(F.sum("size").alias("n")).first()["n"] or 0
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // GROUP_BYTES + 1)

    # Every round joins the texts by (t1, t2), with the same columns and rows, so that
    # Spark reuses one shuffle of them.
    def texts(told: DataFrame, *columns: str) -> DataFrame:
        return (docs.join(told, ["t1", "t2"]).where(F.coalesce(F.col("doc_id") == F.col("rep"), F.lit(False)))
                .select("t1", "rep", "text", *columns, *carried))

    span = F.struct("start", "many")
    keyed = reps.select("t1", "t2", "rep")
    settled = (texts(keyed).mapInArrow(_passage_blocks(width, parts), _BLOCK)
               .groupBy("part").applyInArrow(_lost_spans, "t1 long, start long, many long")
               .groupBy("t1").agg(F.collect_list(span).alias("settled")))
    parted = F.struct(F.shiftrightunsigned("span", 32).alias("start"), F.col("span").bitwiseAND(0xFFFFFFFF).alias("many"))
    shared = (texts(keyed.join(settled, "t1", "left"), "settled").mapInArrow(_symbol_blocks(width, upto, parts), _BLOCK)
              .groupBy("part").applyInArrow(_shared_symbols, "t1 long, key long, span long")
              .groupBy("t1").agg(F.collect_set("key").alias("keys"), F.collect_list(F.when(F.col("span").isNotNull(), parted)).alias("settled")))
    lost = (texts(keyed.join(shared, "t1"), "keys", "settled")
            .mapInArrow(_window_blocks(width, upto, parts), _BLOCK)
            .groupBy("part").applyInArrow(_lost_spans, "t1 long, start long, many long")
            .groupBy("t1").agg(F.collect_list(span).alias("lost")))
    schema = T.StructType([docs.schema[c] for c in ("doc_id", *carried)]).add("n_words", "long").add(
        "n_removed", "long").add("kept", "string")
    told = reps.select("t1", "t2", "rep").join(lost, "t1", "left")
    return (docs.join(told, ["t1", "t2"], "left")
            .withColumn("copy", F.coalesce(F.col("doc_id") > F.col("rep"), F.lit(False)))
            .withColumn("lost", F.when(F.col("doc_id").isNotNull(), F.col("lost")))
            .select("doc_id", *carried, "text", "copy", "lost")
            .mapInArrow(_cut(width, layout, ["doc_id", *carried]), schema)
            .withColumnsRenamed(dict(zip(carried, carry, strict=True))))
