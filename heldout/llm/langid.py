"""Language identification with a linear-chain conditional random field.

The field labels every word with a language: a word scores by its hashed
features (the word itself, prefixes, suffixes, letter n-grams) and by the
languages whose lexicon it is in, neighbouring labels by learned transition weights.
A chain is a line's words, cut after ``CHAIN`` words.  Forward-backward gives each
word's label probabilities, so a text that switches language is labelled
word by word; a document's language is the one with the largest share of
probability over all its words.

A lexicon is a language's most frequent words, counted in Spark over all
labelled documents; the lexicons together have at most ``LEXICON`` words.
Training runs on the driver over a sample whose size is bounded by the
parameters ``per_lang`` (documents a language) and ``per_doc`` (chains of a
document) and does not grow with the input.  Part of its chains are spliced
from two languages, so transitions are fitted to switches, too.  The
model ((2^16 + languages + 1) x languages, and the lexicons) is broadcast; scoring
is one pass without a shuffle.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heldout.llm import common
from heldout.session import materialize, release, ship

BUCKETS = 1 << 16
CHAIN = 48
#: Words of all lexicons together; words that a task counts before it sends them off.
LEXICON, COUNTED = 50_000, 200_000
#: Least occurrences of a lexicon's word.
SEEN = 3
#: Most languages that are told apart, and the share of spliced chains in training.
MAX_LANGS, SPLICED = 200, 0.3
_LETTERS = re.compile(r"[^\W\d_]+")
#: The answer for a text without a letter.
NO_LANGUAGE = "und"


def features(word: str) -> list[int]:
    """Hash buckets of a lower-case word's features."""
    edged = f"^{word}$"
    names = [f"w{word}"]
    names += [f"p{word[:n]}" for n in range(1, 4)] + [f"s{word[-n:]}" for n in range(1, 5)]
    names += [edged[i:i + n] for n in (2, 3) for i in range(len(edged) - n + 1)]
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


def chains(text: str | None) -> list[list[str]]:
    """The lower-case words of each line, cut to chains."""
    out = []
    for line in (text or "").lower().splitlines():
        words = [w for w in _LETTERS.findall(line) if w[0].isalpha() or any(map(str.isalpha, w))]
        out += [words[i:i + CHAIN] for i in range(0, len(words), CHAIN)]
    return out


class _Order:
    """Places of chains of given lengths when words go by position in their
    chain, longest chain first; so each step works on a prefix of the last."""

    def __init__(self, lengths: np.ndarray) -> None:
        rank = np.argsort(-lengths, kind="stable")
        steps = int(lengths.max()) if len(lengths) else 0
        self.active = np.searchsorted(-lengths[rank], -np.arange(steps), side="left")
        self.at = common.offsets(self.active)
        place = np.empty(len(lengths), dtype=np.int64)
        place[rank] = np.arange(len(lengths))
        step = common.spans(np.zeros(len(lengths), dtype=np.int64), lengths)
        #: for each word in reading order, its place
        self.place = self.at[step] + np.repeat(place, lengths)


def forward_backward(scores: np.ndarray, order: _Order, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word (in places) and the expected number of
    times each label follows each."""
    weight, trans = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(links)
    ahead, back = np.empty_like(weight), np.empty_like(weight)
    at, active = order.at, order.active
    for t, n in enumerate(active):
        here = weight[at[t]:at[t] + n]
        if t:
            here = here * (ahead[at[t - 1]:at[t - 1] + n] @ trans)
        ahead[at[t]:at[t] + n] = here / here.sum(axis=1, keepdims=True)
    pairs = np.zeros_like(trans)
    for t in range(len(active) - 1, -1, -1):
        own = np.ones((active[t], weight.shape[1]))
        if t + 1 < len(active):
            n = active[t + 1]
            nxt = weight[at[t + 1]:at[t + 1] + n] * back[at[t + 1]:at[t + 1] + n]
            got = nxt @ trans.T
            own[:n] = got / got.sum(axis=1, keepdims=True)
            left = ahead[at[t]:at[t] + n]
            total = np.einsum("ci,ij,cj->c", left, trans, nxt)
            pairs += trans * ((left / total[:, None]).T @ nxt)
        back[at[t]:at[t] + active[t]] = own
    both = ahead * back
    return both / both.sum(axis=1, keepdims=True), pairs


@dataclass
class Model:
    """Languages in order, feature weights and transition weights."""

    langs: list[str]
    weights: np.ndarray
    links: np.ndarray
    #: word to the places of the languages whose lexicon it is in
    lexicon: dict[str, tuple[int, ...]] = field(default_factory=dict)
    #: letters that a learned language uses
    letters: frozenset[str] = frozenset()
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def transform(self, docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
        """Rows (doc_id, lang_pred, score, words, known, foreign), one for each row
        of ``docs`` (doc_id, text); with the columns named in ``carry`` in front of
        them.

        ``score`` is the share of label probability of the predicted language
        over all words, ``words`` the number of words labelled with each
        language, ``known`` the share of words that are in a lexicon, ``foreign``
        the share of letters that no learned language uses.  A text that is null or
        has no letter is ``und`` with score 0 (and 0, 0); equal shares go to the
        first language in order.  Repeated rows get equal answers, each for
        itself; a text is scored as a whole however long it is.
        """
        ship(docs.sparkSession)
        sent = docs.sparkSession.sparkContext.broadcast(self)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                           *[F.col(c) for c in carry if c not in ("doc_id", "text")])
        schema = T.StructType([rows.schema[c] for c in (carry or ("doc_id",))]).add("lang_pred", "string").add(
            "score", "double").add("words", T.MapType(T.StringType(), T.LongType())).add("known", "double").add("foreign", "double")
        return rows.mapInArrow(_scorer(sent, list(carry or ("doc_id",))), schema)


class _Scores:
    """Rows of words' scores (and whether a lexicon has the word, how many of its
    letters are foreign), remembered up to a number of bytes."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self._numbers = common.Numbers()
        self._rows = np.empty((1024, len(self.model.langs) + 2), dtype=np.float32)

    def _scored(self, words: list[str]) -> np.ndarray:
        model, k = self.model, len(self.model.langs)
        own = [features(w) + in_lexicons(w, model.lexicon, k) for w in words]
        at = common.offsets([len(x) for x in own])
        flat = np.fromiter(chain.from_iterable(own), dtype=np.int64, count=int(at[-1]))
        known = [w in model.lexicon for w in words]
        foreign = [sum(c not in model.letters for c in w) for w in words]
        return np.column_stack([np.add.reduceat(model.weights[flat], at[:-1], axis=0), known, foreign])

    def of(self, words: list[str]) -> np.ndarray:
        if self._numbers.held + self._rows.nbytes > common.MEMORY:
            self._forget()
        numbers = self._numbers
        place = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        used = len(numbers) - len(numbers.fresh)
        new = numbers.fresh + numbers.long
        while used + len(new) > len(self._rows):
            self._rows = np.concatenate([self._rows, np.empty_like(self._rows)])
        for i in range(0, len(new), 20_000):
            some = new[i:i + 20_000]
            self._rows[used + i:used + i + len(some)] = self._scored(some)
        # long words lie behind the others until the next call
        place = np.where(place < 0, len(numbers) - 1 - place, place)
        numbers.fresh, numbers.long = [], []
        return self._rows[place]


def in_lexicons(word: str, lexicon: dict[str, tuple[int, ...]], k: int) -> list[int]:
    """A word's lexicon features: behind the hashed ones, one a language and one
    for words in none."""
    return [BUCKETS + j for j in lexicon.get(word, (k,))]


_KNOWN: dict[str, _Scores] = {}


def _scorer(sent, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for piece in common.pieces(batches, "text", 1 << 20):
            known = _KNOWN.get(model.token)
            if known is None:
                _KNOWN.clear()
                known = _KNOWN[model.token] = _Scores(model)
            doc, length, words = [], [], []
            for i, text in enumerate(piece.column("text").to_pylist()):
                for line in chains(text):
                    doc.append(i)
                    length.append(len(line))
                    words += line
            n, langs = piece.num_rows, len(model.langs)
            share = np.zeros((n, langs))
            count = np.zeros((n, langs), dtype=np.int64)
            found, foreign = np.zeros(n), np.zeros(n)
            if words and langs:
                length = np.array(length)
                rows = known.of(words)
                order = _Order(length)
                scores = np.empty((len(words), langs))
                scores[order.place] = rows[:, :langs]
                chance = forward_backward(scores, order, model.links)[0][order.place]
                owner = np.repeat(np.array(doc), length)
                best = chance.argmax(axis=1)
                letters = np.bincount(owner, weights=np.fromiter(map(len, words), dtype=float, count=len(words)), minlength=n)
                found = np.bincount(owner, weights=rows[:, langs], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
                foreign = np.bincount(owner, weights=rows[:, langs + 1], minlength=n) / np.maximum(letters, 1)
                for j in range(langs):
                    share[:, j] = np.bincount(owner, weights=chance[:, j], minlength=n)
                    count[:, j] = np.bincount(owner[best == j], minlength=n)
            total = share.sum(axis=1)
            top = share.argmax(axis=1) if langs else np.zeros(n, dtype=int)
            pred = [model.langs[t] if s > 0 else NO_LANGUAGE for t, s in zip(top, total, strict=True)]
            score = np.where(total > 0, share.max(axis=1, initial=0.0) / np.maximum(total, 1e-300), 0.0).clip(0, 1)
            by_lang = [[(x, int(c)) for x, c in zip(model.langs, row, strict=True) if c] for row in count]
            yield pa.RecordBatch.from_arrays(
                [*map(piece.column, carry), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(by_lang, pa.map_(pa.string(), pa.int64())), pa.array(found), pa.array(foreign)],
                names=[*carry, "lang_pred", "score", "words", "known", "foreign"])
    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n): of the words that can be in a lexicon, and of all letters, with a
    space in front."""
    held: dict[str, Counter] = {}

    def send() -> pa.RecordBatch:
        for own in held.values():
            letters: Counter = Counter()
            for word, n in own.items():
                for c in word:
                    letters[c] += n
            own.update({f" {c}": n for c, n in letters.items() if c != " "})
        rows = [(lang, word, n) for lang, own in held.items() for word, n in own.items() if len(word) <= common.LONGEST]
        lang, word, n = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())],
                                          names=["lang", "word", "n"])

    for piece in common.pieces(batches, "text", 1 << 20):
        for text, lang in zip(piece.column("text").to_pylist(), piece.column("lang").to_pylist(), strict=True):
            held.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
        if sum(map(len, held.values())) >= COUNTED:
            yield send()
            held.clear()
    if held:
        yield send()


def lexicons(known: DataFrame, langs: list[str], words: int = LEXICON, seen: int = SEEN) -> tuple[dict[str, tuple[int, ...]], frozenset[str]]:
    """Each language's most frequent words, as places in ``langs``, and the letters
    of all.  Words are counted over all rows (text, lang); a language has at
    most ``words / len(langs)``: all words from some frequency on, told apart
    by eighths of a doubling, that were seen ``seen`` times at least.  Words of over 64 letters are in no lexicon.  A letter
    is a language's if at least one in 10,000 of its letters is it.
    """
    every = materialize(known.select("text", "lang").mapInArrow(_word_counts, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    letter = F.col("word").startswith(" ")
    counts = every.where(~letter)
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    # at most 512 rows a language
    sizes = counts.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least = {}
    for lang in langs:
        room, least[lang] = words // len(langs), 1 << 20
        for at, n in sorted(((r["step"], r["n"]) for r in sizes if r["lang"] == lang), reverse=True):
            room -= n
            if room < 0:
                break
            least[lang] = at
    floor = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
    # at most ``words`` rows
    kept = sorted(counts.where((F.col("n") >= seen) & (step >= floor[F.col("lang")])).collect())
    found: dict[str, tuple[int, ...]] = {}
    for lang, word, _ in kept:
        found[word] = (*found.get(word, ()), langs.index(lang))
    # at most 10,000 rows a language
    letters = every.where(letter)
    total = letters.groupBy("lang").agg(F.sum("n").alias("total"))
    common_ = letters.join(total, "lang").where(F.col("n") * 10_000 >= F.col("total")).select(F.substring("word", 2, 1).alias("c")).distinct().collect()
    release(every)
    return found, frozenset(r["c"] for r in common_)


def _sampled(per_doc: int):
    """(draw, lang, chains) of drawn documents: all chains, or ``per_doc`` evenly spaced
    ones; words joined by spaces, chains by line ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                own = chains(text)
                if len(own) > per_doc:
                    own = [own[i] for i in np.linspace(0, len(own) - 1, per_doc).astype(int)]
                out.append("\n".join(" ".join(w[:common.LONGEST] for w in c) for c in own))
            yield pa.RecordBatch.from_arrays([batch.column("draw"), batch.column("lang"), pa.array(out, pa.string())], names=["draw", "lang", "chains"])
    return run


def fit(docs: DataFrame, per_lang: int = 250, per_doc: int = 200, epochs: int = 4, batch: int = 1_500, seed: int = 7,
        max_langs: int = MAX_LANGS) -> Model:
    """Fit the field to documents (doc_id, text, lang); each word of a text is
    taken to have the text's language.

    About ``per_lang`` documents of each language are drawn by hash of id and
    number of bytes (all, if there are fewer), and at most ``per_doc`` chains of each;
    only they and the lexicons reach the driver.  Null texts and languages are left
    out.  More than ``max_langs`` languages are an error.  Repeated rows count as often
    as they occur.  With nothing to learn from the model has no language and
    answers ``und``.
    """
    ship(docs.sparkSession)
    known = docs.select("text", "lang", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1 << 30)).alias("draw")).where(
        "text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_langs + 1).collect()}
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((BUCKETS + 1, 0)), np.zeros((0, 0)))
    lexicon, letters = lexicons(known, langs)
    below = F.create_map(*[F.lit(x) for k in langs for x in (k, int((1 << 30) * min(1.0, per_lang / counts[k])))])
    sample = (known.where(F.col("draw") < below[F.col("lang")]).select("draw", "lang", "text")
              .mapInArrow(_sampled(per_doc), "draw long, lang string, chains string").limit(2 * per_lang * len(langs)).collect())
    sample.sort()

    index: dict[str, int] = {}
    # flat arrays of numbers, as the sample is the most that the driver holds
    length, label, words, flat, size = (array("q") for _ in range(5))
    for row in sample:
        for line in row["chains"].split("\n"):
            own = line.split()
            length.append(len(own))
            label.append(langs.index(row["lang"]))
            words.extend(index.setdefault(w, len(index)) for w in own)
    del sample
    for word in index:
        own = features(word) + in_lexicons(word, lexicon, len(langs))
        flat.extend(own)
        size.append(len(own))
    length, label, words, flat, size = (np.array(x, dtype=np.int64) for x in (length, label, words, flat, size))
    draw = np.random.Generator(np.random.PCG64(seed))
    words, truth, length = _spliced(words, length, label, draw)
    start, at = common.offsets(length)[:-1], common.offsets(size)[:-1]

    k = len(langs)
    weights, links = np.zeros((BUCKETS + k + 1, k)), np.zeros((k, k))
    seen_w, seen_l = np.full_like(weights, 1e-2), np.full_like(links, 1e-2)
    for _ in range(epochs):
        mixed = draw.permutation(len(length))
        for i in range(0, len(mixed), batch):
            chosen = mixed[i:i + batch]
            n = length[chosen]
            order = _Order(n)
            places = common.spans(start[chosen], n)
            word, real_label = words[places], truth[places]
            used, word = np.unique(word, return_inverse=True)
            parts = flat[common.spans(at[used], size[used])]
            scores = np.add.reduceat(weights[parts], common.offsets(size[used])[:-1], axis=0)
            placed = np.empty((len(word), k))
            placed[order.place] = scores[word]
            chance, pairs = forward_backward(placed, order, links)
            error = -chance[order.place]
            error[np.arange(len(word)), real_label] += 1
            of_word = np.stack([np.bincount(word, weights=error[:, j], minlength=len(used)) for j in range(k)], axis=1)
            spread = np.repeat(of_word, size[used], axis=0)
            step = np.stack([np.bincount(parts, weights=spread[:, j], minlength=len(weights)) for j in range(k)], axis=1)
            step = step / len(word) * 100 - 1e-4 * weights
            seen_w += step * step
            weights += 0.3 * step / np.sqrt(seen_w)
            inside = np.ones(len(word), dtype=bool)
            inside[np.cumsum(n) - 1] = False
            real = np.bincount((real_label[:-1] * k + real_label[1:])[inside[:-1]], minlength=k * k).reshape(k, k)
            step = (real - pairs) / len(word) * 100 - 1e-3 * links
            seen_l += step * step
            links += 0.4 * step / np.sqrt(seen_l)
    return Model(langs, weights.astype(np.float32), links, lexicon, letters)


def _spliced(words: np.ndarray, length: np.ndarray, label: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, their labels and the chains' lengths, with a share of the chains cut
    somewhere and going on with the end of another one of any language."""
    keep = np.flatnonzero(length > 0)
    start, length, label = common.offsets(length)[:-1][keep], length[keep], label[keep]
    other = draw.integers(0, max(len(length), 1), len(length))
    cut = np.where((draw.random(len(length)) < SPLICED) & (length > 1), (length * draw.random(len(length))).astype(np.int64), length)
    tail = np.where(cut < length, np.minimum(length[other], np.maximum(CHAIN - cut, 0)), 0)
    spans = np.stack([cut, tail], axis=1).ravel()
    places = common.spans(np.stack([start, start[other] + length[other] - tail], axis=1).ravel(), spans)
    return words[places], np.repeat(np.stack([label, label[other]], axis=1).ravel(), spans), cut + tail
