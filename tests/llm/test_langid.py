import numpy as np
from pyspark.sql import functions as F

from plain import SF
from heldout.llm import langid, queries


def test_op3_is_right_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op3_crf_language_id(spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_words_of_mixed_texts_are_labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    text = {x: docs.where((F.col("lang") == x) & (F.length("text") > 900)).orderBy("doc_id").first()["text"][:900] for x in ("en", "de")}
    mixed = spark.createDataFrame([(1, text["en"] + "\n" + text["de"])], "doc_id long, text string")
    words = model.transform(mixed).first()["words"]
    assert min(words["en"], words["de"]) > 0.3 * sum(words.values())


def _line(docs, lang, n, skip=0):
    words = []
    for r in docs.where((F.col("lang") == lang) & (F.length("text") > 900)).orderBy("doc_id").select("text").limit(8).collect():
        words += [w for c in langid.chains(r["text"]) for w in c]
    return words[skip:skip + n]


def test_a_switch_within_a_line_is_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.where("doc_id % 3 > 0"))
    held = docs.where("doc_id % 3 = 0")
    rows, want = [], []
    for i, (a, b) in enumerate([("en", "de"), ("de", "fr"), ("fr", "es"), ("es", "en")] * 3):
        rows.append((i, " ".join(_line(held, a, 18, 20 * i) + _line(held, b, 10, 20 * i))))
        want.append((a, b))
    got = {r["doc_id"]: r["words"] for r in model.transform(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (a, b) in enumerate(want):
        assert abs(got[i].get(a, 0) - 18) <= 2 and abs(got[i].get(b, 0) - 10) <= 2, (a, b, got[i])


def test_transitions_are_fitted_to_switches(spark, monkeypatch):
    # languages that share most words, so that a word alone does not say which it is
    draw = np.random.default_rng(3)
    word = lambda lang: "".join("abcdefghij"[int(d)] for d in str(draw.integers(100, 150))) if draw.random() < 0.85 else f"{lang}own"
    rows = [(i, "\n".join(" ".join(word("pq"[i % 2]) for _ in range(6)) for _ in range(40)), "pq"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    off, gap = ~np.eye(2, dtype=bool), {}
    for share in (0.0, 0.3, 1.0):
        monkeypatch.setattr(langid, "SPLICED", share)
        links = langid.fit(docs, per_lang=80, epochs=30).links
        gap[share] = links[~off].mean() - links[off].mean()
    # the more switches there were, the smaller the cost of one; never none
    assert 0.5 < gap[1.0] < gap[0.3] - 0.3 and gap[0.3] < gap[0.0] - 0.1, gap


def test_spliced_chains_keep_their_words_and_labels():
    draw = np.random.default_rng(4)
    length = draw.integers(0, langid.CHAIN + 1, 500)
    label = draw.integers(0, 3, 500)
    words = np.repeat(label, length) * 1_000_000 + np.arange(length.sum())
    got, truth, size = langid._spliced(words, length, label, draw)
    assert (got // 1_000_000 == truth).all() and len(got) == size.sum() and size.min() >= 0 and size.max() <= langid.CHAIN
    ends = np.cumsum(size)
    switched = sum(len(set(truth[e - n:e])) > 1 for e, n in zip(ends, size))
    assert 0.1 < switched / len(size) < 0.3


def test_lexicons_are_the_most_frequent_words(spark):
    rows = [("aa bb bb cc cc cc cc " + "dd " * 8, "x"), ("aa " * 8 + "ee ee", "y"), ("aa bb", "y"), ("z" * 65, "y")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    lexicon, letters = langid.lexicons(frame, ["x", "y"], 4, 2)
    assert lexicon == {"dd": (0,), "cc": (0,), "aa": (1,), "ee": (1,)} and letters == frozenset("abcdez")
    assert set(langid.lexicons(frame, ["x", "y"], 4, 3)[0]) == {"dd", "cc", "aa"}


def test_scores_match_a_plain_field(spark, texts):
    """The query's answers, word by word in plain Python."""
    import math

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs, per_lang=30)
    few = dict(sorted(texts.items())[:60])
    k = len(model.langs)
    got = {r["doc_id"]: r for r in model.transform(spark.createDataFrame(list(few.items()), "doc_id long, text string")).collect()}
    for i, text in few.items():
        share, known, words = [0.0] * k, 0, 0
        for chain in langid.chains(text):
            scores = []
            for w in chain:
                own = langid.features(w) + [langid.BUCKETS + j for j in model.lexicon.get(w, (k,))]
                scores.append([float(sum(model.weights[f, y] for f in own)) for y in range(k)])
                known += w in model.lexicon
                words += 1
            ahead, back = [], [[0.0] * k]
            total = lambda xs: max(xs) + math.log(sum(math.exp(x - max(xs)) for x in xs))
            for s in scores:
                ahead.append([s[y] + (total([ahead[-1][x] + model.links[x, y] for x in range(k)]) if ahead else 0) for y in range(k)])
            for s in scores[:0:-1]:
                back.append([total([model.links[x, y] + s[y] + back[-1][y] for y in range(k)]) for x in range(k)])
            for a, b in zip(ahead, back[::-1]):
                whole = total([x + y for x, y in zip(a, b)])
                for y in range(k):
                    share[y] += math.exp(a[y] + b[y] - whole)
        if words:
            best = max(range(k), key=lambda y: share[y])
            assert got[i]["lang_pred"] == model.langs[best]
            assert abs(got[i]["score"] - share[best] / words) < 1e-3 and abs(got[i]["known"] - known / words) < 1e-9
        else:
            assert got[i]["lang_pred"] == "und"


def test_too_many_languages_are_an_error(spark):
    import pytest

    frame = spark.createDataFrame([(i, "text here", f"l{i}") for i in range(6)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        langid.fit(frame, max_langs=5)


def test_forward_backward_matches_all_paths():
    draw = np.random.default_rng(2)
    lengths = np.array([3, 1, 4])
    scores, links = draw.normal(size=(8, 3)), draw.normal(size=(3, 3))
    order = langid._Order(lengths)
    placed = np.empty_like(scores)
    placed[order.place] = scores
    got, pairs = langid.forward_backward(placed, order, links)
    got = got[order.place]
    want, expected, at = np.zeros_like(scores), np.zeros((3, 3)), 0
    for n in lengths:
        total = 0.0
        own, own_pairs = np.zeros((n, 3)), np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            w = np.exp(sum(scores[at + t, y] for t, y in enumerate(path)) + sum(links[a, b] for a, b in zip(path, path[1:])))
            total += w
            for t, y in enumerate(path):
                own[t, y] += w
            for a, b in zip(path, path[1:]):
                own_pairs[a, b] += w
        want[at:at + n] = own / total
        expected += own_pairs / total
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, expected)


def test_odd_rows_have_defined_answers(spark, odd):
    model = langid.fit(odd)
    rows = model.transform(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (0, 1, 2))
    assert by_id[4]["lang_pred"] == "en" and by_id[6]["words"] == {"en": 1}
    empty = langid.fit(odd.limit(0))
    assert empty.langs == [] and {r["lang_pred"] for r in empty.transform(odd).collect()} == {"und"}
    assert model.transform(odd.limit(0)).collect() == []


def test_signs_that_are_no_letters_are_no_words():
    assert langid.chains("12 ² ½ !! __") == [] and langid.chains("Año x2y") == [["año", "x", "y"]]


def test_documents_without_letters_teach_nothing(spark):
    docs = spark.createDataFrame([(1, "12 !!", "en"), (2, "", "de"), (3, None, "en"), (4, "hello", None)], "doc_id long, text string, lang string")
    rows = {r["doc_id"]: r for r in langid.fit(docs).transform(docs).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 4)] == ["und", "und", "und", "de"] and rows[4]["score"] == 0.5
