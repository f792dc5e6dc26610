import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import plain
from plain import ODD_TEXTS, SF
from heldout.llm import bpe, fingerprint, queries, tokenfile
from heldout.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_op9_and_op10_match_the_library(spark, texts, library):
    nine = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op9_elias_fano_tokens(spark, SF).collect()}
    ten = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op10_bpe_round_trip(spark, SF).collect()}
    start = 0
    for i in sorted(texts):
        ids = library.encode(texts[i], add_special_tokens=False).ids
        raw = np.array([*ids, 2], dtype="<u4")
        assert nine[i] == (start, len(raw), zlib.crc32(raw.tobytes()))
        start += len(raw)
        assert ten[i] == (len(ids), plain.sha(raw[:-1].tobytes()), plain.sha(library.decode(ids, skip_special_tokens=False)))
    assert len(nine) == len(ten) == len(texts)


def test_ids_of_odd_texts_match_the_library(library):
    draw = random.Random(3)
    pool = ["a", "b", "B", "aaaa", "'s", "'S", "don't", " ", "\n", " ", "\xa0", "\x1c", "\x85", "é", "é", "́", "Σ", "ΑΣ", "İ", "ß",
            "½", "Ⅷ", "٣", "😀", "中文", "한국", "ᄀ", "ᅡ", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "_", "--", "0123",
            "‍", "ﬁ", "हिन्दी", "Å", "!!!", "''s", "it's.", "U.S."]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 20))) for _ in range(4000)]
    own = bpe.Bpe(open(PATH, encoding="utf-8").read())
    known = bpe.Remembered(own.encode_chunks, own.special)
    for i in range(0, len(texts), 500):
        for text, ids in zip(texts[i:i + 500], known.encode([t.encode() for t in texts[i:i + 500]]), strict=True):
            assert library.encode(text, add_special_tokens=False).ids == ids.tolist(), text
            assert library.decode(ids.tolist(), skip_special_tokens=False) == own.decode(ids).decode()


def test_the_memory_of_chunks_starts_over(library, monkeypatch):
    monkeypatch.setattr(bpe.common, "MEMORY", 600)
    own = bpe.Bpe(open(PATH, encoding="utf-8").read())
    known = bpe.Remembered(own.encode_chunks, own.special)
    for text in ("one two three", "four five six seven", "one eight", "two nine ten"):
        assert known.encode([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_of_odd_rows(spark, odd, library):
    rows = bpe.encode(odd, PATH, decode=True).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] != 3:
            ids = library.encode(ODD_TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
            assert np.frombuffer(r["ids"], dtype="<u4").tolist() == ids and r["n_tokens"] == len(ids)
            assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    back = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert sorted(str(r["decoded"]) for r in back) == sorted(str(r["decoded"]) for r in rows)
    assert bpe.encode(odd.limit(0), PATH).collect() == []


def test_elias_fano_gives_every_number_back():
    draw = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 0), (1, 5), (10, 10), (1000, 10**6), (500, 2**62), (3000, 100), (130, 2**40)):
        numbers = np.sort(draw.integers(0, top, n, dtype=np.uint64)) if top else np.zeros(n, np.uint64)
        raw = b"x" + tokenfile.EliasFano.of(numbers).to_bytes() + b"rest"
        back, end = tokenfile.EliasFano.read(memoryview(raw), 1)
        assert raw[end:] == b"rest" and (back.selects(np.arange(len(numbers))) == numbers).all()
        assert [back.select(i) for i in range(n)] == numbers.tolist()
        if n >= 1000:
            assert len(raw) < n * 8 / 3
    with pytest.raises(IndexError):
        back.select(len(numbers))


def test_shards_hold_documents_in_order(spark, odd, monkeypatch):
    path = scratch_path(spark)
    tokenfile.write_tokens(odd, PATH, path, end_id=2)
    read = tokenfile.read_tokens(spark, path)
    rows = sorted(tokenfile.with_starts(read, path).collect(), key=lambda r: r["start"])
    assert len(rows) == odd.count()
    assert [r["doc_id"] for r in rows] == [None, None, 0, 1, 2, 3, 3, 3, *range(4, 10)]
    total = 0
    for r in rows:
        assert r["start"] == total and r["ids"][-4:] == b"\x02\0\0\0" and len(r["ids"]) == 4 * r["n_tokens"]
        total += r["n_tokens"]
    shard = tokenfile.Shard(spark.read.parquet(path).orderBy("part", "seq").first()["payload"])
    assert all(shard.doc(i).tolist() == np.frombuffer(r["ids"], dtype="<u4").tolist() for i, r in zip(range(shard.n_docs), rows))
    empty = scratch_path(spark)
    tokenfile.write_tokens(odd.limit(0), PATH, empty, end_id=2)
    assert tokenfile.with_starts(tokenfile.read_tokens(spark, empty), empty).collect() == []


def test_shards_end_where_they_are_full():
    ids = [np.arange(n) % 50 for n in (0, 3, 5, 1, 0, 7)]
    docs = [None, -5, -5, 0, 2**40, 2**62]
    shard = tokenfile.Shard(tokenfile.Shard.pack(docs, ids, 2))
    assert shard.doc_ids() == docs and [shard.doc(i).tolist() for i in range(6)] == [x.tolist() for x in ids]
    with pytest.raises(ValueError):
        tokenfile.Shard(b"something else, longer than a header is at the least")


def test_select_of_many_and_of_one():
    draw = np.random.default_rng(8)
    for n, top in ((1, 1), (1, 2**63), (50, 60), (1000, 10**9), (5000, 5000 * 900), (300, 2**62)):
        numbers = np.sort(draw.integers(0, top, n).astype(np.uint64))
        coded, _ = tokenfile.EliasFano.read(memoryview(tokenfile.EliasFano.of(numbers).to_bytes()), 0)
        places = draw.integers(0, n, 200)
        assert (coded.selects(places) == numbers[places]).all() and [coded.select(int(i)) for i in places[:20]] == numbers[places[:20]].tolist()
        with pytest.raises(IndexError):
            coded.selects(np.array([n]))
    assert len(tokenfile.EliasFano.of(np.empty(0, np.uint64)).selects(np.empty(0, np.int64))) == 0


def test_chosen_documents_are_read_by_select(spark, texts):
    path = scratch_path(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tokenfile.write_tokens(docs, PATH, path, end_id=2)
    every = {r["doc_id"]: bytes(r["ids"]) for r in tokenfile.read_tokens(spark, path).collect()}
    wanted = sorted(texts)[5::97]
    got = tokenfile.read_tokens(spark, path, [*wanted, -1]).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in got} == {i: every[i] for i in wanted} and len(got) == len(wanted)
    assert tokenfile.read_tokens(spark, path, []).collect() == []


def test_op8_edits_and_prefixes(spark, texts):
    ids = sorted(texts)
    got = {r["doc_id"]: r for r in queries.op8_prefix_hash_fingerprints(spark, SF).collect()}
    seen = {}
    for i, nxt in zip(ids, [*ids[1:], ids[0]]):
        text, r = texts[i], got[i]
        swap = len(text) // 4
        edited = text[:len(text) - swap] + texts[nxt][:swap]
        same = next((k for k, (a, b) in enumerate(zip(text, edited)) if a != b), min(len(text), len(edited)))
        assert (r["n_chars"], r["edited_sha256"], r["same_edited"]) == (len(text), plain.sha(edited), same)
        assert seen.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if text == texts[nxt]:
            assert r["near_next"] == 1.0
    assert len(set(seen.values())) == len(seen)
    # likeness against the whole sets of spans: within 4 deviations of a share of KEEP draws
    spans = lambda t: {t[i:i + fingerprint.SPAN] for i in range(len(t) - fingerprint.SPAN + 1)} if len(t) >= fingerprint.SPAN else {t} - {""}
    far = []
    for i, nxt in zip(ids, [*ids[1:], ids[0]]):
        a, own = spans(texts[i]), got[i]
        swap = len(texts[i]) // 4
        for b, found in ((spans(texts[i][:len(texts[i]) - swap] + texts[nxt][:swap]), own["near_edited"]), (spans(texts[nxt]), own["near_next"])):
            true = len(a & b) / len(a | b) if a | b else 1.0
            far.append(abs(found - true) / max((true * (1 - true) / fingerprint.KEEP) ** 0.5, 1 / fingerprint.KEEP))
    assert max(far) <= 4.5 and sum(x > 3 for x in far) <= 0.02 * len(far)
    long = [r for r in got.values() if r["n_chars"] > 400]
    assert sum(r["near_edited"] > r["near_next"] for r in long) / len(long) > 0.98


def test_likeness_follows_the_common_spans():
    draw = random.Random(5)
    a = "".join(draw.choice("abcdefghij klm") for _ in range(20000))
    for cut in (2000, 8000, 16000):
        b = a[:len(a) - cut] + "".join(draw.choice("nopqrstuv wxyz") for _ in range(cut))
        grams = [{t[i:i + fingerprint.SPAN] for i in range(len(t) - fingerprint.SPAN + 1)} for t in (a, b)]
        true = len(grams[0] & grams[1]) / len(grams[0] | grams[1])
        whole, least, _, _ = fingerprint.sketches([fingerprint._points(a), fingerprint._points(b)])
        assert abs(fingerprint.likeness(whole[0], least[0], whole[1], least[1]) - true) < 0.25


def test_prefix_hashes_answer_span_equality_and_extension():
    draw = np.random.default_rng(6)
    text = "".join(draw.choice(list("ab"), 400)) + "é😀" * 20
    h = fingerprint.PrefixHashes(fingerprint._points(text))
    for _ in range(500):
        i, j = draw.integers(0, len(text), 2)
        most = len(text) - max(i, j)
        n = int(draw.integers(0, most + 1))
        one = h.span(np.array([i]), np.array([i + n])) == h.span(np.array([j]), np.array([j + n]))
        assert bool(one[0]) == (text[i:i + n] == text[j:j + n])
        want = next((k for k in range(most) if text[i + k] != text[j + k]), most)
        assert h.common_extension(np.array([i]), np.array([j]), np.array([most]))[0] == want


def test_neighbours_of_odd_rows(spark, odd):
    rows = fingerprint.compare_neighbours(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[0]["n_chars"] == 0 and by_id[0]["near_next"] == 1.0 and by_id[7]["near_next"] == 1.0
    assert by_id[7]["fingerprint"] == by_id[8]["fingerprint"]
    one = fingerprint.compare_neighbours(odd.where("doc_id = 4")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fingerprint.compare_neighbours(odd.limit(0)).collect() == []
