import numpy as np
import plain
from plain import SF
from heldout.llm import minhash, queries, recompression
from heldout.llm.components import connected_components
from heldout.llm.minhash import near_duplicates
from heldout.llm.recompression import remove_repeats


def test_op1_matches_all_pairs(spark, texts):
    want = plain.near_classes(texts, 4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in
           queries.op1_minhash_near_dedup(spark, SF).collect()}
    assert got == want and sum(not k for _, _, k in want.values()) > 20


def test_near_misses_chains_and_groups(spark):
    """A chain a-b-c whose ends are no link, a pair just below and one just at
    the threshold, and a group larger than a block of comparisons."""
    draw = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = list(draw.choice(vocabulary, 300))

    def edited(text, k):
        out = list(text)
        for i in draw.choice(len(out), k, replace=False):
            out[i] = "new" + str(draw.integers(10**9))
        return out

    docs = {1: base, 2: edited(base, 7)}
    docs[3] = edited(docs[2], 7)
    for i in range(10, 90):
        docs[i] = edited(base, int(draw.integers(1, 14)))
    docs = {i: " ".join(t) for i, t in docs.items()}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    old, minhash.BLOCK = minhash.BLOCK, 8
    try:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(frame, 4).collect()}
    finally:
        minhash.BLOCK = old
    assert got == plain.near_classes(docs, 4)


def test_odd_sketch_estimates_similarity():
    draw = np.random.default_rng(1)
    for size, share in ((200, 0.9), (900, 0.8), (6000, 0.8), (6000, 0.95)):
        both = int(2 * size * share / (1 + share))
        pool = draw.integers(0, 2**63, 2 * size - both, dtype=np.int64).view(np.uint64)
        a, b = np.sort(pool[:size]), np.sort(pool[size - both:])
        one, two = minhash.odd_sketches([a, b]).view(np.uint64)
        count = int(np.bitwise_count(one ^ two).sum())
        true = both / len(pool)
        assert abs(minhash.estimate(count, size, size) - true) < 0.06
        assert count <= minhash.bound(np.array(size), np.array(size), true)


def test_near_duplicates_of_odd_rows(spark, odd):
    got = near_duplicates(odd, 5).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[8]["component_id"] == 7 and not by_id[8]["kept"]
    assert all(by_id[i]["n_shingles"] == 0 and by_id[i]["component_id"] == i and by_id[i]["kept"] for i in (0, 1, 2))
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert near_duplicates(odd.limit(0), 5).collect() == []


def test_one_id_with_several_texts_is_one_document(spark):
    a, b = " ".join(map(str, range(50))), " ".join(map(str, range(100, 150)))
    frame = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, "alone here")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame, 5).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_near_copies_of_each_text_of_an_id_are_linked(spark):
    large, small = [f"a{i}" for i in range(90)], [f"b{i}" for i in range(50)]
    third = [f"c{i}" for i in range(60)]
    rows = [(2, large), (2, small), (2, third), (5, small + ["end"]), (6, large + ["end"]), (7, small), (8, ["start", *small]),
            (9, third[1:]), (1, third), (1, [f"d{i}" for i in range(40)]), (10, [f"d{i}" for i in range(41)]), (11, [f"e{i}" for i in range(40)])]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = near_duplicates(frame, 5).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: 1 for i in (1, 2, 5, 6, 7, 8, 9, 10)} | {11: 11}
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [1, 1, 11]
    rows = [(i, t) for i, t in rows if i not in (1, 9, 10)] + [(3, [f"f{i}" for i in range(40)])]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(frame, 5).collect()} == {2: 2, 5: 2, 6: 2, 7: 2, 8: 2, 3: 3, 11: 11}


def _template_texts(count, shared=60, own=25, seed=3):
    """Texts that share most of their words and still are no near duplicates."""
    draw = np.random.default_rng(seed)
    head = " ".join(f"form{i}" for i in range(shared))
    return {i: head + " " + " ".join(f"x{i}y{j}" for j in draw.integers(0, 10**6, own)) for i in range(count)}


def test_near_misses_of_a_template_are_not_compared_with_one_another(spark, monkeypatch):
    met = spark.sparkContext.accumulator(0)
    inner = minhash._close_pairs

    def watched(threshold, fan):
        run = inner(threshold, fan)

        def compared(table):
            met.add(int(table.column("asks").to_numpy(zero_copy_only=False).sum()) * table.num_rows)
            return run(table)
        return compared

    monkeypatch.setattr(minhash, "_close_pairs", watched)
    seen = []
    for count in (1000, 3000):
        docs = _template_texts(count)
        # a few true links among them, found by nothing else than the index
        docs |= {10**6 + i: docs[i] + " end" for i in range(0, count, 100)}
        frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
        before = met.value
        got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame, 4).collect()}
        seen.append(met.value - before)
        assert got == {i: i % 10**6 for i in docs}
    assert seen[1] <= 3.5 * max(seen[0], 1), seen


def test_prefixes_of_sets_at_the_threshold_meet():
    import pyarrow as pa

    class Sent:
        value = (np.random.default_rng(1).integers(0, 200, minhash.SLOTS)).astype(np.uint8)

    draw = np.random.default_rng(2)
    for size in (1, 2, 5, 40, 300):
        for _ in range(20):
            gone = draw.choice(size, size // 5, replace=False) if size > 4 else []
            words = [f"w{x}" for x in draw.integers(0, 10**9, size)]
            texts = [" ".join(words), " ".join(w for i, w in enumerate(words) if i not in gone)]
            batch = pa.RecordBatch.from_pydict({"rep": pa.array([1, 2]), "text": pa.array(texts)})
            out = next(minhash._prefixes(Sent, 1, 80, 0)(iter([batch])))
            rep, key = out.column("rep").to_numpy(), out.column("key").to_numpy()
            assert set(key[rep == 1]) & set(key[rep == 2])


def test_rows_that_repeat_two_near_texts_are_confirmed_once(spark):
    text = " ".join(f"w{i}" for i in range(100))
    frame = spark.createDataFrame([(1, text)] * 300 + [(2, text + " end")] * 300, "doc_id long, text string")
    inner = minhash._confirm

    def watched(n, percent):
        run, rows = inner(n, percent), count

        def counted(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                yield from run(iter([batch]))
        return counted

    count = spark.sparkContext.accumulator(0)
    minhash._confirm = watched
    try:
        got = near_duplicates(frame, 4).collect()
    finally:
        minhash._confirm = inner
    assert count.value == 1
    assert len(got) == 600 and {r["component_id"] for r in got} == {1} and sum(r["kept"] for r in got) == 300


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(7, 7), (300, 299), (300, 299), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 100 for i in range(101, 161)} | {i: 5 for i in range(6, 60)} | {i: 200 for i in range(201, 209)} | {300: 299}
    assert got == want


def test_op2_matches_all_windows(spark, texts):
    want = plain.without_repeats(texts, 13)
    got = queries.op2_recompression_substring_dedup(spark, SF).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == {
        i: (n, gone, plain.sha(b" ".join(kept))) for i, (n, gone, kept) in want.items()}
    assert sum(gone for _, gone, _ in want.values()) > 1000


def test_windows_of_runs_periods_and_overlaps(spark):
    draw = np.random.default_rng(9)
    docs = {}
    for i in range(120):
        parts = []
        for _ in range(draw.integers(1, 6)):
            kind = draw.integers(4)
            parts += [["a"] * int(draw.integers(1, 30)), list("abcab" * 5)[:int(draw.integers(3, 25))],
                      list(draw.choice(list("abcdefgh"), int(draw.integers(1, 20)))), ["p%d" % j for j in range(int(draw.integers(5, 25)))]][kind]
        docs[i] = " ".join(parts)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for width, upto in ((5, 2), (13, 2), (13, 4), (2, 1)):
        got = remove_repeats(frame, width, layout=False, upto=upto).collect()
        want = plain.without_repeats(docs, width)
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"].encode().split()) for r in got} == want


def test_wide_windows_with_many_symbols(spark):
    draw = np.random.default_rng(10)
    vocabulary = [f"w{i}" for i in range(500)]
    passages = [list(draw.choice(vocabulary, n)) for n in (39, 40, 70, 99, 100, 101, 160, 300)]
    docs = {i: " ".join([*draw.choice(vocabulary, int(draw.integers(0, 60))), *passages[draw.integers(len(passages))],
                         *draw.choice(vocabulary, int(draw.integers(0, 60))), *passages[draw.integers(len(passages))]]) for i in range(60)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for width in (40, 100):
        got = remove_repeats(frame, width, layout=False).collect()
        want = plain.without_repeats(docs, width)
        assert sum(gone for _, gone, _ in want.values()) > 1000
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"].encode().split()) for r in got} == want


def test_equal_passages_have_equal_inner_symbols():
    draw = np.random.default_rng(3)
    vocabulary = [b"w%d" % i for i in range(40)]
    shared = list(draw.choice(vocabulary, 60))
    a = list(draw.choice(vocabulary, 25)) + shared + list(draw.choice(vocabulary, 11))
    b = list(draw.choice(vocabulary, 7)) + shared + list(draw.choice(vocabulary, 30))
    w = recompression.Words([b" ".join(a), b" ".join(b)])
    for s in recompression.levels(w, 6):
        def inner(start):
            keep = (s.low >= start) & (s.high <= start + 60)
            return list(zip(s.name[keep], s.low[keep] - start, s.high[keep] - start))
        assert inner(25) == inner(len(a) + 7) != []


def test_high_symbols_hold_their_own_words():
    draw = np.random.default_rng(13)
    vocabulary = [b"w%d" % i for i in range(30)]
    shared = list(draw.choice(vocabulary, 2000))
    docs = [list(draw.choice(vocabulary, 50)) + shared + list(draw.choice(vocabulary, 70)), shared[300:] + [b"x"] * 40, [], [b"y"]]
    w = recompression.Words([b" ".join(d) for d in docs])
    text, key, check, start, many = recompression.passages(w, 13)
    names = {}
    flat = [x for d in docs for x in d]
    for k, c, s, m, t in zip(key.tolist(), check.tolist(), start.tolist(), many.tolist(), text.tolist()):
        assert w.at[t] <= s and s + m + 12 <= w.at[t + 1] and m > 0
        assert names.setdefault((k, c), flat[s:s + m + 12]) == flat[s:s + m + 12]
    assert len({k for k, _ in names}) == len(names)
    # most of the shared words lie in symbols that both texts have
    both = set(zip(key[text == 0].tolist(), check[text == 0].tolist())) & set(zip(key[text == 1].tolist(), check[text == 1].tolist()))
    inside = np.zeros(len(flat), dtype=bool)
    for k, c, s, m, t in zip(key.tolist(), check.tolist(), start.tolist(), many.tolist(), text.tolist()):
        if t == 1 and (k, c) in both:
            inside[s:s + m + 12] = True
    assert inside[w.at[1]:w.at[1] + 1700].mean() > 0.8


def test_a_long_passage_is_settled_by_its_symbols(spark, monkeypatch):
    """What is shuffled for a passage in many texts grows with the rims, not with
    its length."""
    draw = np.random.default_rng(14)
    entries = spark.sparkContext.accumulator(0)
    inner = recompression._blocks

    def counted(part, kind, columns):
        for row in inner(part, kind, columns):
            entries.add(len(row[2]) // (8 * len(columns)))
            yield row

    sent = []
    for n in (0, 2_000, 10_000):
        passage = [f"p{x}" for x in draw.integers(0, 3000, n)]
        docs = {i: " ".join([*(f"a{x}" for x in draw.integers(0, 10**6, 30)), *passage, *(f"b{x}" for x in draw.integers(0, 10**6, 30))]) for i in range(40)}
        frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(8)
        want = plain.without_repeats(docs, 13)
        before = entries.value
        monkeypatch.setattr(recompression, "_blocks", counted)
        got = remove_repeats(frame, 13, layout=False).collect()
        monkeypatch.setattr(recompression, "_blocks", inner)
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"].encode().split()) for r in got} == want
        sent.append(entries.value - before)
    # 40 texts of 10,000 shared words; only the first of them is compared window by window
    rest = [x - sent[0] for x in sent]
    assert rest[1] < 40 * 2_000 and rest[2] < 4 * 10_000 + 40 * 600, sent


def test_cutting_keeps_the_rest_as_it_was(spark, odd):
    passage = " ".join(f"p{i}" for i in range(20))
    frame = spark.createDataFrame([(1, f"first\n\n{passage}\tend"), (2, f"  kept \n{passage}\n\n rest\n of it "), (3, "clean\n text  here")],
                                  "doc_id long, text string")
    got = {r["doc_id"]: r for r in remove_repeats(frame, 13).collect()}
    assert got[1]["kept"] == f"first\n\n{passage}\tend" and got[3]["kept"] == "clean\n text  here"
    assert got[2]["kept"] == "  kept \nrest\n of it " and got[2]["n_removed"] == 20
    rows = remove_repeats(odd, 3, carry=("lang", "rep")).collect()
    assert len(rows) == odd.count() and rows[0].__fields__ == ["doc_id", "lang", "rep", "n_words", "n_removed", "kept"]
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[8]["n_removed"] == 7 and by_id[7]["n_removed"] == 0 and by_id[0]["kept"] is None and by_id[5]["n_removed"] == 0
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (None, 3))
    assert remove_repeats(odd.limit(0), 3).collect() == []


def test_extra_columns_do_not_matter(spark, odd):
    few = odd.select("doc_id", "text")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(near_duplicates(odd, 5).collect(), key=key) == sorted(near_duplicates(few, 5).collect(), key=key)
    assert sorted(remove_repeats(odd, 3).collect(), key=key) == sorted(remove_repeats(few, 3).collect(), key=key)
