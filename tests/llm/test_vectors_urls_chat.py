import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, duck_connection
from plain import SF
from heldout.llm import chat, queries, rpforest, urlfilter
from heldout.llm.rpforest import near_vectors


def _links(ids, vectors, threshold=0.9):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    label = ids.copy()
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return near.sum(axis=1), label
        label = new


def test_op4_on_clusters_copies_and_noise(spark):
    draw = np.random.default_rng(8)
    centers = draw.normal(size=(6, 64))
    vectors = [draw.normal(size=64) for _ in range(1200)]
    for c, n in zip(centers, (2, 3, 10, 40, 300, 700)):
        vectors += [c + draw.normal(size=64) * draw.uniform(0.05, 0.5) for _ in range(n)]
    vectors += [vectors[5]] * 4 + [vectors[2000]] * 3
    vectors = np.array(vectors)
    ids = draw.permutation(len(vectors)).astype(np.int64)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    links, label = _links(ids, vectors)
    got = {r["vec_id"]: r for r in near_vectors(frame, sample=500, block=150).collect()}
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= n for i, n in zip(ids, links))
    assert found / links.sum() > 0.995
    same = sum(got[i]["component_id"] == c for i, c in zip(ids, label))
    assert same / len(ids) > 0.995
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_op4_recall_on_the_test_table_at_a_lower_threshold(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    vectors = np.array([np.asarray(v, dtype=float) for v in rows["embedding"]])
    links, _ = _links(rows["vec_id"].to_numpy(), vectors, 0.4)
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = sum(r["n_links"] for r in near_vectors(frame, threshold=0.4, leaf=50).collect())
    assert links.sum() > 50 and found <= links.sum() and found / links.sum() >= 0.9


def test_rows_that_only_a_larger_id_links_are_in_one_component(spark):
    # 5 links with 1 and with 3, which do not link; then a chain in mixed order
    turned = lambda ids, step: [(i, [math.cos(math.radians(step * k)), math.sin(math.radians(step * k))]) for k, i in enumerate(ids)]
    frame = spark.createDataFrame(turned([1, 5, 3], 20), "vec_id long, embedding array<double>")
    assert {tuple(r) for r in near_vectors(frame).collect()} == {(1, 1, 1, True), (5, 2, 1, False), (3, 1, 1, False)}
    chain = [7, 2, 9, 4, 11, 3, 8, 5, 10, 6]
    frame = spark.createDataFrame(turned(chain, 18), "vec_id long, embedding array<double>")
    for block in (2_000, 3):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame, block=block).collect()}
        assert got == {i: (1 if i in (7, 6) else 2, 2) for i in chain}


def test_links_join_rows_as_plain_labels_do():
    draw = np.random.default_rng(2)
    for n, links in ((1, 0), (30, 20), (400, 350), (400, 4000)):
        near = np.zeros((n, n), dtype=bool)
        one, two = draw.integers(0, n, links), draw.integers(0, n, links)
        near[one, two] = near[two, one] = True
        label = np.arange(n)
        while True:
            new = np.array([min([label[i], *label[near[i]]]) for i in range(n)])
            if (new == label).all():
                break
            label = new
        least = np.arange(n)
        for part in np.array_split(np.arange(links), 3):
            least = rpforest._joined(least, one[part], two[part])
        assert (least == label).all()


def test_vectors_that_link_with_nothing(spark):
    nan, inf, big = float("nan"), float("inf"), 1e200
    rows = [(1, [1.0, 0.0, 0.0], "x"), (2, [2.0, 0.0, -0.0], "x"), (3, [big, 0.0, 0.0], None), (4, [0.0, 0.0, 0.0], "x"), (5, None, "x"),
            (6, [1.0, None, 0.0], "x"), (7, [1.0, nan, 0.0], "x"), (8, [inf, 0.0, 0.0], "x"), (9, [], "x"), (10, [1.0, 0.0], "x"),
            (None, [1.0, 0.0, 0.0], "x"), (11, [1e-200, 0.0, 0.0], "x"), (12, [0.0, 1.0, 0.0], "x"), (1, [1.0, 0.0, 0.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, links string")
    got = near_vectors(frame).collect()
    assert len(got) == len(rows)
    seen = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert seen[1] == (4, 1, True) and seen[2] == (4, 1, False) and seen[3] == (4, 1, False) and seen[11] == (4, 1, False)
    assert all(seen[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 12)) and seen[None] == (0, None, True)
    assert near_vectors(frame.limit(0)).collect() == []


def test_a_dense_cluster_is_not_copied_over_and_over():
    draw = np.random.default_rng(3)
    unit = np.concatenate([draw.normal(size=(2000, 64)), draw.normal(size=64) + draw.normal(size=(1000, 64)) * 0.02])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for tree in rpforest.fit(unit, len(unit), 0.9):
        assert sum((rows >= 2000).sum() for _, _, rows in tree.leaves(unit)) <= 4 * 1000


def test_what_is_broadcast_does_not_grow_with_the_table():
    draw = np.random.default_rng(6)
    unit = draw.normal(size=(20_000, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sizes, copies = [], []
    for total in (200_000, 2_000_000, 10**10):
        tree = rpforest.fit(unit, total, 0.9, trees=1)[0]
        sizes.append(len(tree.splits))
        copies.append(sum(len(rows) for *_, rows in tree.leaves(unit)) / len(unit))
    # nodes of fewer than TELLING sampled vectors are left to Spark
    assert max(sizes) <= 20_000 / rpforest.TELLING * 2 * rpforest.COPIES and sizes[2] <= 1.5 * sizes[1]
    assert max(copies) <= 1.2 * rpforest.COPIES


def test_crowded_nodes_are_grown_in_spark(spark, monkeypatch):
    """With a small sample the upper levels are few; nodes are split by groups of
    their own vectors, round after round."""
    draw = np.random.default_rng(12)
    vectors = draw.normal(size=(6000, 16))
    vectors[3000:] = vectors[:3000] + draw.normal(size=(3000, 16)) * 0.2
    ids = draw.permutation(len(vectors)).astype(np.int64)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    links, label = _links(ids, vectors)
    monkeypatch.setattr(rpforest, "LEVELS", 2)
    largest = spark.sparkContext.accumulator(0)
    compare_block = rpforest._compare

    def watched(*args):
        run = compare_block(*args)

        def compared(key, table):
            largest.add(1 if table.num_rows > 400 else 0)
            return run(key, table)
        return compared

    monkeypatch.setattr(rpforest, "_compare", watched)
    got = {r["vec_id"]: r for r in near_vectors(frame, sample=200, leaf=60).collect()}
    assert largest.value == 0
    assert all(got[i]["n_links"] <= n for i, n in zip(ids, links))
    assert sum(got[i]["n_links"] for i in ids) / links.sum() >= 0.99


def test_vectors_of_every_length_are_compared(spark):
    draw = np.random.default_rng(7)
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0]), (4, [3.0, 0.1]), (5, [0.0, 1.0]), (6, [1.0]), (7, [-1.0]), (8, [5.0])]
    many = draw.normal(size=(700, 9))
    rows += [(100 + i, v.tolist()) for i, v in enumerate(many)] + [(2000 + i, (v * 3 + draw.normal(size=9) * 0.01).tolist()) for i, v in enumerate(many)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), sample=300, leaf=50).collect()}
    assert [got[i] for i in range(1, 9)] == [(1, 1), (1, 1), (1, 3), (1, 3), (0, 5), (1, 6), (0, 7), (1, 6)]
    links, label = _links(np.array([i for i, _ in rows[8:]]), np.array([v for _, v in rows[8:]]))
    assert sum(got[i][0] == n for (i, _), n in zip(rows[8:], links)) >= 0.99 * len(links)


def test_a_cluster_that_the_sample_hardly_shows_is_compared_in_blocks(spark, monkeypatch):
    draw = np.random.default_rng(4)
    center = draw.normal(size=64)
    vectors = np.concatenate([draw.normal(size=(3000, 64)), center + draw.normal(size=(400, 64)) * 0.05])
    ids = draw.permutation(len(vectors)).astype(np.int64)
    links, label = _links(ids, vectors)
    compare_block = rpforest._compare

    def watched(*args):
        run = compare_block(*args)

        def compared(key, table):
            # two blocks of about 100 vectors
            assert table.num_rows < 300, table.num_rows
            return run(key, table)
        return compared

    monkeypatch.setattr(rpforest, "_compare", watched)
    monkeypatch.setattr(rpforest, "PAIRS", 100, raising=False)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    # about 20 of the 400 are in the sample, fewer than TELLING
    got = {r["vec_id"]: r for r in near_vectors(frame, sample=170, leaf=100, block=100).collect()}
    assert [got[i]["n_links"] for i in ids] == links.tolist()
    assert [got[i]["component_id"] for i in ids] == label.tolist()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    res = compare(spark, SF, name, queries.QUERIES[name], queries.ORACLE_SQL[name], duck_connection(SF))
    assert res["columns_match"] and res["types_match"] and res["values_match"], res


def test_addresses_have_no_parent_domains_and_long_histories_are_indexed(spark):
    entries = [("block", "domain", "3.4", "add", _day(0)), ("block", "domain", "0.0.1", "add", _day(0)), ("block", "domain", "1.2.3.5", "add", _day(0)),
               ("block", "domain", "[2001:db8::1]", "add", _day(0)), ("block", "domain", "db8::1]", "add", _day(0)),
               *[("block", "domain", "flips.net", ("add", "remove")[d % 2], _day(d)) for d in range(400)],
               *[("block2", "domain", "flips.net", ("add", "remove")[d % 2], _day(d * 3)) for d in range(100)]]
    captures = [(1, "http://1.2.3.4/", _day(5)), (2, "http://10.0.0.1:8080/x", _day(5)), (3, "http://1.2.3.5/a", _day(5)),
                (4, "http://[2001:DB8::1]:81/x", _day(5)), (5, "http://[2001:db8::2]/", _day(5)), (6, "http://1.2.3.4.org/", _day(5))]
    captures += [(1000 + d, "http://a.flips.net/", _day(d)) for d in range(0, 500, 7)]
    got = {r["page_id"]: r for r in urlfilter.judge(
        spark.createDataFrame(captures, "page_id long, url string, fetched date"),
        spark.createDataFrame(entries, "list string, kind string, key string, action string, day date")).collect()}
    assert [i for i in range(1, 7) if got[i]["blocked"]] == [3, 4] and got[4]["by_key"] == "[2001:db8::1]"
    for d in range(0, 500, 7):
        want = (min(d, 399) % 2 == 0) + (min(d // 3, 99) % 2 == 0)
        assert got[1000 + d]["n_block"] == want, d


def test_the_index_has_one_row_an_entry_at_most(spark):
    rows = [("block", "domain", f"k{i}.org", "add", _day(-9000)) for i in range(50)]
    valid = urlfilter.validity_intervals(spark.createDataFrame(rows, "list string, kind string, key string, action string, day date"))
    directory, chunks = urlfilter.interval_index(valid)
    assert directory.count() == chunks.count() == 50


def test_formatting_is_reversible(spark):
    draw = random.Random(1)
    bits = [*chat.MARKS, "\\", "<", "[", "/", "s>", "INST]", "a", " ", "\n", "é😀", "$1", "<\\s>", "[\\/INST]", "</s", "ROLE]", "x" * 500]
    rows = []
    for c in range(300):
        for t in range(draw.randint(1, 6)):
            role = draw.choice(["user", "assistant", "system", "tool", "[ROLE]x", None, "", "assistant"])
            rows.append((c, t, role, None if draw.random() < .05 else "".join(draw.choice(bits) for _ in range(draw.randint(0, 9)))))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    examples = chat.format_examples(frame)
    back = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    by_conv = examples.collect()
    for c in range(300):
        turns = [(r or "", x or "") for i, _, r, x in rows if i == c]
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == turns
        assert [x for x in back[c]["loss"] if x or True] and "".join(back[c]["loss"]) == "".join(x for r, x in turns if r == "assistant")
        own = [e for e in by_conv if e["conv_id"] == c]
        assert sum(len(e["loss"]) for e in own) == sum(r == "assistant" for r, _ in turns)
        assert back[c]["formatted_chars"] == sum(len(e["formatted"]) for e in own)


def test_each_example_has_all_turns_before_its_reply(spark):
    rows = [(1, 2, "user", "more?"), (1, 0, "user", "hi"), (1, 1, "assistant", "<s>yo</s>"), (1, 3, "assistant", "no"), (1, 4, "user", "bye"),
            (None, 0, "system", "s"), (2, None, "assistant", None), (2, None, "assistant", None)]
    got = {(r["conv_id"], r["example"]): r for r in chat.format_examples(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    first = "[INST] hi [/INST]<s><\\s>yo<\\/s></s>"
    assert got[1, 0]["formatted"] == first and got[1, 1]["formatted"] == first + "[INST] more? [/INST]<s>no</s>"
    assert got[1, 2]["formatted"].endswith("[INST] bye [/INST]") and got[1, 2]["loss"] == []
    start, length = got[1, 1]["loss"][0]
    assert got[1, 1]["formatted"][start:start + length] == "no"
    assert got[None, 0]["loss"] == [] and len([k for k in got if k[0] == 2]) == 2
    assert chat.read_back(chat.format_examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).collect() == []


def test_a_very_long_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} </s> " + "x" * (t % 50)) for t in range(400)] + [(2, 0, "user", "y" * 200_000), (2, 1, "assistant", "z" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = chat.format_examples(frame)
    assert examples.count() == 201
    back = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["turns"]] == [(r, x) for i, _, r, x in rows if i == 1]
    assert back[1]["loss"] == [x for i, t, _, x in rows if i == 1 and t % 2] and back[2]["loss"] == ["z" * 200_000]


def test_chat_runs_without_python(spark):
    plan = queries.op5_prefix_target_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def _day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def test_lists_apply_only_while_they_are_valid(spark):
    entries = [("block", "domain", "bad.org", "add", _day(10)), ("block", "domain", "bad.org", "remove", _day(40)),
               ("block", "domain", "bad.org", "add", _day(100)), ("allow", "folder", "x.bad.org/ok/", "add", _day(0)),
               ("block", "url", "x.bad.org/ok/no?q=1", "add", _day(0)), ("block", "domain", "tie.net", "add", _day(5)),
               ("block", "domain", "tie.net", "remove", _day(5)), (None, "domain", "a.com", "add", _day(0)),
               ("block", "domain", None, "add", _day(0)), ("other", "domain", "a.com", "add", _day(0))]
    captures = [(1, "http://x.bad.org/a", _day(9)), (2, "http://x.bad.org/a", _day(10)), (3, "https://X.BAD.org:443/a#f", _day(39)),
                (4, "http://bad.org", _day(40)), (5, "http://bad.org", _day(700)), (6, "http://x.bad.org/ok/yes", _day(20)),
                (7, "http://u:p@x.bad.org/ok/no?q=1#z", _day(20)), (8, "http://tie.net/", _day(5)), (9, None, _day(5)), (10, "nonsense", _day(5)),
                (11, "http://bad.org", None), (12, "http://notbad.org/", _day(20)), (None, "http://bad.org", _day(20)), (2, "http://x.bad.org/a", _day(10)),
                (13, "http://a.com", _day(20)), (14, "http://bad.org./" + "d/" * 300, _day(20))]
    frame = spark.createDataFrame([(*c, "block") for c in captures], "page_id long, url string, fetched date, list string")
    got = urlfilter.judge(frame, spark.createDataFrame(entries, "list string, kind string, key string, action string, day date")).collect()
    assert len(got) == len(captures)
    assert sorted(str(r["page_id"]) for r in got if r["blocked"]) == sorted(["2", "2", "3", "5", "7", "None", "14"])
    six = next(r for r in got if r["page_id"] == 6)
    assert (six["n_block"], six["n_allow"], six["by_key"]) == (1, 1, "x.bad.org/ok/")
    assert urlfilter.judge(frame.limit(0), spark.createDataFrame(entries, "list string, kind string, key string, action string, day date")).collect() == []
    none = urlfilter.judge(frame, spark.createDataFrame([], "list string, kind string, key string, action string, day date")).collect()
    assert len(none) == len(captures) and not any(r["blocked"] for r in none)
