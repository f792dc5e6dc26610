import pytest
from pyspark.sql import functions as F

import plain
from heldout.llm import mixing


def _shared(children, budget):
    """What (weight, capacity) children of a node get: fill by weight, share
    what full ones leave among the rest, again and again."""
    got, left = {}, dict(children)
    while left:
        weight = sum(w for w, _ in left.values())
        full = {c: cap for c, (w, cap) in left.items() if weight and w / weight * budget >= cap - 1e-9}
        if not full:
            return got | {c: (w / weight * budget if weight else 0.0) for c, (w, _) in left.items()}
        for c, cap in full.items():
            got[c] = cap
            budget -= cap
            del left[c]
    return got


LEAVES = [("web", "en", "s1", 1000), ("web", "en", "s2", 10), ("web", "de", "s3", 50), ("books", "en", "s4", 5), ("books", "fr", "s5", 700),
          ("news", "en", "s6", 300), (None, "en", "s7", 40), ("news", None, "s6", 30)]
WEIGHTS = {"domain": {"web": 1, "books": 6, "news": 2}, "lang": {"en": 3, "fr": 1, "de": 1}}


@pytest.mark.parametrize("total,epochs", [(100, 1), (1500, 1), (3000, 2), (10**6, 3), (0, 1)])
def test_budgets_match_filling_by_hand(spark, total, epochs):
    frame = spark.createDataFrame(LEAVES, "domain string, lang string, source string, tokens long")
    got = {(r["domain"], r["lang"], r["source"]): r["allotted"] for r in
           mixing.budgets(frame, ("domain", "lang", "source"), total, WEIGHTS, epochs).collect()}
    cap = lambda *key: sum(n * epochs for *k, n in LEAVES if tuple(k[:len(key)]) == key)
    weight = lambda level, x: WEIGHTS.get(level, {}).get(x, 1)
    kids = lambda *key: {k[len(key)] for *k, n in LEAVES if tuple(k[:len(key)]) == key}
    want = {}
    top = _shared({d: (weight("domain", d), cap(d)) for d in kids()}, min(total, cap()))
    for d, b in top.items():
        for lang, c in _shared({x: (weight("lang", x), cap(d, x)) for x in kids(d)}, b).items():
            for s, n in _shared({x: (1, cap(d, lang, x)) for x in kids(d, lang)}, c).items():
                want[d, lang, s] = n
    assert {k: pytest.approx(v, abs=1.001) for k, v in want.items()} == got
    assert abs(sum(got.values()) - min(total, cap())) <= len(got)


def test_a_weight_of_zero_gets_nothing(spark):
    frame = spark.createDataFrame(LEAVES, "domain string, lang string, source string, tokens long")
    got = mixing.budgets(frame, ("domain", "lang", "source"), 500, {"domain": {"web": 0}}, 1).collect()
    assert all(r["allotted"] == 0 for r in got if r["domain"] == "web") and sum(r["allotted"] for r in got) > 490


def test_each_leaf_is_a_prefix_of_its_epoch(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 13)), "en", "s" + str(i % 3)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, ("lang", "source"), 1.6, {}, max_epochs=3, seed=5)
    total = sum(i * 7 % 13 for i in range(3000))
    for s in ("s0", "s1", "s2"):
        leaf = got.where(F.col("source") == s).withColumn("draw", mixing.draw(5, F.lit(1), F.col("doc_id"))).orderBy("draw").collect()
        epochs = [r["epochs"] for r in leaf]
        assert set(epochs) <= {1, 2} and epochs == sorted(epochs, reverse=True)
        taken = sum(r["epochs"] * r["tokens"] for r in leaf)
        assert 0 <= taken - int(1.6 * total / 3) <= 13


def test_mix_of_odd_rows(spark, odd):
    got = mixing.mix(odd, ("lang", "source"), 1.0, {}, max_epochs=1).collect()
    assert len(got) == odd.count()
    assert sum(r["tokens"] for r in got) == sum(len(plain.words(r["text"])) for r in odd.collect())
    assert all(r["epochs"] == 1 for r in got if r["tokens"])
    assert mixing.mix(odd.limit(0), ("lang", "source"), 1.0, {}).collect() == []
    assert mixing.mix(odd.where("doc_id < 3"), ("lang",), 1.0, {}).count() == 3


def test_a_parent_with_very_many_children(spark):
    from conftest import executed_plans

    frame = spark.range(100_000).select(F.lit("web").alias("domain"), F.concat(F.lit("s"), "id").alias("source"), (F.col("id") % 97).alias("tokens"))
    frame = frame.unionByName(spark.createDataFrame([("books", "b", 10**6)], "domain string, source string, tokens long"))
    with executed_plans(spark) as plans:
        got = mixing.budgets(frame, ("domain", "source"), 2_000_000, {"domain": {"web": 3}}, 1).toPandas()
    web = got[got["domain"] == "web"]
    # 1,500,000 tokens for 100,000 sources that can use at most id % 97 each
    import numpy as np

    capacity = web["tokens"].to_numpy()
    low, high = 0.0, 97.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if np.minimum(capacity, middle).sum() < 1_500_000 else (low, middle)
    assert (web["allotted"].to_numpy() == np.floor(np.minimum(capacity, low) + 1e-6)).all()
    assert got[got["domain"] == "books"]["allotted"].item() == 500_000
    # windows go over range partitions and the table of their totals, never over siblings
    text = "\n".join(plans)
    assert "Window [" in text or "Window" in text
    assert not any("windowspecdefinition(level_" in line or "windowspecdefinition(root" in line for line in text.splitlines())
