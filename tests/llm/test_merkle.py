import zlib

import pytest
from pyspark.sql import functions as F

from plain import SF, sha
from heldout.llm import merkle, queries


def _leaf(row):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def _tree(nodes, arity):
    """Each first node's (left, right) siblings from the bottom up, and the last node."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, above = [], []
        for i in range(0, len(nodes), arity):
            run = nodes[i:i + arity]
            for j in range(len(run)):
                for leaf in members[i + j]:
                    paths[leaf].append((run[:j], run[j + 1:]))
            up.append(sha("".join(run)))
            above.append([x for m in members[i:i + arity] for x in m])
        nodes, members = up, above
    return paths, nodes[0]


def _manifest(rows, arity):
    """(doc_id, leaf, subroot, root, path) of rows (doc_id, source, ...)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], _leaf(row)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = []
    for s in order:
        leaves = sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        paths, top = _tree([h for _, h in leaves], arity)
        built.append((leaves, paths, top))
    above, root = _tree([top for *_, top in built], arity) if built else ([], None)
    return [(doc, h, top, root, tuple((tuple(a), tuple(b)) for a, b in path + up))
            for (leaves, paths, top), up in zip(built, above, strict=True) for (doc, h), path in zip(leaves, paths, strict=True)]


def _found(frame):
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((tuple(s["left"]), tuple(s["right"])) for s in r["proof"])) for r in frame.collect()]


@pytest.mark.parametrize("arity,digits", [(2, 1), (2, 3), (3, 2), (16, 2)])
def test_proofs_match_trees_built_by_hand(spark, arity, digits):
    # sources of 1, 2, 9, 10, 17 and 300 rows, one null
    rows = [(i, s, "en", i % 5 if i % 7 else None, "Tεxt " * (i % 4) if i % 11 else None)
            for s, n in ((None, 10), ("", 1), ("a", 2), ("b", 300), ("é", 9), ("Z", 17)) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = _found(merkle.manifest(frame.repartition(7), arity=arity, digits=digits))
    assert sorted(got) == sorted(_manifest(rows, arity))


def test_many_sources_make_tiers_of_their_own(spark):
    rows = [(i, f"s{i // 2}", "en", 1, "x") for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(_found(merkle.manifest(frame, arity=2, digits=2))) == sorted(_manifest(rows, 2))


def test_odd_rows_and_empty_tables(spark, odd):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    key = lambda r: tuple(str(x) for x in r)
    rows = [tuple(r[c] for c in columns) for r in odd.collect()]
    assert sorted(_found(merkle.manifest(odd)), key=key) == sorted(_manifest(rows, 16), key=key)
    assert merkle.manifest(odd.limit(0)).collect() == []
    assert merkle.manifest(odd.limit(0)).columns == merkle.manifest(odd).columns
    alone = merkle.manifest(odd.where("doc_id = 4")).first()
    assert alone["leaf"] == alone["subroot"] == alone["root"] and alone["proof"] == []


def test_a_forged_leaf_folds_to_another_root(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    proofs = merkle.manifest(docs, carry={"forged": F.sha2("text", 256)})
    found = proofs.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("real"),
                          (merkle.fold(F.col("forged"), F.col("proof")) == F.col("root")).alias("forged"))
    assert found.agg(F.min("real").alias("a"), F.max("forged").alias("b")).first() == (True, False)


def test_query_finds_the_tampered_documents(spark):
    got = queries.op11_merkle_manifest(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]]
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in text)
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])


def test_a_source_is_many_blocks_and_joins_are_by_keys(spark):
    from conftest import executed_plans

    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.lit("en").alias("lang"),
                                     F.lit(1).cast("long").alias("n_chars"), F.lit("x").alias("text"))
    with executed_plans(spark) as plans:
        merkle.manifest(frame, arity=4, digits=2).collect()
    text = "\n".join(plans)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    nodes = frame.select(F.lit("=one").alias("name"), F.col("doc_id").alias("rank"), F.lit(3000).cast("long").alias("size"),
                         F.lit("h").alias("hash"), F.lit(0).alias("item"))
    sizes = [sum(len(k["kids"]) for k in r["kids"]) for r in merkle._blocks(nodes, 4, 2).collect()]
    assert len(sizes) == -(-3000 // 16) and max(sizes) == 16 and sum(sizes) == 3000
