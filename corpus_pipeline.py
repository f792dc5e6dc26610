"""A training corpus from the documents table, in stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a frame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heldout.llm import bpe, langid, mixing
from heldout.llm.minhash import near_duplicates
from heldout.llm.queries import MIX_LEVELS, MIX_SEED, MIX_WEIGHTS, with_domain
from heldout.llm.recompression import remove_repeats
from heldout.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document goes if so many of its letters belong to no learned language's
#: alphabet, or if it has so many words and fewer of them than that in a lexicon.
MOST_FOREIGN, TELLING_WORDS, LEAST_KNOWN = 0.5, 10, 0.05
#: Consecutive words that make a repeated passage.
PASSAGE = 25
#: Share of the tokens that the mix is to have.  One epoch, so that nothing
#: which was deduplicated comes back.
SHARE, EPOCHS = 0.9, 1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels every document with its predicted language; those without a
    letter go, and those in no learned language: half of the letters or more in no
    learned alphabet, or ten words or more with fewer than one in twenty in any
    lexicon.

    Null and empty texts have no letter and go.  Rows are judged each by itself,
    whatever the length of their text, so equal rows share their fate; a null in
    another column does not matter, and lang is overwritten.  With no labelled
    row there is no language and every row goes.  An empty table stays empty.
    """
    found = langid.fit(docs).transform(docs, carry=COLUMNS)
    n_words = F.aggregate(F.map_values("words"), F.lit(0).cast("long"), lambda a, b: a + b)
    strange = (F.col("foreign") >= MOST_FOREIGN) | ((n_words >= TELLING_WORDS) & (F.col("known") < LEAST_KNOWN))
    return (found.where((F.col("lang_pred") != langid.NO_LANGUAGE) & ~strange)
            .withColumn("lang", F.col("lang_pred")).select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the
    smallest doc_id.

    A row whose doc_id other rows have too, or is null, counts as a document of its
    own under a hash of its columns: it goes only if it is a near duplicate (which of
    a group with such rows stays is then decided by these hashes), and of rows
    equal in all columns one stays.  Null and blank texts are like no other and
    stay.  An empty table stays empty.
    """
    rows = docs.select(*COLUMNS)
    several = materialize(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
                          .select(F.col("doc_id").alias("shared"), F.lit(True).alias("hashed")))
    told = (rows.join(several, F.col("doc_id").eqNullSafe(F.col("shared")), "left")
            .withColumn("row", F.when(F.col("hashed"), F.xxhash64(*COLUMNS)).otherwise(F.col("doc_id"))))
    kept = materialize(near_duplicates(told.select(F.col("row").alias("doc_id"), "text"), n=5, percent=80)
                       .where("kept").select(F.col("doc_id").alias("row")).distinct())
    stay = told.join(kept, "row", "left_semi")
    one = (stay.where("hashed").groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("first")).select("first.*"))
    return stay.where("hashed is null").select(*COLUMNS).unionByName(one)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 25 words or more that a document with a smaller doc_id has
    too are cut; documents that lose all words go.

    Null, empty and short texts stay as they are.  Rows with one doc_id cost each
    other nothing, and rows with a null doc_id neither lose nor cost anything.
    n_chars is that of the text left (null for a null text).  An empty table stays
    empty.
    """
    cut = remove_repeats(docs, width=PASSAGE, carry=("lang", "source"))
    return (cut.where("n_words = 0 or n_removed < n_words")
            .select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a mix of 90 % of the tokens takes, by a budget tree of
    domain, language and source; a document taken several times is there as
    often.

    A null lang or source is a node of its own.  Rows with one doc_id, lang and
    source are taken together.  Texts without a word are taken if they come
    before their leaf's cut.  An empty table stays empty.
    """
    taken = (mixing.mix(with_domain(docs), MIX_LEVELS, SHARE, MIX_WEIGHTS, EPOCHS, MIX_SEED).where("epochs > 0")
             .select(F.col("doc_id").alias("taken_id"), F.col("lang").alias("taken_lang"),
                     F.col("source").alias("taken_source"), "epochs").distinct())
    same = (F.col("doc_id").eqNullSafe(F.col("taken_id")) & F.col("lang").eqNullSafe(F.col("taken_lang"))
            & F.col("source").eqNullSafe(F.col("taken_source")))
    return (docs.select(*COLUMNS).join(taken, same)
            .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), "epochs"))).select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the text that
    they decode to.

    Null and empty texts have no ids.  Every row gives one, repeated or without a
    doc_id too.  An empty table stays empty.
    """
    coded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), decode=True)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned labels, components and merges have no SQL; tests/llm holds the
#: stages against plain versions.
ORACLE_SQL = None
