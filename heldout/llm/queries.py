"""The operators' queries over the test tables, and DuckDB SQL for the same
rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heldout.llm import bpe, bytebpe, chat, fingerprint, langid, merkle, mixing, tokenfile, urlfilter
from heldout.llm.minhash import near_duplicates
from heldout.llm.recompression import remove_repeats
from heldout.llm.resample import resample
from heldout.llm.rpforest import near_vectors
from heldout.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents (4-word shingles, 80 %)."""
    return near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), n=4, percent=80)


def op2_recompression_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents covered by 13-word windows that also start in a
    document with a smaller doc_id."""
    cut = remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text"), width=13, layout=False)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those not held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return model.transform(docs).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_rp_forest_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all embeddings with cosine 0.9 or more."""
    return near_vectors(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), threshold=0.9)


def op5_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are full of marks, formatted and
    read back."""
    columns = ("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(F.lit(-7).cast("long"), "id", F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") + 1).cast("int")),
                                   F.lit("</s>[INST] ok [/INST]")).toDF(*columns)
    turns = _table(spark, sf_dir, "conversations", *columns).unionByName(marked)
    back = chat.read_back(chat.format_examples(turns))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(shown.cast("binary"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                       "formatted_chars")


def _number(column) -> F.Column:
    """A number below 2^24 drawn from a text."""
    return F.conv(F.substring(F.md5(column), 1, 6), 16, 10).cast("int")


def list_entries(pages: DataFrame) -> DataFrame:
    """Stand-in for a table that the test data lacks: dated entries of a block
    and an allow list, for some of the domains, folders and URLs of pages."""
    keys = (pages.select(F.inline(urlfilter.url_keys(F.col("url")))).select("kind", "key").distinct()
            .withColumn("n", _number(F.concat_ws(" ", "kind", "key"))))
    def entry(name, action, offset, every):
        return F.when(F.col("n") % every == 0, F.struct(
            F.lit(name).alias("list"), F.lit(action).alias("action"),
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("n") % 290 + offset).alias("day")))
    changes = F.array(entry("block", "add", 0, 3), entry("block", "remove", 45, 6), entry("block", "add", 80, 12),
                      entry("allow", "add", 20, 15), entry("allow", "remove", 70, 30))
    return (keys.select("kind", "key", F.explode(changes).alias("change")).where("change is not null")
            .select("kind", "key", "change.list", "change.action", "change.day"))


def op6_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, judged by the list entries that were valid when each was
    fetched (the day is a stand-in drawn from page_id)."""
    pages = _table(spark, sf_dir, "pages", "page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), _number(F.col("page_id").cast("string")) % 365))
    return urlfilter.judge(captures, list_entries(pages))


#: Levels of the budget tree and target weights of their nodes (1 if not named).
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {"domain": {"web": 4, "books": 3, "forum": 2, "news": 1},
               "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 1.2, 4, 11


def with_domain(docs: DataFrame) -> DataFrame:
    """Stand-in for a column that the documents table lacks: a domain for each
    source, by the digits in its name."""
    digits = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    number = F.when(digits == "", F.lit(0)).otherwise(F.substring(digits, -1, 1).cast("int"))
    return docs.withColumn("domain", F.element_at(F.array(*map(F.lit, ("web", "books", "forum", "news"))), number % 4 + 1))


def op7_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a mix of 1.2 times all tokens takes each document, with a
    budget tree of domain, language and source and up to four epochs."""
    docs = with_domain(_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return mixing.mix(docs, MIX_LEVELS, MIX_SHARE, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED)


def op8_prefix_hash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint.compare_neighbours(_table(spark, sf_dir, "documents", "doc_id", "text"))


#: Id behind every document in the token dataset.
END_ID = 2


def op9_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids, written as a dataset and read back."""
    path = scratch_path(spark)
    tokenfile.write_tokens(_table(spark, sf_dir, "documents", "doc_id", "text"),
                           public_tokenizers.path("word_bpe_49k.json"), path, END_ID)
    read = tokenfile.read_tokens(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return tokenfile.with_starts(read, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and the text that they decode to."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents by source, and the roots that they give;
    of a fifth of the documents with A-Z of the text lower-cased."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    forged = F.when(tampered, merkle.leaf_hash("doc_id", "source", "lang", "n_chars", F.translate("text", _CAPITALS, _SMALL)))
    proofs = merkle.manifest(docs, carry={"forged": forged})
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(merkle.siblings(F.col("proof")), ""), 256).alias("proof_sha256"),
        merkle.fold(F.coalesce("forged", "leaf"), F.col("proof")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def op12_byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level token ids of all documents, and the bytes that they decode
    to."""
    coded = bytebpe.encode(_table(spark, sf_dir, "documents", "doc_id", "text"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighted towards the benchmark's texts, and the tenth of
    them that is drawn."""
    drawn = resample(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_recompression_substring_dedup": op2_recompression_substring_dedup,
    "op3_crf_language_id": op3_crf_language_id,
    "op4_rp_forest_near_dedup": op4_rp_forest_near_dedup,
    "op5_prefix_target_chat": op5_prefix_target_chat,
    "op6_temporal_url_filter": op6_temporal_url_filter,
    "op7_hierarchical_mix": op7_hierarchical_mix,
    "op8_prefix_hash_fingerprints": op8_prefix_hash_fingerprints,
    "op9_elias_fano_tokens": op9_elias_fano_tokens,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_byte_bpe_round_trip": op12_byte_bpe_round_trip,
    "op13_importance_resample": op13_importance_resample,
}


def _crc32_sql(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: list_reduce("
            "list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)")


def _mix_level(i: int) -> str:
    """SQL of one level's shares; ``i`` counts from the root."""
    level, above = MIX_LEVELS[i], MIX_LEVELS[:i]
    keys, parent = ", ".join(MIX_LEVELS[:i + 1]), ", ".join(above)
    by = f"PARTITION BY {parent} " if parent else ""
    weight = "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in MIX_WEIGHTS.get(level, {"": 1}).items()) + " ELSE 1 END"
    given = f"JOIN share{i - 1} USING ({parent})" if i else \
        "CROSS JOIN (SELECT least(sum(n) * 1.2::DOUBLE, sum(n) * 4::DOUBLE) AS budget FROM leaves)"
    return f"""
  node{i} AS (SELECT {keys}, sum(n) * 4::DOUBLE AS cap, ({weight})::DOUBLE AS w FROM leaves GROUP BY {keys}),
  step{i} AS (SELECT {keys}, cap, w, cap / w AS ratio,
      (budget - coalesce(sum(cap) OVER ({by}ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER ({by}ORDER BY cap / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
    FROM node{i} {given}),
  share{i} AS (SELECT {keys}, CASE WHEN ratio <= lvl THEN cap
      ELSE w * max(CASE WHEN ratio > lvl THEN lvl END) OVER ({by.strip()}) END AS budget FROM step{i}),"""


def _told_sql(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}, '-')"


#: Levels of a group and of the subroots that the SQL of op11 covers: 16 ** 7 nodes.
_MERKLE_LEVELS = 7


def _merkle_sql(name: str, keys: str) -> str:
    """SQL of all levels of trees over ``{name}0`` (the keys, pos, h), and of each
    first node's hashes to the left and right at each level (null: none made)."""
    out = f"{name}n0 AS (SELECT {keys}, count(*) AS n FROM {name}0 GROUP BY {keys}),"
    for i in range(_MERKLE_LEVELS):
        out += f"""
  {name}{i + 1} AS (SELECT {keys}, pos // 16 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
    FROM {name}{i} JOIN {name}n{i} USING ({keys}) GROUP BY {keys}, pos // 16),
  {name}n{i + 1} AS (SELECT {keys}, (n + 15) // 16 AS n FROM {name}n{i}),
  {name}s{i} AS (SELECT a.{keys}, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
      coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
    FROM {name}{i} a JOIN {name}{i} b ON a.{keys} = b.{keys} AND a.pos // 16 = b.pos // 16 JOIN {name}n{i} c ON a.{keys} = c.{keys}
    WHERE c.n > 1 GROUP BY a.{keys}, a.pos),"""
    return out


def _fold_sql() -> str:
    """SQL of each document's node and hashes so far, from its leaf to the root."""
    out, last = "", "start"
    for i in range(2 * _MERKLE_LEVELS):
        of, level, pos, key = ("leaf", i, "pos", "src") if i < _MERKLE_LEVELS else ("top", i - _MERKLE_LEVELS, "spot", "one")
        out += f"""
  fold{i} AS (SELECT p.* REPLACE (CASE WHEN s.l IS NULL THEN x ELSE sha256(s.l || x || s.r) END AS x, proof || coalesce(s.l || s.r, '') AS proof,
      p.{pos} // 16 AS {pos}) FROM {last} p LEFT JOIN {of}s{level} s ON s.{key} = p.{key} AND s.pos = p.{pos}),"""
        last = f"fold{i}"
    return out


#: Components of links (a, b) among ids, by reachability (for small tables).
_COMPONENTS_SQL = """
  reach AS (SELECT id, id AS node FROM ids UNION
    SELECT reach.id, CASE WHEN links.a = reach.node THEN links.b ELSE links.a END FROM reach JOIN links ON reach.node IN (links.a, links.b)),
  label AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)"""

#: Marks of the chat template, as a pattern of what follows their first sign.
_MARK_SQL = r"'([<\[])(\\*)(/?SYS\]|/?INST\]|/?ROLE\]|/TURN\]|/?s>)', '\1\2\\\3', 'g'"

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS l FROM documents),
  grams AS (SELECT DISTINCT doc_id, array_to_string(l[i:i + 3], ' ') AS g
    FROM (SELECT doc_id, l, unnest(range(1, greatest(2, len(l) - 2))) AS i FROM words WHERE len(l) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
  common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
  links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
  ids AS (SELECT doc_id AS id FROM documents),""" + _COMPONENTS_SQL + """
SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, id = component_id AS kept
FROM label LEFT JOIN sizes ON sizes.doc_id = id
""",
    "op2_recompression_substring_dedup": r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
  windows AS (SELECT doc_id, i, array_to_string(l[i:i + 12], ' ') AS s
    FROM (SELECT doc_id, l, unnest(range(1, len(l) - 11)) AS i FROM words WHERE len(l) >= 13)),
  lost AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE first < doc_id),
  gone AS (SELECT DISTINCT doc_id, i + k AS p FROM lost, (SELECT unnest(range(13)) AS k)),
  each AS (SELECT doc_id, unnest(l) AS word, unnest(range(1, len(l) + 1)) AS p FROM words),
  kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS s FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(l)::BIGINT AS n_words, (len(l) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""",
    "op4_rp_forest_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
  links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id < y.id WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
  ids AS (SELECT id FROM v),""" + _COMPONENTS_SQL + """,
  degree AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept FROM label LEFT JOIN degree USING (id)
""",
    "op5_prefix_target_chat": f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
  sized AS (SELECT *, length(regexp_replace(text, {_MARK_SQL})) + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15
      WHEN 'assistant' THEN 7 ELSE 20 + length(regexp_replace(role, {_MARK_SQL})) END AS size FROM turns),
  running AS (SELECT *, sum(size) OVER w AS upto, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS last
    FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR last THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
""",
    "op6_temporal_url_filter": r"""
WITH parts AS (
    SELECT page_id, regexp_extract(trim(url), '^(?i:[a-z][a-z0-9+.-]*):(?://)?(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]*)(?::([0-9]*))?([^?#]*)(\?[^#]*)?',
      ['host', 'port', 'path', 'query']) AS u FROM pages),
  named AS (SELECT page_id, rtrim(lower(u.host), '.') AS host, regexp_matches(rtrim(lower(u.host), '.'), '^(\[.*|[0-9]+(\.[0-9]+){3})$') AS address, CASE WHEN u.port IN ('', '80', '443') THEN '' ELSE ':' || u.port END AS port,
      CASE WHEN u.path = '' THEN '/' ELSE u.path END AS path, u.query AS query FROM parts),
  keys AS (
    SELECT page_id, 'domain' AS kind, array_to_string(l[i:], '.') AS key, len(l) - i AS rank
    FROM (SELECT page_id, l, unnest(range(1, greatest(2, len(l)))) AS i FROM (
      SELECT page_id, CASE WHEN address THEN [host] ELSE string_split(host, '.') END AS l FROM named WHERE host <> ''))
    UNION ALL
    SELECT page_id, 'folder', host || port || array_to_string(s[1:i], '/') || '/', 1000 + i
    FROM (SELECT page_id, host, port, string_split(path, '/') AS s, unnest(range(1, greatest(2, len(string_split(path, '/'))))) AS i FROM named WHERE host <> '')
    UNION ALL SELECT page_id, 'url', host || port || path || query, 1000000 FROM named WHERE host <> ''),
  numbered AS (SELECT DISTINCT kind, key, ('0x' || substr(md5(kind || ' ' || key), 1, 6))::INT AS n FROM keys),
  entries AS (SELECT kind, key, list, action, DATE '2024-01-01' + (n % 290 + later)::INT AS day FROM numbered,
      (VALUES ('block', 'add', 0, 3), ('block', 'remove', 45, 6), ('block', 'add', 80, 12), ('allow', 'add', 20, 15), ('allow', 'remove', 70, 30))
      c(list, action, later, every) WHERE n % every = 0),
  days AS (SELECT list, kind, key, day, max(action) AS action FROM entries GROUP BY ALL),
  valid AS (SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY list, kind, key ORDER BY day) AS until FROM days) WHERE action = 'add'),
  captures AS (SELECT page_id, DATE '2024-01-01' + (('0x' || substr(md5(page_id::VARCHAR), 1, 6))::INT % 365)::INT AS fetched FROM pages),
  met AS (SELECT page_id, list, rank, key FROM captures JOIN keys USING (page_id) JOIN valid USING (kind, key)
    WHERE day <= fetched AND (until IS NULL OR fetched < until)),
  judged AS (SELECT page_id, count(*) FILTER (WHERE list = 'block') AS b, count(*) FILTER (WHERE list = 'allow') AS a,
      max(rank) FILTER (WHERE list = 'block') AS br, max(rank) FILTER (WHERE list = 'allow') AS ar, max({'rank': rank, 'key': key}) AS top
    FROM met GROUP BY page_id)
SELECT page_id, fetched, coalesce(b, 0)::BIGINT AS n_block, coalesce(a, 0)::BIGINT AS n_allow,
  coalesce(br > coalesce(ar, -1), false) AS blocked, top.key AS by_key
FROM captures LEFT JOIN judged USING (page_id)
""",
    "op7_hierarchical_mix": f"""
WITH docs AS (
    SELECT doc_id, lang, source, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens,
      (['web', 'books', 'forum', 'news'])[coalesce(try_cast(right(regexp_extract(source, '([0-9]+)$', 1), 1) AS INT), 0) % 4 + 1] AS domain
    FROM documents),
  leaves AS (SELECT domain, lang, source, sum(tokens) AS n FROM docs GROUP BY ALL),{_mix_level(0)}{_mix_level(1)}{_mix_level(2)}
  allot AS (SELECT domain, lang, source, n, floor(budget + 1e-6)::BIGINT AS a FROM leaves JOIN share2 USING (domain, lang, source)),
  epoch AS (SELECT *, CASE WHEN n > 0 THEN a // n ELSE 0 END::BIGINT AS whole FROM allot),
  placed AS (SELECT d.*, whole, a - whole * n AS rest,
      sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{MIX_SEED}:' || whole || ':' || doc_id)) - tokens AS start
    FROM docs d JOIN epoch USING (domain, lang, source))
SELECT doc_id, tokens, domain, lang, source, (whole + CASE WHEN start < rest THEN 1 ELSE 0 END)::BIGINT AS epochs FROM placed
""",
    "op11_merkle_manifest": f"""
WITH docs AS (
    SELECT *, translate(text, '{_CAPITALS}', '{_SMALL}') AS small, coalesce('=' || source, '') AS src FROM documents),
  hashed AS (SELECT doc_id, src, sha256({" || ".join(map(_told_sql, ("doc_id", "source", "lang", "n_chars", "text")))}) AS h,
      CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 5 = 0
        THEN sha256({" || ".join(map(_told_sql, ("doc_id", "source", "lang", "n_chars", "small")))}) END AS forged FROM docs),
  leaf0 AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM hashed),
  {_merkle_sql("leaf", "src")}
  top0 AS (SELECT 1 AS one, src, h, row_number() OVER (ORDER BY encode(src)) - 1 AS pos FROM leaf{_MERKLE_LEVELS}),
  {_merkle_sql("top", "one")}
  start AS (SELECT doc_id, a.src, a.pos, 1 AS one, t.pos AS spot, a.h AS leaf, t.h AS subroot, coalesce(forged, a.h) AS x, '' AS proof
    FROM leaf0 a JOIN top0 t USING (src)),{_fold_sql()}
  root AS (SELECT h FROM top{_MERKLE_LEVELS})
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = root.h AS verified
FROM fold{2 * _MERKLE_LEVELS - 1}, root
""",
    "op13_importance_resample": f"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS l FROM documents),
  wanted AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS l FROM benchmark),
  own AS (SELECT doc_id, unnest(l) AS word FROM texts),
  theirs AS (SELECT unnest(l) AS word FROM wanted),
  hashed AS (SELECT word, {_crc32_sql("word")} % 10000 AS bucket FROM (SELECT word FROM own UNION SELECT word FROM theirs)),
  s AS (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (word) GROUP BY bucket),
  t AS (SELECT bucket, count(*) AS t FROM theirs JOIN hashed USING (word) GROUP BY bucket),
  gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
      / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM (SELECT range AS bucket FROM range(10000)) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
  weights AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS g FROM own JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
  scored AS (SELECT doc_id, coalesce(n, 0) AS n, CASE WHEN n > 0 THEN (g - ((g % n) + n) % n) // n ELSE 0 END AS weight,
      (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE AS u FROM texts LEFT JOIN weights USING (doc_id)),
  noised AS (SELECT doc_id, n, weight, weight + floor(-1000 * ln(-ln(u)))::BIGINT AS score FROM scored),
  placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS drawn FROM noised WHERE n >= 20)
SELECT doc_id, n::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN place <= drawn THEN place END::BIGINT AS rank
FROM noised LEFT JOIN placed USING (doc_id)
""",
}
