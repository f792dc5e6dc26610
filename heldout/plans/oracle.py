"""DuckDB SQL computing the same answers as ``QUERIES``, written independently.

Tables are the pre-registered views named after the driver's Parquet files.
"""

from __future__ import annotations

# Labelled documents with the two naive Bayes features and the md5 split.
_LABELLED = r"""
feats AS (
  SELECT d.doc_id,
         ln(d.n_chars + 1) AS log_chars,
         CAST(len(regexp_extract_all(d.text, '[^ \t\r\n]+')) AS DOUBLE) AS n_words,
         l.quality, l.toxic,
         substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 2) < 'cc' AS is_train
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

# Gaussian naive Bayes for quality: class statistics on the training rows,
# joint log likelihood of every held-out row under every class.
_NB_SCORED = _LABELLED + r""",
cls AS (
  SELECT quality AS cls, count(*) AS n,
         avg(log_chars) AS m1, var_pop(log_chars) AS v1,
         avg(n_words) AS m2, var_pop(n_words) AS v2
  FROM feats WHERE is_train GROUP BY quality
),
eps AS (
  SELECT 1e-9 * greatest(var_pop(log_chars), var_pop(n_words)) AS e
  FROM feats WHERE is_train
),
tot AS (SELECT sum(n) AS total FROM cls),
jll AS (
  SELECT f.doc_id, f.quality, c.cls,
         ln(c.n / t.total)
         - 0.5 * ln(2 * pi() * (c.v1 + e.e)) - (f.log_chars - c.m1) ^ 2 / (2 * (c.v1 + e.e))
         - 0.5 * ln(2 * pi() * (c.v2 + e.e)) - (f.n_words - c.m2) ^ 2 / (2 * (c.v2 + e.e)) AS s
  FROM feats f CROSS JOIN cls c CROSS JOIN eps e CROSS JOIN tot t
  WHERE NOT f.is_train
),
pred AS (
  SELECT doc_id, quality, cls AS predicted
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, cls) AS rk FROM jll)
  WHERE rk = 1
),
odds AS (
  SELECT doc_id, quality,
         max(CASE WHEN cls = 1 THEN s END) - max(CASE WHEN cls = 0 THEN s END) AS score
  FROM jll GROUP BY doc_id, quality
)"""

_CONFUSION_FROM = r"""
counts AS (
  SELECT CAST(sum(CASE WHEN actual = 1 AND predicted = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN actual <> 1 AND predicted = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN actual <> 1 AND predicted <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN actual = 1 AND predicted <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM labelled_predictions
)
SELECT tp, fp, tn, fn, tp + fp + tn + fn AS n,
       CAST(tp + tn AS DOUBLE) / nullif(tp + fp + tn + fn, 0) AS accuracy,
       CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
       CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
       CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1,
       (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
         / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0) AS mcc
FROM counts"""

# Mann-Whitney ROC area with average ranks for ties.
_AUC_FROM = r"""
ranked AS (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0
           AS r
  FROM scored_rows
),
agg AS (
  SELECT CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
         CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n_neg,
         sum(CASE WHEN label = 1 THEN r ELSE 0 END) AS rank_sum
  FROM ranked
)
SELECT n_pos, n_neg,
       (rank_sum - CAST(n_pos AS DOUBLE) * (n_pos + 1) / 2)
         / nullif(CAST(n_pos AS DOUBLE) * n_neg, 0) AS auc
FROM agg"""

# Columns of lineitem, and whether they are numbers.
_LINEITEM = [*[(c, True) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                   "l_extendedprice", "l_discount", "l_tax")],
             *[(c, False) for c in ("l_returnflag", "l_linestatus", "l_shipdate")]]

ORACLE_SQL: dict[str, str] = {
    "lineitem_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
        + (f"round(avg({c}), 9) AS mean, round(stddev_samp({c}), 9) AS stddev" if numeric
           else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev") + " FROM lineitem"
        for c, numeric in _LINEITEM),
    "label_balance": r"""
SELECT quality, toxic, count(*) AS n,
       count(*) / sum(count(*)) OVER () AS share
FROM labels GROUP BY quality, toxic""",
    "acctbal_median_impute": r"""
WITH c AS (
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal
  FROM customer
),
med AS (
  SELECT c_mktsegment, quantile_cont(acctbal, 0.5) AS median
  FROM c WHERE acctbal IS NOT NULL GROUP BY c_mktsegment
)
SELECT c.c_custkey, c.c_mktsegment, round(coalesce(c.acctbal, med.median), 6) AS acctbal_filled,
       c.acctbal IS NULL AS was_missing
FROM c LEFT JOIN med ON c.c_mktsegment = med.c_mktsegment""",
    "segment_acctbal_quartiles": r"""
SELECT c_mktsegment, prob, round(value, 6) AS value FROM (
  SELECT c_mktsegment, CAST(0.25 AS DOUBLE) AS prob, quantile_cont(c_acctbal, 0.25) AS value
  FROM customer GROUP BY c_mktsegment
  UNION ALL
  SELECT c_mktsegment, CAST(0.5 AS DOUBLE), quantile_cont(c_acctbal, 0.5) FROM customer GROUP BY c_mktsegment
  UNION ALL
  SELECT c_mktsegment, CAST(0.75 AS DOUBLE), quantile_cont(c_acctbal, 0.75) FROM customer GROUP BY c_mktsegment
)""",
    "part_type_index": r"""
SELECT p_type, count(*) AS n,
       row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS type_index
FROM part GROUP BY p_type""",
    "event_type_indexed": r"""
WITH idx AS (
  SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS type_index
  FROM events GROUP BY event_type
)
SELECT e.event_id, e.event_type, idx.type_index
FROM events e LEFT JOIN idx ON e.event_type = idx.event_type""",
    "event_type_one_hot": r"""
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click,
       count(*) FILTER (WHERE event_type = 'error') AS error,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       count(*) FILTER (WHERE event_type = 'signup') AS signup,
       count(*) FILTER (WHERE event_type = 'view') AS view
FROM events GROUP BY user_id""",
    "order_price_scaled": r"""
WITH s AS (
  SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
         avg(o_totalprice) AS mu, stddev_samp(o_totalprice) AS sd
  FROM orders
)
SELECT o_orderkey,
       (o_totalprice - lo) / nullif(hi - lo, 0) AS o_totalprice_minmax,
       round((o_totalprice - mu) / nullif(sd, 0), 6) AS o_totalprice_z
FROM orders CROSS JOIN s""",
    "order_price_quartile_bins": r"""
WITH q AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS c FROM orders),
b AS (
  SELECT o_totalprice,
         CAST((o_totalprice > c[1])::INTEGER + (o_totalprice > c[2])::INTEGER
              + (o_totalprice > c[3])::INTEGER AS INTEGER) AS price_bin
  FROM orders CROSS JOIN q
)
SELECT price_bin, count(*) AS n, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
FROM b GROUP BY price_bin""",
    "document_split_counts": r"""
SELECT CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 2) < 'cc' THEN 'train' ELSE 'test' END
         AS part,
       quality, count(*) AS n
FROM documents JOIN labels USING (doc_id) GROUP BY ALL""",
    "lineitem_correlations": r"""
SELECT * FROM (
  SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b,
         round(corr(l_quantity, l_extendedprice), 9) AS corr FROM lineitem
  UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 9) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 9) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 9) FROM lineitem
)""",
    "embedding_nearest_centroid": r"""
WITH e AS (
  SELECT vec_id, embedding, label,
         substr(md5(CAST(vec_id AS VARCHAR)), 1, 2) < 'cc' AS is_train
  FROM embeddings
),
elems AS (
  SELECT vec_id, label, is_train, unnest(embedding) AS x,
         unnest(generate_series(1, len(embedding))) AS i
  FROM e
),
cent AS (
  SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM elems WHERE is_train GROUP BY label, i
),
dist AS (
  SELECT t.vec_id, t.label AS actual, cent.label AS cls,
         sum((CAST(t.x AS DOUBLE) - cent.c) * (CAST(t.x AS DOUBLE) - cent.c)) AS d
  FROM elems t JOIN cent ON t.i = cent.i
  WHERE NOT t.is_train
  GROUP BY t.vec_id, t.label, cent.label
)
SELECT vec_id, actual, cls AS predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cls) AS rk FROM dist
) WHERE rk = 1""",
    "nb_quality_kfold": "WITH" + _LABELLED + r""",
folded AS (
  SELECT *, CAST(CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 3, 15)) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM feats
),
folds AS (SELECT DISTINCT fold AS f FROM folded),
cls AS (
  SELECT folds.f, quality AS cls, count(*) AS n,
         avg(log_chars) AS m1, var_pop(log_chars) AS v1,
         avg(n_words) AS m2, var_pop(n_words) AS v2
  FROM folds JOIN folded ON folded.fold <> folds.f
  GROUP BY folds.f, quality
),
eps AS (
  SELECT folds.f, 1e-9 * greatest(var_pop(log_chars), var_pop(n_words)) AS e
  FROM folds JOIN folded ON folded.fold <> folds.f GROUP BY folds.f
),
tot AS (SELECT f, sum(n) AS total FROM cls GROUP BY f),
jll AS (
  SELECT x.doc_id, x.fold, x.quality, c.cls,
         ln(c.n / t.total)
         - 0.5 * ln(2 * pi() * (c.v1 + e.e)) - (x.log_chars - c.m1) ^ 2 / (2 * (c.v1 + e.e))
         - 0.5 * ln(2 * pi() * (c.v2 + e.e)) - (x.n_words - c.m2) ^ 2 / (2 * (c.v2 + e.e)) AS s
  FROM folded x
  JOIN cls c ON c.f = x.fold
  JOIN eps e ON e.f = x.fold
  JOIN tot t ON t.f = x.fold
),
pred AS (
  SELECT fold, quality AS actual, cls AS predicted
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, cls) AS rk FROM jll)
  WHERE rk = 1
),
odds AS (
  SELECT doc_id, fold, quality,
         max(CASE WHEN cls = 1 THEN s END) - max(CASE WHEN cls = 0 THEN s END) AS score
  FROM jll GROUP BY doc_id, fold, quality
),
ranked AS (
  SELECT fold, quality,
         rank() OVER (PARTITION BY fold ORDER BY score)
         + (count(*) OVER (PARTITION BY fold, score) - 1) / 2.0 AS r
  FROM odds
),
aucs AS (
  SELECT fold,
         (sum(CASE WHEN quality = 1 THEN r ELSE 0 END)
          - CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS DOUBLE)
            * (sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) + 1) / 2)
         / nullif(CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS DOUBLE)
                  * sum(CASE WHEN quality = 1 THEN 0 ELSE 1 END), 0) AS auc
  FROM ranked GROUP BY fold
),
counts AS (
  SELECT fold,
         CAST(sum(CASE WHEN actual = 1 AND predicted = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN actual <> 1 AND predicted = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN actual <> 1 AND predicted <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN actual = 1 AND predicted <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM pred GROUP BY fold
)
SELECT counts.fold, tp, fp, tn, fn, tp + fp + tn + fn AS n,
       CAST(tp + tn AS DOUBLE) / nullif(tp + fp + tn + fn, 0) AS accuracy,
       CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
       CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
       CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1,
       (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
         / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0) AS mcc,
       aucs.auc
FROM counts LEFT JOIN aucs ON counts.fold = aucs.fold""",
    "nb_quality_holdout": "WITH" + _NB_SCORED + r"""
SELECT quality AS actual, predicted, count(*) AS n FROM pred GROUP BY quality, predicted""",
    "nb_quality_confusion": "WITH" + _NB_SCORED + r""",
labelled_predictions AS (SELECT quality AS actual, predicted FROM pred),""" + _CONFUSION_FROM,
    "nb_quality_auc": "WITH" + _NB_SCORED + r""",
scored_rows AS (SELECT quality AS label, score FROM odds),""" + _AUC_FROM,
}
