"""The registered queries of the corpus operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civicmart.llm import decontamination, interpolation, lexical, negatives, packing, pii, quality, ring, secret_scan, simhash, tokens, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_quality(spark, sf_dir):
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_top_neighbours(spark, sf_dir):
    return topk.neighbours(table(spark, sf_dir, "embeddings"))


@query
def op6_language_model(spark, sf_dir):
    return interpolation.scores(table(spark, sf_dir, "documents"))


@query
def op7_personal_data(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op8_secret_scans(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op9_decontamination(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_ranked_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_hard_negatives(spark, sf_dir):
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query
def op13_sharding(spark, sf_dir):
    return ring.sharded(table(spark, sf_dir, "documents"))


ORACLE_SQL["op5_top_neighbours"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
  SELECT q.r AS q, q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON d.r <> q.r WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
) WHERE rank <= 10"""
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE_SQL["op9_decontamination"] = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win FROM starts),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows)),
found AS (SELECT r, i, k, item_id FROM (SELECT r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win FROM places) JOIN windows USING (k, win)),
hit AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(i, i + k)) AS word FROM found) GROUP BY r),
named AS (SELECT r, list_sort(list(DISTINCT item_id)) AS ids FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
ORACLE_SQL["op11_ranked_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
kept AS (SELECT r, doc_id, w, len(w) AS n FROM docs WHERE len(w) > 0),
sizes AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM kept),
items AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS w FROM benchmark),
asked AS (SELECT i, item_id, unnest(w) AS term FROM items),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM kept) SEMI JOIN (SELECT DISTINCT term FROM asked) USING (term) GROUP BY r, term
),
df AS (SELECT term, CAST(floor(1000 * ln((2.0 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, sizes GROUP BY term),
impact AS (
  SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total)))) AS impact
  FROM tf JOIN df USING (term) JOIN kept USING (r), sizes
),
scored AS (SELECT i, item_id, r, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impact USING (term) GROUP BY ALL),
placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 50"""
ORACLE_SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
met AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, o.r, o.vec_id, a.label = o.label AS same, CAST(list_dot_product(a.e, o.e) AS BIGINT) AS score
  FROM v a JOIN v o ON o.r <> a.r WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT a, anchor_id, r, vec_id AS positive_id, score AS positive_score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS FIRST, r) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.r ORDER BY score DESC, vec_id NULLS FIRST, m.r) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN met m ON m.a = p.a AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.a, p.r ORDER BY score DESC, vec_id NULLS FIRST, m.r) <= 10"""
