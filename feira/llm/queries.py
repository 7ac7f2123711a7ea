"""The operators applied to whole tables, by query name, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import (
    byte_bpe, cotraining, fm_decontam, group_matrix_join, histogram_shards, language_id, residue_negatives, run_length_dedup,
    spelling_variants, training_order, url_lists, voronoi_knn, warc_chain)
from feira.llm.shared import table
from feira.session import tune

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        _QUERIES[name] = lambda spark, folder: fn(tune(spark), folder)
        if sql:
            _SQL[name] = sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("op1_warc_chain", """
WITH named AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
held AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS holder FROM named)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN holder END AS refers_to
FROM held""")
def op1(spark, folder):
    return warc_chain.archive_and_read(table(spark, folder, "pages"))


@query("op2_url_lists", r"""
WITH pages_hosts AS (
    SELECT page_id, url, lower(rtrim(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), ''), '.')) AS host,
           DATE '2020-01-01' + CAST(page_id * 37 % 730 AS INTEGER) AS day, DATE '2020-01-01' + CAST(page_id * 53 % 730 AS INTEGER) AS listed,
           length(url) AS size FROM pages),
entries AS (
    SELECT CASE WHEN size % 2 = 0 THEN 'block' ELSE 'allow' END AS list,
           CASE WHEN size % 7 = 0 THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE host END AS domain,
           CASE WHEN size % 3 = 0 THEN 'remove' ELSE 'add' END AS action, listed AS day FROM pages_hosts WHERE host <> ''),
pairs AS (SELECT DISTINCT host, day FROM pages_hosts WHERE host <> ''),
states AS (
    SELECT p.host, p.day, e.list, e.domain, e.day AS since, max(e.action) AS action
    FROM pairs p JOIN entries e ON e.day <= p.day AND (p.host = e.domain OR ends_with(p.host, '.' || e.domain)) GROUP BY ALL),
latest AS (
    SELECT *, row_number() OVER (PARTITION BY host, day, list, domain ORDER BY since DESC) AS n,
           max(CASE WHEN action = 'remove' THEN since END) OVER (PARTITION BY host, day, list, domain) AS removed FROM states),
held AS (
    SELECT l.host, l.day, l.list, l.domain, min(s.since) AS since FROM latest l
    JOIN states s ON s.host = l.host AND s.day = l.day AND s.list = l.list AND s.domain = l.domain AND s.action = 'add'
     AND (l.removed IS NULL OR s.since > l.removed)
    WHERE l.n = 1 AND l.action = 'add' GROUP BY ALL),
ranked AS (
    SELECT *, count(*) OVER (PARTITION BY host, day) AS n_active,
           row_number() OVER (PARTITION BY host, day ORDER BY length(domain) DESC, list) AS n FROM held)
SELECT p.page_id, p.url, p.day, p.host, coalesce(r.n_active, 0) AS n_active, coalesce(r.list, 'none') AS verdict,
       r.domain AS decided_by, r.since AS listed_since
FROM pages_hosts p LEFT JOIN ranked r ON r.host = p.host AND r.day = p.day AND r.n = 1""".replace("\\\\", "\\"))
def op2(spark, folder):
    return url_lists.judge(*url_lists.captures_and_entries(table(spark, folder, "pages")))


@query("op3_voronoi_knn", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i])) AS BIGINT) AS score
    FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""")
def op3(spark, folder):
    return voronoi_knn.nearest(table(spark, folder, "embeddings"), every=50)


@query("op4_language_id")
def op4(spark, folder):
    return language_id.languages(table(spark, folder, "documents"))


@query("op5_cotraining")
def op5(spark, folder):
    return cotraining.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_training_order")
def op6(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return training_order.in_training_order(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query("op7_byte_bpe")
def op7(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query("op8_fm_decontam", r"""
WITH docs AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words, row_number() OVER () AS n FROM documents),
items AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
phrases AS (
    SELECT DISTINCT item_id, words[i:i + 9] AS phrase, least(10, len(words)) AS size
    FROM items, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS t(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM phrases),
hits AS (
    SELECT d.n, d.doc_id, d.i, p.size, p.item_id
    FROM (SELECT n, doc_id, i, size, words[i:i + size - 1] AS phrase FROM docs, sizes, unnest(range(1, len(words) - size + 2)) AS t(i)) d
    JOIN phrases p ON p.phrase = d.phrase AND p.size = d.size),
covered AS (SELECT n, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT n, i, size FROM hits), unnest(range(0, size)) AS t(k) GROUP BY n),
named AS (
    SELECT n, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT DISTINCT n, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY n)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (n) LEFT JOIN named USING (n)""")
def op8(spark, folder):
    return fm_decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_group_matrix_join", r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, w[i:i + 4] AS shingle FROM words, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
    GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
reached AS (SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.least, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) r USING (doc_id)""")
def op9(spark, folder):
    return group_matrix_join.join_components(table(spark, folder, "documents"))


@query("op10_run_length_dedup")
def op10(spark, folder):
    return run_length_dedup.kept_digests(table(spark, folder, "documents"))


@query("op11_residue_negatives", """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
           CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * d.v[i])) AS BIGINT) AS score
    FROM v a JOIN v d ON a.vec_id <> d.vec_id AND len(a.v) = len(d.v) WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""")
def op11(spark, folder):
    number, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(number % 7 == 0, (label + 1) % 10).otherwise(label)
    return residue_negatives.mine(table(spark, folder, "embeddings").withColumn("label", moved), every=100)


@query("op13_spelling_variants")
def op13(spark, folder):
    return spelling_variants.variants(spelling_variants.count_words(table(spark, folder, "documents"), damaged_every=97))


@query("op12_histogram_shards")
def op12(spark, folder):
    return histogram_shards.shard_documents(table(spark, folder, "documents"))
