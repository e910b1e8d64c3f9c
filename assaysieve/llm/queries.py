"""The registered queries of the text operators, and the SQL they are checked against where SQL can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaysieve.llm import bpe, decontaminate, extraction, hard_negatives, languages, licences, quality, repeats, rules, secrets, simhash, vector_links, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def register(job):
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


REPEATS_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)),
least AS (SELECT g, min(doc_id) AS f FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM windows JOIN least USING (g) WHERE f < doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

DECONTAMINATION_SQL = r"""
WITH i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM (SELECT item_id, w, least(10, len(w)) AS n FROM i WHERE len(w) > 0))),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM item_windows))),
found AS (SELECT doc_id, item_id, p, n FROM places JOIN item_windows USING (n, g)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

NEAR_VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
         coalesce(label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
                  AND len(list_filter(embedding, lambda c: c <> 0)) > 0, false) AS usable FROM embeddings),
links AS MATERIALIZED (
  SELECT p.r AS a, q.r AS b, q.vec_id FROM v AS p JOIN v AS q ON p.label = q.label AND len(p.x) = len(q.x) AND p.r <> q.r
  WHERE p.usable AND q.usable AND list_cosine_similarity(p.x, q.x) >= 0.93),
reach(a, b) AS (
  SELECT r, r FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.b = v.r GROUP BY reach.a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN least ON v.r = least.a LEFT JOIN n ON v.r = n.a"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor(256 * c)) AS x
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
pairs AS MATERIALIZED (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS turn
  FROM pairs WHERE same QUALIFY turn <= 5),
negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor, turn ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN pairs USING (anchor, anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
  QUALIFY rank <= 10)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives"""


@query("op1_substring_dedup", REPEATS_SQL)
def substring_dedup(spark, folder):
    return repeats.digest(table(spark, folder, "documents"))


@query("op2_html_extraction")
def html_extraction(spark, folder):
    return extraction.digest(table(spark, folder, "pages"))


@query("op3_secret_scan")
def secret_scan(spark, folder):
    return secrets.digest(table(spark, folder, "documents"))


@query("op4_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark, folder):
    return decontaminate.digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_quality_rules")
def quality_rules(spark, folder):
    return rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_simhash")
def near_duplicates(spark, folder):
    return simhash.digest(table(spark, folder, "documents"))


@query("op7_quality_classifier")
def quality_classifier(spark, folder):
    return quality.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_bpe")
def byte_pair_tokens(spark, folder):
    return bpe.digest(table(spark, folder, "documents"), VOCABULARY)


@query("op9_licence_scan")
def licence_scan(spark, folder):
    return licences.digest(table(spark, folder, "documents"))


@query("op10_language_id")
def language_id(spark, folder):
    return languages.digest(table(spark, folder, "documents"), table(spark, folder, "pages"))


@query("op11_vector_links", NEAR_VECTORS_SQL)
def near_vectors(spark, folder):
    return vector_links.near_copies(table(spark, folder, "embeddings"))


@query("op12_whitening")
def whitened_vectors(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@query("op13_hard_negatives", HARD_NEGATIVES_SQL)
def mined_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings")
    turned = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(turned, F.col("vec_id") % 100 == 0)
