"""The package's registered queries and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (bpe, collision_ann, hard_negatives, packing, periodic_runs, quality_gam, simhash,
                          substring_dedup, token_files, toxicity_knn, url_filter, vafile, vectors, weighted_minhash)
from tickloom.llm.common import text_crc_mod
from tickloom.session import scratch_path
from tickloom.sources.tables import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: (host, path prefix, action) of the registered URL query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def every_twentieth(vec_id):
    return vec_id % 20 == 0


def op1_va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(vafile.scaled(table(spark, sf_dir, "embeddings")), every_twentieth, k=20)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.search(table(spark, sf_dir, "embeddings"), every_twentieth, k=20)


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = text_crc_mod(F.col("doc_id"), 3)
    model = quality_gam.learn(docs, table(spark, sf_dir, "labels"), part != 1)
    return quality_gam.with_quality(docs, model).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = text_crc_mod(F.col("doc_id"), 5)
    model = toxicity_knn.learn(docs, table(spark, sf_dir, "labels"), part != 0)
    return toxicity_knn.with_toxicity(docs, model, keep=["doc_id"]).select(
        "doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"token_files/{uuid.uuid4().hex}")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"),
                             "<|endoftext|>", end_id=2, remembered=800_000)
    return token_files.with_crc(token_files.read_tokens(spark, path))


def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"),
                                             tokenizer_file("byte_bpe_50k.json"), "<|endoftext|>",
                                             remembered=800_000))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the query's periodic tails: by crc32 of the
    doc_id a tenth of the documents repeat p words from word a on."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(F.col("h") / 10)
    n = F.size("words")
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    cut = docs.withColumn("h", h).withColumn("words", words)
    cut = cut.withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + g % 8))))
    place = F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
    tail = F.array_join(F.transform(place, lambda i: F.get("words", F.when(
        i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))), " ")
    return cut.select("doc_id", F.when(F.col("p").isNotNull(), tail).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return periodic_runs.with_runs(docs, keep=["doc_id"]).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    known = e.filter(vectors.finite(F.col("embedding"))).select(
        "vec_id", label.alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vec"))
    return hard_negatives.mine(known, lambda vec_id: vec_id % 100 == 0)


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_va_file_top_k": op1_va_file_top_k,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filter": op3_url_filter,
    "op5_token_files": op5_token_files,
    "op4_quality_gam": op4_quality_gam,
    "op7_toxicity_knn": op7_toxicity_knn,
    "op6_collision_ann": op6_collision_ann,
    "op8_weighted_minhash": op8_weighted_minhash,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash_dedup": op13_simhash_dedup,
}

OP1_SQL = """
WITH v AS (
  SELECT vec_id, max([floor(64 * x::DOUBLE) FOR x IN embedding]) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 19], ' ')) AS key FROM s),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) AS nth FROM k),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS place FROM r WHERE nth > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
left_over AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

OP3_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*(\??[^#]*)', 1), '') AS query
  FROM pages),
shown AS (
  SELECT host, path, query, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)', '', 'g'),
    '(?is)<(?:link|meta|base)\b(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS tags FROM p WHERE host <> ''),
tagged AS (
  SELECT host, path, query, tags, unnest(tags) AS tag,
    [t FOR t IN tags IF regexp_matches(t, '(?i)^<base\b.*\bhref')][1] AS base FROM shown),
parts AS (
  SELECT host, path, query, tag, base, [lower(x) FOR x IN regexp_extract_all(body, att, 1)] AS names,
    regexp_extract_all(body, att, 2) AS v2, regexp_extract_all(body, att, 3) AS v3, regexp_extract_all(body, att, 4) AS v4,
    [lower(x) FOR x IN regexp_extract_all(base_body, att, 1)] AS b_names,
    regexp_extract_all(base_body, att, 2) AS b2, regexp_extract_all(base_body, att, 3) AS b3, regexp_extract_all(base_body, att, 4) AS b4
  FROM (SELECT *, regexp_replace(tag, '(?i)^<[a-z]+', '') AS body, regexp_replace(base, '(?i)^<[a-z]+', '') AS base_body,
    '(?s)([^\s"''<>/=]+)(?:\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>][^\s>]*)))?' AS att FROM tagged)),
valued AS (
  SELECT host, path, query, tag, names,
    [concat(v2[i], v3[i], v4[i]) FOR i IN range(1, len(names) + 1)] AS vals,
    concat(b2[list_position(b_names, 'href')], b3[list_position(b_names, 'href')], b4[list_position(b_names, 'href')]) AS base
  FROM parts),
said AS (
  SELECT host, path, query, base, lower(coalesce(vals[list_position(names, 'rel')], '')) AS rel,
    trim(lower(coalesce(vals[list_position(names, 'http-equiv')], ''))) AS equiv, coalesce(vals[list_position(names, 'href')], '') AS href,
    coalesce(vals[list_position(names, 'content')], '') AS content, coalesce(vals[list_position(names, 'url')], '') AS bare,
    regexp_matches(tag, '(?i)^<link') AS is_link, regexp_matches(tag, '(?i)^<meta') AS is_meta FROM valued),
links AS (
  SELECT host, path, query, host || path || query AS a, base,
    trim(regexp_replace(CASE
      WHEN is_link AND list_contains(regexp_split_to_array(rel, '\s+'), 'canonical') THEN href
      WHEN is_meta AND equiv = 'refresh' THEN coalesce(nullif(concat(regexp_extract(content, re, 1), regexp_extract(content, re, 2),
        regexp_extract(content, re, 3)), ''), bare) END, '(?i)&(?:amp|#0*38|#x0*26);', '&', 'g')) AS link,
    trim(regexp_replace(base, '(?i)&(?:amp|#0*38|#x0*26);', '&', 'g')) AS base_link
  FROM (SELECT *, '(?is)\burl\s*=\s*(?:"\s*([^"]*?)\s*(?:"|$)|''\s*([^'']*?)\s*(?:''|$)|([^\s"''].*?)\s*$)' AS re FROM said)),
based AS (
  SELECT a, link, host, path, CASE WHEN base_link = '' THEN 'http://' || host || path WHEN contains(base_link, '://') THEN base_link
    WHEN starts_with(base_link, '//') THEN 'http:' || base_link WHEN starts_with(base_link, '/') THEN 'http://' || host || base_link
    ELSE 'http://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || base_link END AS seen FROM links WHERE link <> ''),
origins AS (
  SELECT a, link, translate(regexp_extract(seen, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(seen, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM based),
targets AS (
  SELECT a, CASE WHEN contains(link, '://') THEN link
    WHEN starts_with(link, '//') THEN 'http:' || link
    WHEN starts_with(link, '/') THEN 'http://' || host || link
    ELSE 'http://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || link END AS t
  FROM origins),
edges AS (
  SELECT a, translate(regexp_extract(t, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(t, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b FROM targets),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (
  SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
nodes AS (
  SELECT DISTINCT b, regexp_extract(b, '(?s)^([^/?]*)', 1) AS host, regexp_extract(b, '(?s)^[^/?]*([^?]*)', 1) AS path
  FROM reach),
ruled AS (
  SELECT b, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'allow'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'block'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'allow'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'block' END AS v FROM nodes),
passed AS (
  SELECT r.a AS key, CASE WHEN bool_or(v = 'allow') THEN 'allow' WHEN bool_or(v = 'block') THEN 'block' END AS v
  FROM reach r JOIN ruled n ON r.b = n.b GROUP BY r.a),
own AS (
  SELECT page_id, host, path, host || path || query AS key, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, coalesce(
    CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
      WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' END,
    passed.v, 'allow') AS verdict
FROM own LEFT JOIN passed ON own.key = passed.key
"""

OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.vec, c.vec)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
  AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE_SQL = {"op1_va_file_top_k": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op3_url_filter": OP3_SQL,
              "op12_hard_negatives": OP12_SQL}
