"""Registered queries of the corpus operators, with DuckDB text where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, hard_negatives, licenses, lm_score, mixing, periodic, pieces, secrets, simhash, substring_dedup, toxicity, warc_revisit
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark, sf_dir):
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


@query
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


ORACLE["op5_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST) AS r,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d),
best AS (SELECT norm, doc_id AS keep_id FROM ranked WHERE r = 1)
SELECT ranked.doc_id, best.keep_id, ranked.group_size, ranked.doc_id IS NOT DISTINCT FROM best.keep_id AS kept,
       sha256(ranked.norm) AS text_sha256
FROM ranked JOIN best ON ranked.norm = best.norm
"""


@query
def op3_simhash(spark, sf_dir):
    return simhash.components_of(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_lm_score(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.changed(table(spark, sf_dir, "documents"))


@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def page_captures(pages):
    """A capture log over the pages: every page is a full response, one in five is then missing for a
    moment (404), one in eleven has a record without a status; a page whose id is no multiple of three is
    asked for again later under another spelling of its URL and answered with a 304, every seventh of
    them with another entity tag.  Two neighbouring pages share the id and the instant of their 304s, and a
    404 has the id of its page's response."""
    n = F.col("page_id")
    m = n - n % 2
    again = 10 * m + 10 * (1 + m % 50) + 5
    none = F.create_map().cast("map<string,string>")
    # ids follow each other in time, a repeat comes when the next pages have been fetched
    response = pages.select(
        (2 * n).alias("record_id"), "url", (10 * n).alias("captured_at"), F.lit(200).alias("status"),
        F.create_map(F.lit("ETag"), F.md5("html"), F.lit("Content-Length"), F.length("html").cast("string"), F.lit("Date"), (10 * n).cast("string"),
                     F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"))
    missing = pages.filter(n % 5 == 0).select((2 * n).alias("record_id"), "url", (10 * n + 3).alias("captured_at"), F.lit(404).alias("status"), F.create_map(F.lit("ETag"), F.lit("gone")).alias("headers"))
    unknown = pages.filter(n % 11 == 0).select((2 * n).alias("record_id"), "url", (10 * n + 4).alias("captured_at"), F.lit(None).cast("int").alias("status"), none.alias("headers"))
    revisit = pages.filter(n % 3 != 0).select(
        (2 * m + 1).alias("record_id"), F.concat(F.col("url"), F.lit("#again")).alias("url"), again.alias("captured_at"), F.lit(304).alias("status"),
        F.create_map(F.lit("etag"), F.when(n % 7 == 0, F.lit("other")).otherwise(F.md5("html")), F.lit("content-length"), F.lit("0"), F.lit("set-cookie"), F.lit("a=b"),
                     F.lit("date"), again.cast("string")).alias("headers"))
    return response.unionByName(missing).unionByName(unknown).unionByName(revisit)


@query
def op7_warc_revisit(spark, sf_dir):
    found = warc_revisit.resolve(page_captures(table(spark, sf_dir, "pages")))
    return found.select("record_id", "canonical_url", "response_id", "outcome",
                        F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";").alias("headers"))


ORACLE["op7_warc_revisit"] = r"""
WITH u AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages),
c AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '') ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(u, '^[^/?]*(.*)$', 1),
      '([?&])(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '\1', 'g'), '&+', '&', 'g'), '\?&', '?', 'g'), '[?&]+$', ''), '/+$', '') AS canon
  FROM u),
r AS (
  SELECT 2 * m + 1 AS record_id, canon, 10 * m + 10 * (1 + m % 50) + 5 AS t,
         CASE WHEN page_id % 7 = 0 THEN 'other' ELSE md5(html) END AS etag
  FROM (SELECT *, page_id - page_id % 2 AS m FROM c) WHERE page_id % 3 <> 0),
f AS (SELECT 2 * page_id AS response_id, canon, 10 * page_id AS t, md5(html) AS etag, length(html) AS n FROM c),
m AS (SELECT r.*, f.response_id AS stored, f.etag AS stored_etag, f.n FROM r ASOF LEFT JOIN f ON r.canon = f.canon AND r.t > f.t)
SELECT record_id, canon AS canonical_url, CASE WHEN etag = stored_etag THEN stored END AS response_id,
       CASE WHEN stored IS NULL THEN 'missing' WHEN etag = stored_etag THEN 'resolved' ELSE 'changed' END AS outcome,
       CASE WHEN etag = stored_etag THEN 'cache-control=max-age=60;content-length=' || n || ';date=' || t || ';etag=' || etag END AS headers
FROM m
"""


@query
def op6_mixing(spark, sf_dir):
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


ORACLE["op11_hard_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def repeated_tails(docs):
    """The documents, of which every tenth (by hash) repeats a stretch of words up to its end."""
    doc_id = F.col("doc_id").cast("long")
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("words")
    a = F.pmod(F.col("g"), F.col("n"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.element_at(
        "words", (F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")) + 1).cast("int")))
    drawn = docs.select(doc_id.alias("doc_id"), "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    placed = drawn.withColumn("n", n.cast("long")).withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p)
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(repeated_tails(table(spark, sf_dir, "documents")))
    best = periodic.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op13_pieces(spark, sf_dir):
    encoded = pieces.encode(table(spark, sf_dir, "documents"))
    digests = encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"))
    return pieces.decode(digests).select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
