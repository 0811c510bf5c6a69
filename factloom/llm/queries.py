"""The thin queries of the training-data operators, one for each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fingerprints, language, neardup, quality, records, shards, toxicity, urlfilter
from .common import table


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).select("doc_id", "held_out", "score", "predicted")


def op2_minmax_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, k=3, percent=85)


def op3_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op4_language_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language.train(docs)
    return language.identify(docs.select("doc_id", "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def op5_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model).select("doc_id", "held_out", "score", "predicted")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_decode(docs, path, public_tokenizers.PATTERN))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), records.new_folder(spark)
    records.write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return records.read(spark, folder).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    data = F.coalesce("text", F.lit("")).cast("binary")
    return shards.shuffle_into(docs, 16).select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The list history that op10 evaluates (kind, value, action, day, change).
URL_LIST = [
    ("domain", "spam-farm.example.org", "block", "2023-02-01", "add"),
    ("domain", "spam-farm.example.org", "block", "2023-09-01", "remove"),
    ("domain", "spam-farm.example.org", "block", "2024-03-01", "add"),
    ("domain", "free-bets.example.net", "block", "2023-01-15", "add"),
    ("domain", "casino-win.example.net", "block", "2023-01-01", "add"),
    ("host", "blog.casino-win.example.net", "allow", "2023-06-01", "add"),
    ("host", "blog.casino-win.example.net", "allow", "2023-08-01", "remove"),
    ("host", "adult-x.example.com", "block", "2023-01-01", "add"),
    ("prefix", "adult-x.example.com/en", "allow", "2024-01-01", "add"),
    ("domain", "cheap-pills.example.com", "block", "2023-04-01", "add"),
    ("domain", "cheap-pills.example.com", "allow", "2024-06-01", "add"),
    ("domain", "example.org", "allow", "2023-01-01", "add"),
    ("prefix", "tionsh.example.net/de", "block", "2023-05-01", "add"),
    ("prefix", "tionsh.example.net/de", "block", "2023-05-31", "remove"),
    ("domain", "tionsh.example.net", "allow", "2023-05-10", "add"),
    ("host", "m.ththan.example.net", "block", "2023-03-01", "add"),
    ("host", "m.ththan.example.net", "block", "2023-03-01", "remove"),
]


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no fetch time, so a day in 2023 or 2024 is derived from the id."""
    rows = [(*row, i) for i, row in enumerate(URL_LIST)]
    entries = spark.createDataFrame(rows, "kind string, value string, action string, day string, change string, seq int")
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(731)).cast("int"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched"))
    return urlfilter.evaluate(pages, entries).withColumns(
        {c: F.col(c).cast("string") for c in ("fetched", "entry_since")}
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_minmax_neardup": op2_minmax_neardup,
    "op3_iblt_fingerprints": op3_iblt_fingerprints,
    "op4_language_ranks": op4_language_ranks,
    "op5_template_leaks": op5_template_leaks,
    "op6_toxicity_fm": op6_toxicity_fm,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_records": op8_token_records,
    "op9_hypergeometric_shards": op9_hypergeometric_shards,
    "op10_url_lists": op10_url_lists,
}
_LIST_SQL = ", ".join(f"({i}, {', '.join(repr(x) for x in row)})" for i, row in enumerate(URL_LIST))
SQL: dict[str, str] = {
    "op10_url_lists": rf"""
WITH list(seq, kind, value, action, day, change) AS (VALUES {_LIST_SQL}),
last AS (
  SELECT kind, value, action, change, CAST(day AS DATE) AS since FROM list l
  WHERE seq = (SELECT max(seq) FROM list m WHERE m.kind = l.kind AND m.value = l.value AND m.day = l.day)),
valid AS (
  SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY kind, value ORDER BY since) AS until FROM last)
  WHERE change = 'add'),
cap AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) AS host,
    trim(lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)), '/') AS path,
    DATE '2023-01-01' + CAST((page_id * 37) % 731 AS INTEGER) AS fetched
  FROM pages),
met AS (
  SELECT c.page_id, c.host, c.fetched, v.kind, v.value, v.since, v.action,
    row_number() OVER (PARTITION BY c.page_id ORDER BY
      CASE v.kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(v.value) DESC) AS place,
    count(v.value) OVER (PARTITION BY c.page_id) AS active
  FROM cap c LEFT JOIN valid v ON c.fetched >= v.since AND (v.until IS NULL OR c.fetched < v.until) AND (
    (v.kind = 'host' AND c.host = v.value)
    OR (v.kind = 'domain' AND (c.host = v.value OR ends_with(c.host, '.' || v.value)))
    OR (v.kind = 'prefix' AND starts_with(c.host || '/' || c.path || '/', v.value || '/'))))
SELECT page_id, host, CAST(fetched AS VARCHAR) AS fetched, active, kind AS entry_kind, value AS entry_value,
  CAST(since AS VARCHAR) AS entry_since, coalesce(action, 'none') AS verdict, coalesce(action <> 'block', TRUE) AS kept
FROM met WHERE place = 1
""",
    "op2_minmax_neardup": r"""
WITH RECURSIVE seq AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM seq),
one AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id,
  least(s.doc_id, coalesce(min(r.b), s.doc_id)) = s.doc_id AS kept
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
""",
}
