"""The registered queries of this subpackage, and their SQL where SQL can say
the same.  Each applies its operator with production parameters to whole tables
and derives the contract's columns from the operator's results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    collocations,
    decontamination,
    extraction,
    jaccard,
    packing,
    quality,
    sharding,
    substrings,
    suffixes,
    token_files,
    toxicity,
    urls,
)
from .texts import Folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by the clause grammar."""
    return toxicity.toxicity(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component, shingle count and number of links of every document."""
    found = jaccard.similar_documents(_documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = f"{Folder(spark, 'tokens').root}/files"
    token_files.write_token_files(_documents(spark, sf_dir), path)
    return token_files.read_documents(spark, path)


#: Hosts whose pages stand in for a list of URLs to block.
LISTED_HOSTS = "casino|bets"


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; the list to block is made of the raw URLs of
    pages on gambling hosts."""
    pages = _table(spark, sf_dir, "pages")
    listed = pages.select("url").filter(urls.host_of(F.col("url")).rlike(LISTED_HOSTS))
    return urls.filter_urls(pages, listed)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated bytes."""
    return suffixes.repeat_digests(_documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances and verdict for every document."""
    return quality.judge(_documents(spark, sf_dir))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits and contamination of every document."""
    hits = decontamination.find_hits(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return decontamination.judged(hits).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.place(_documents(spark, sf_dir).select("doc_id")).select("doc_id", "slot", "shard")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated word windows."""
    return substrings.repeat_digests(_documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return packing.piece_digests(packing.pack(_documents(spark, sf_dir)))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned tokens of two vocabularies for all documents, with the scores
    that the corpus-wide pair counts give them."""
    return alignment.align(_documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations.collocations(_documents(spark, sf_dir))


def op13_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extraction.extract(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_ngram_jaccard,
        op3_token_files,
        op4_url_filters,
        op5_suffix_dedup,
        op6_quality_rules,
        op7_decontamination,
        op8_sharding,
        op9_substring_dedup,
        op10_packing,
        op11_alignment,
        op12_collocations,
        op13_extraction,
    )
}

_OP4 = r"""
WITH parts AS (
  SELECT page_id, strpos(url, '://') > 0 AS absolute,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(rest, '^[^#]*') AS page FROM parts),
queried AS (
  SELECT *, list_sort(list_filter(string_split(CASE WHEN strpos(page, '?') > 0 THEN substr(page, strpos(page, '?') + 1) ELSE '' END, '&'),
    lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params FROM split),
named AS (
  SELECT page_id, host, path,
    CASE WHEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') <> '' THEN
      regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') ||
      CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM queried),
listed AS (SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, 'casino|bets') AND canonical IS NOT NULL)
SELECT n.page_id, n.host, n.path, n.rule,
  CASE WHEN n.rule IN ('net/', 'example.com/de/') THEN 'block' WHEN n.rule IS NOT NULL THEN 'allow'
       WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  n.canonical, n.rule IS NULL AND l.canonical IS NOT NULL AS listed
FROM named n LEFT JOIN listed l ON n.canonical = l.canonical
"""

_OP8 = f"""
WITH slots AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {sharding.SLOTS})::INTEGER AS slot
  FROM documents)
SELECT doc_id, slot, list_extract({list(sharding.SHARDS)!r},
  list_extract({sharding.fill_table(sharding.SHARDS, sharding.SLOTS)!r}, slot + 1) + 1) AS shard
FROM slots
"""

_OP12 = r"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM (SELECT lang, unnest(pieces) AS piece FROM lowered)),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, k FROM placed, (VALUES (1), (2), (3), (4)) sizes(k)
  WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, phrase, k AS size, count(*) AS f FROM grams GROUP BY lang, phrase, k HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM worded GROUP BY lang),
split AS (SELECT lang, phrase, string_split(phrase, ' ') AS words, size, f AS a FROM f WHERE size > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM split)),
valued AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r,
         ((2000000::HUGEINT * c.a) // (h.f::HUGEINT + t.f))::BIGINT AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail),
chosen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM valued) WHERE nth = 1),
held AS (
  SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM split WHERE size > 2))
  GROUP BY 1, 2),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, encode(c.phrase)) AS rank
  FROM chosen c LEFT JOIN held h ON h.lang = c.lang AND h.phrase = c.phrase
  WHERE h.longer IS NULL OR 100::HUGEINT * h.longer < 80::HUGEINT * c.a)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""

ORACLE_SQL = {"op4_url_filters": _OP4, "op8_sharding": _OP8, "op12_collocations": _OP12}
