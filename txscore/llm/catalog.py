"""Registered queries of the corpus operators: each applies one operator, with
production parameters, to its whole table and returns its whole result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.llm import (bk_simhash, divergence, harmonic, html_text, line_dedup, piece_tokens, prefix_hash,
                         repeats, rp_forest, spelling, token_counts, toxicity, url_filter)
from txscore.llm.common import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Host, path and verdict of the rules of ``op3_url_filter``.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical addresses that several URLs of the crawl claim, so that none can be
    trusted to be the page itself."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = (url_filter.addresses(pages).where("address <> ''").groupBy("address").count()
              .where("count > 1").select("address"))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = """
WITH cut AS (SELECT *, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END
                    AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) AS query FROM cut),
addresses AS (
  SELECT *, list_sort(list_filter(string_split(query, '&'), lambda x: x <> ''
         AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid|ref)(=|$)'))) AS params FROM parts),
places AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE regexp_replace(host, ':(80|443)?$', '') || rtrim(path, '/')
         || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS address
  FROM addresses),
listed AS (SELECT address FROM places WHERE address <> '' GROUP BY address HAVING count(DISTINCT url) > 1),
rules(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT url, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM (SELECT DISTINCT url, host, path FROM places) p, rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY url)
SELECT page_id, host, path, f.rule, coalesce(f.verdict, CASE WHEN l.address IS NULL THEN 'allow'
       ELSE 'block' END) AS verdict
FROM places LEFT JOIN fits f USING (url) LEFT JOIN listed l USING (address)
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = piece_tokens.tokenize(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
                      .alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_harmonic_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = harmonic.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                      "doc_tokens", "sequence_id", "offset", "class")


def op7_bk_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk_simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prefix_hash.compare_with_next(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                      "edited_fingerprint", "near_edited", "near_next", "common_prefix")


#: Words of the shortest line that ``op9_line_dedup`` compares (also in its SQL).
LINE_WORDS = 10


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeats(table(spark, sf_dir, "documents"), min_words=LINE_WORDS)
    spans = F.transform("removed", lambda s: F.concat_ws("-", s.start, s.end))
    return out.select("doc_id", F.col("n_units").alias("n_lines"),
                      F.size("removed").cast("long").alias("n_removed"),
                      F.array_join(spans, ",").alias("removed_spans"), "text")


OP9_SQL = """
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM cut),
placed AS (
  SELECT doc_id, line, i, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g'), ' ') AS norm
  FROM lines),
ranked AS (
  SELECT *, norm <> '' AND len(string_split(norm, ' ')) >= 10 AND row_number() OVER (PARTITION BY md5(norm) ORDER BY doc_id, start) > 1
            AS gone
  FROM placed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(start || '-' || (start + length(line)), ',' ORDER BY i)
                FILTER (gone), '') AS removed_spans,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM ranked GROUP BY doc_id
"""


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term)
           GROUP BY ALL),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(c.size, 0) AS size
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM counts GROUP BY ALL) c USING (lang, source)),
langs AS (SELECT lang, any_value(v) AS v, sum(size) AS size FROM groups GROUP BY lang),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.size + g.v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
whole AS (
  SELECT c.lang, c.term, 1 + (1000000000::HUGEINT * (sum(c.n) + 1)) // any_value(l.size + l.v) AS q
  FROM counts c JOIN langs l USING (lang) GROUP BY c.lang, c.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
leads AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE s.n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part
                               ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM leads))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_rp_forest, op3_url_filter, op4_toxicity, op5_piece_tokens, op6_harmonic_pack, op7_bk_simhash, op8_prefix_hash,
    op9_line_dedup, op10_repeats, op11_spelling, op12_divergence, op13_token_counts)}
ORACLES: dict[str, str] = {"op3_url_filter": OP3_SQL, "op9_line_dedup": OP9_SQL, "op12_divergence": OP12_SQL}
