"""The registered query of every operator, with production parameters, and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweb.llm import byte_bpe, html_extraction, line_dedup, quality_rules, secret_scan, simhash_dedup, source_mixing, substring_dedup, url_filters, vector_search


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(quality_rules.ledger(_table(spark, sf_dir, "documents")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digest(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(_table(spark, sf_dir, "pages"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_source_mixing": op4_source_mixing,
    "op5_url_filters": op5_url_filters,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash": op9_simhash,
    "op10_vector_search": op10_vector_search,
}

ORACLES: dict[str, str] = {
    "op1_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), h AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g
), p AS (
  SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM h WHERE c > 1) GROUP BY r
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_bangs,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN p USING (r)
), b AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 2 * n_bangs > n_words THEN 8 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END) + (CASE WHEN word_chars > 20 * n_words THEN 64 ELSE 0 END) AS BIGINT) AS failed_bits
  FROM m
)
SELECT *, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept FROM b""",
    "op4_source_mixing": r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 1 ELSE 0 END AS s0, coalesce(source, '') AS s1, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT s0, s1, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY s0, s1) - 1 AS k FROM d GROUP BY s0, s1
), w AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, CAST(sum(n) OVER () AS BIGINT) AS total FROM s
), r AS (  -- a prefix by size for weight is capped
  SELECT *, row_number() OVER o AS i, coalesce(sum(n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w FROM w WINDOW o AS (ORDER BY CAST(n AS DOUBLE) / w, k)
), c AS (
  SELECT *, CAST(3 * total - 4 * before AS DOUBLE) / CAST(2 * left_w AS DOUBLE) AS level FROM r
), f AS (
  SELECT arg_min(level, i) AS level, min(i) AS i FROM c WHERE w * level <= 2 * n
), t AS (
  SELECT c.*, CASE WHEN c.i < coalesce(f.i, 1 << 40) THEN 2.0 * n ELSE w * f.level END::DOUBLE AS target FROM c, f
), b AS (
  SELECT greatest(1, least(256, CAST(floor(floor(coalesce(min(target) FILTER (target > 0), 1)) / 400) AS BIGINT))) AS block, sum(target) AS goal FROM t
), q AS (
  SELECT k, target / (2 * unnest(range((2 * CAST(ceil(n / block) AS BIGINT)))) + 1) AS q FROM t, b WHERE target > 0
), seats AS (
  SELECT k, count(*) AS seats FROM (SELECT k FROM q QUALIFY row_number() OVER (ORDER BY q DESC, k) <= (SELECT CAST(floor(goal / block + 0.5) AS BIGINT) FROM b)) GROUP BY k
), p AS (
  SELECT doc_id, size, t.k, t.n AS source_size, t.target, md5('17:' || doc_id) AS o, CAST('0x' || md5('17:' || doc_id)[:8] AS BIGINT) % greatest(1, CAST(ceil(t.n / greatest(200000, ceil(t.total / 4096))) AS BIGINT)) AS shard
  FROM d JOIN t USING (s0, s1)
), l AS (
  SELECT k, shard, CAST(sum(size) AS BIGINT) AS n FROM p GROUP BY k, shard
), lq AS (
  SELECT k, shard, n / (2 * unnest(range((2 * CAST(ceil(n / block) AS BIGINT)))) + 1) AS q FROM l, b
), ls AS (
  SELECT k, shard, count(*) AS quota FROM (SELECT k, shard, row_number() OVER (PARTITION BY k ORDER BY q DESC, shard) AS i FROM lq) JOIN seats USING (k) WHERE i <= seats GROUP BY k, shard
), u AS (
  SELECT l.k, l.shard, n, block, greatest(1, CAST(ceil(n / block) AS BIGINT)) AS blocks, coalesce(quota, 0) AS quota FROM l CROSS JOIN b LEFT JOIN ls USING (k, shard)
), v AS (
  SELECT *, CAST('0x' || md5('17:' || k || ':' || shard)[:8] AS BIGINT) % blocks AS first, quota // blocks AS passes, quota % blocks AS run FROM u
), x AS (
  SELECT k, shard, passes, first * block AS a, least(n, (first + run) * block) AS z, greatest(0, first + run - blocks) * block AS wrapped FROM v
), e AS (
  SELECT p.*, CAST(sum(size) OVER (PARTITION BY k, shard ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM p
)
SELECT doc_id, size, source_size, target, CAST(passes * size + greatest(0, least(size, wrapped - (e - size))) + greatest(greatest(0, least(size, a - (e - size))), greatest(0, least(size, z - (e - size)))) - greatest(0, least(size, a - (e - size))) AS BIGINT) AS taken
FROM e JOIN x USING (k, shard)""",
    "op5_url_filters": r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3:] ELSE '' END AS r FROM pages
), h AS (
  SELECT page_id, url, html, translate(regexp_extract(coalesce(r, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(r, ''), '^[^/?#]*([^#]*)', 1) AS rest FROM p
), rules(verdict, rule) AS (
  VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')
), f AS (
  SELECT h.host, h.path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM h) h JOIN rules ON (h.host = split_part(rule, '/', 1) OR ends_with(h.host, '.' || split_part(rule, '/', 1))) AND starts_with(h.path, rule[strpos(rule, '/'):])
  GROUP BY h.host, h.path
), n AS (
  SELECT DISTINCT host || rest AS node, verdict FROM h LEFT JOIN f USING (host, path) WHERE host <> ''
), edges AS (
  SELECT host || rest AS a, regexp_replace(regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?[^"''>\s]*?://([^"''>\s#]*)', 1), '&amp;', '&') AS b FROM h WHERE html ILIKE '%canonical%'
), both_ways AS (
  SELECT a, b FROM edges WHERE b <> '' UNION SELECT b, a FROM edges WHERE b <> ''
), reach AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), v AS (
  SELECT a AS node, bool_or(verdict = 'allow') AS has_allow, bool_or(verdict = 'block') AS has_block FROM reach JOIN n ON n.node = b GROUP BY a
)
SELECT page_id, host, path, rule, CASE WHEN f.verdict IS NOT NULL THEN f.verdict WHEN has_block AND NOT coalesce(has_allow, false) THEN 'block' ELSE 'allow' END AS verdict
FROM h LEFT JOIN f USING (host, path) LEFT JOIN v ON v.node = host || rest""",
    # At this size the sample holds every vector, so the search is exact.
    "op10_vector_search": r"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])), lambda a, b: a + b)) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM d
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10""",
    "op2_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
  SELECT r, doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)
), m AS (
  SELECT r, i, min(doc_id) OVER (PARTITION BY k) < doc_id AS repeated FROM w
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM m WHERE repeated
), kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM (SELECT r, p, ws[p] AS w FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p)) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)""",
}
