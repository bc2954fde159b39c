"""Queries over URLs and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweb import dims
from tallyweb.functions import contacts as ct
from tallyweb.functions import urls as u
from tallyweb.operators.dedup import first_wins, insert_counts
from tallyweb.operators.keywords import fan_out
from tallyweb.plans.registry import query, rows, sql_values, table

_LIST = ", ".join(f"'{p}'" for p in dims.TRACKING_PARAMS)
_PREFIX = "|".join(p.replace("-", r"\-") for p in dims.TRACKING_PREFIXES)
#: DuckDB's canonical form, for urls without escapes: the fixture has no others.
CANONICAL = rf"""lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || CASE WHEN regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*?)/*(?:[?#].*)?$', 1) = '' THEN '/' ELSE regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*?)/*(?:[?#].*)?$', 1) END
 || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_sort(params), '&') ELSE '' END"""
CLEANED = rf"""SELECT *, list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT list_contains([{_LIST}], split_part(p, '=', 1)) AND NOT regexp_matches(split_part(p, '=', 1), '^({_PREFIX})')) AS params FROM pages"""
PAGES = f"WITH c AS ({CLEANED}), p AS (SELECT page_id, url, html, {CANONICAL} AS canonical, lower(regexp_extract(url, '^[^:]*://([^/:?#]*)', 1)) AS domain FROM c)"


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", u.canonical_url(F.col("url")).alias("canonical"), u.domain(F.col("url")).alias("domain"))


@query(PAGES + ", f AS (SELECT domain, canonical FROM p QUALIFY row_number() OVER (PARTITION BY sha256(canonical) ORDER BY page_id) = 1) SELECT domain, count(*) AS n_urls, min(sha256(canonical)) AS least_hash FROM f GROUP BY domain ORDER BY n_urls DESC, domain LIMIT 20")
def url_canonical_domain_topk(spark, sf_dir):
    p = _pages(spark, sf_dir).withColumn("url_hash", F.sha2("canonical", 256))
    return first_wins(p, "url_hash", "page_id").groupBy("domain").agg(F.count("*").alias("n_urls"), F.min("url_hash").alias("least_hash")).orderBy(F.desc("n_urls"), "domain").limit(20)


@query(PAGES + " SELECT page_id, canonical, sha256(canonical) AS url_hash FROM p QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY page_id) = 1")
def url_hash_dedup(spark, sf_dir):
    return first_wins(_pages(spark, sf_dir).select("page_id", "canonical", F.sha2("canonical", 256).alias("url_hash")), "url_hash", "page_id")


_HOSTS = (("www.yelp.com",), ("x.edu",), ("a.gov.uk",), ("forum.a.com",), ("my.forum.a.com",), ("www.apparelsupport.com",), ("support.google.com",), ("",), ("localhost",), ("shop.example.com",), ("edu",))
_SKIP = f"""domain IN ({", ".join(f"'{h}'" for h in dims.BLOCKED_HOSTS)}) OR regexp_matches(domain, '({"|".join(s.replace(".", chr(92) + ".") for s in dims.PUBLIC_SUFFIXES)})$')
 OR regexp_matches(domain, '^({"|".join(s.replace(".", chr(92) + ".") for s in dims.FORUM_PREFIXES)})') OR regexp_matches(domain, '({"|".join(s.replace(".", chr(92) + ".") for s in dims.FORUM_INFIXES)})')"""


@query(f"{PAGES}, h AS (SELECT domain FROM p UNION ALL SELECT * FROM ({sql_values(*_HOSTS)}) v(domain)) SELECT domain, {_SKIP} AS skipped, count(*) AS n FROM h GROUP BY ALL")
def domain_skip_filter(spark, sf_dir):
    hosts = _pages(spark, sf_dir).select("domain").unionAll(rows(spark, "domain string", *_HOSTS))
    return hosts.groupBy("domain").agg(F.count("*").alias("n")).withColumn("skipped", u.skip_domain(F.col("domain")))


@query(PAGES + r" SELECT page_id, domain = 'example.com' OR ends_with(domain, '.example.com') AS in_com, domain IN ('example.org', 'example.net') OR ends_with(domain, '.example.org') OR ends_with(domain, '.example.net') AS in_others FROM p")
def suffix_domain_match(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", u.in_domains(F.col("domain"), ("example.com",)).alias("in_com"), u.in_domains(F.col("domain"), ("example.org", "example.net")).alias("in_others"))


_RESULTS = (
    ("google", "/url?q=https%3A%2F%2Fa.com%2Fx%3Fy%3D1&sa=U", "https://a.com/x?y=1"),
    ("google", "https://www.google.com/url?q=https://b.com/", "https://b.com/"),
    ("google", "https://c.com/direct", "https://c.com/direct"),
    ("google", "javascript:void(0)", ""),
    ("bing", "https://www.bing.com/ck/a?p=1&u=a1aHR0cHM6Ly9kLmNvbS9wYXRo&ntb=1", "https://d.com/path"),
    ("bing", "https://www.bing.com/ck/a?p=1&u=b1xx", ""),
    ("duckduckgo", "//duckduckgo.com/l/?kh=-1&uddg=https%3A%2F%2Fe.com%2Fa%2520b", "https://e.com/a b"),
    ("duckduckgo", "https://f.com/", "https://f.com/"),
    ("duckduckgo", "/relative", ""),
)


@query(f"SELECT engine, href, target FROM ({sql_values(*_RESULTS)}) v(engine, href, target)")
def redirect_unwrap(spark, sf_dir):
    df, href = rows(spark, "engine string, href string, _ string", *_RESULTS), F.col("href")
    return df.select("engine", "href", F.when(F.col("engine") == "google", u.google_target(href)).when(F.col("engine") == "bing", u.bing_target(href)).otherwise(u.ddg_target(href)).alias("target"))


@query(
    """WITH q AS (SELECT lower(n_name) || ' spa' AS query_text FROM nation), e AS (SELECT * FROM (VALUES ('google', 1), ('bing', 5), ('duckduckgo', 3)) v(engine, pages)), j AS (SELECT query_text, engine, unnest(range(pages)) AS page FROM q, e)
SELECT engine || '-' || query_text || '-p' || page AS job_id, query_text, engine, CAST(page AS INTEGER) AS page, CASE engine WHEN 'google' THEN 'https://www.google.com/search?q=' || replace(query_text, ' ', '+') || '&num=100&start=' || (page * 100) || '&gl=us&hl=en'
 WHEN 'bing' THEN 'https://www.bing.com/search?q=' || replace(query_text, ' ', '+') || '&first=' || (page * 10 + 1) || '&cc=us&setlang=en' ELSE 'https://html.duckduckgo.com/html/?q=' || replace(query_text, ' ', '+') || '&kl=us-en' END AS search_url FROM j"""
)
def serp_url_build(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.concat(F.lower("n_name"), F.lit(" spa")).alias("query_text"), F.lit("Nowhere").alias("country"))
    return fan_out(names)


@query(PAGES + ", d AS (SELECT DISTINCT domain FROM p) SELECT 'https://' || domain || path AS url, sha256('https://' || domain || path) AS url_hash, domain FROM d, (VALUES ('/contact'), ('/contact-us'), ('/about'), ('/about-us')) v(path)")
def contact_page_fanout(spark, sf_dir):
    hosts = _pages(spark, sf_dir).select("domain").distinct()
    return hosts.select("domain", F.explode(u.contact_pages(F.col("domain"))).alias("url")).select("url", F.sha2("url", 256).alias("url_hash"), "domain")


@query("SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", ct.page_title(F.col("html")).alias("title"))


@query("SELECT href, count(*) AS n, count(DISTINCT page_id) AS n_pages FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']+)[\"'']', 1)) AS href FROM pages) GROUP BY href")
def href_explode(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(ct.hrefs(F.col("html"))).alias("href"))
    return links.groupBy("href").agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("n_pages"))


@query("SELECT DISTINCT href, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://www.example.com' || href END AS url FROM (SELECT unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']+)[\"'']', 1)) AS href FROM pages)")
def relative_href(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select(F.explode(ct.hrefs(F.col("html"))).alias("href")).distinct()
    return links.select("href", u.absolute(F.col("href"), "https://www.example.com").alias("url"))


@query("SELECT page_id, regexp_matches(lower(html), 'captcha|unusual traffic|not a robot|/sorry/|systems have detected') AS google, regexp_matches(lower(html), 'turing|/captcha|class=\"captcha|captcha_header') AS bing, regexp_matches(lower(html), 'anomaly[-_]modal') AS duckduckgo FROM pages")
def unusable_page_flag(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", *[ct.robot_page(F.col("html"), e).alias(e) for e in dims.ENGINE_PAGES])


@query("WITH i AS (SELECT DISTINCT text FROM documents WHERE doc_id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM documents o WHERE o.doc_id % 3 = 0 AND o.text = documents.text)) SELECT (SELECT count(*) FROM documents WHERE doc_id % 3 <> 0) AS n_total, count(*) AS n_inserted, (SELECT count(*) FROM documents WHERE doc_id % 3 <> 0) - count(*) AS n_duplicate FROM i")
def insert_ignore_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_hash"))
    return insert_counts(docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 <> 0"), "text_hash", "doc_id")


@query(PAGES + " SELECT page_id, NOT (domain = 'example.com' OR ends_with(domain, '.example.com')) AS kept FROM p")
def result_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", u.keep_result(F.col("url"), ("example.com",)).alias("kept"))
