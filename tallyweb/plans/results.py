"""Queries over result pages, structured data, exports, filters and further enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweb import dims
from tallyweb.functions import contacts as ct
from tallyweb.operators import backfill, listing
from tallyweb.plans.registry import AS_OF, query, rows, sql_values, table
from tallyweb.sources import exports, results

_ENGINE = "CASE page_id % 3 WHEN 0 THEN 'google' WHEN 1 THEN 'bing' ELSE 'duckduckgo' END"
#: Around a page's own url: the same again, an excluded one, a directory, one of the engine's own.
_LINKS = ("https://www.facebook.com/x", "https://www.yelp.com/biz/1", "https://support.google.com/a", "https://www.msn.com/b", "https://duckduckgo.com/c")


@query(f"""WITH e AS (SELECT page_id, {_ENGINE} AS engine, url FROM pages), k AS (SELECT page_id, engine, unnest([url, 'https://www.yelp.com/biz/1', 'https://support.google.com/a', 'https://www.msn.com/b', 'https://duckduckgo.com/c']) AS url, unnest(range(5)) AS i FROM e)
SELECT page_id, engine, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) AS INTEGER) AS position, url FROM k WHERE NOT (engine = 'google' AND contains(url, 'google.com')) AND NOT (engine = 'bing' AND contains(url, 'msn.com')) AND NOT (engine = 'duckduckgo' AND contains(url, 'duckduckgo.com'))""")
def serp_results(spark, sf_dir):
    """Result pages made around each page's url, in each engine's form."""
    urls = F.array(F.col("url"), F.col("url"), *[F.lit(x) for x in _LINKS])
    escaped = lambda x: F.replace(x, F.lit("&"), F.lit("&amp;"))
    google = lambda x, i: F.concat(F.when(i == 0, F.lit('<div class="yuRUbf"><div><span><a href="')).otherwise(F.lit('<div class="g x"><p><a href="')), F.when(i == 1, F.concat(F.lit("/url?sa=U&amp;q="), F.url_encode(x))).otherwise(escaped(x)), F.lit('">t</a></span></p></div></div>'))
    bing = lambda x, i: F.concat(F.lit('<li class="b_algo"><h2><a href="'), F.when(i == 1, F.concat(F.lit("https://www.bing.com/ck/a?p=1&amp;u=a1"), F.translate(F.base64(F.encode(x, "UTF-8")), "+/=\r\n", "-_"))).otherwise(escaped(x)), F.lit('">t</a></h2><a href="https://no.result/">s</a></li>'))
    ddg = lambda x, i: F.concat(F.lit('<div class="web-result"><a class="result__a" href="//duckduckgo.com/l/?kh=-1&amp;uddg='), F.url_encode(F.url_encode(x)), F.lit('">t</a><a href="https://no.result/">s</a></div>'))
    pages = table(spark, sf_dir, "pages").withColumn("engine", F.expr(_ENGINE))
    body = F.when(F.col("engine") == "google", F.array_join(F.transform(urls, google), "")).when(F.col("engine") == "bing", F.array_join(F.transform(urls, bing), "")).otherwise(F.array_join(F.transform(urls, ddg), ""))
    return results.search_results(pages.select("page_id", "engine", F.concat(F.lit('<html><a href="https://no.result/">n</a>'), body).alias("html"))).select("page_id", "engine", "position", "url")


@query("SELECT p_partkey, p_name AS name, 'https://' || p_partkey || '.example.net/' AS listing_url, '+6281' || (10000000 + p_partkey) AS phone, 'p' || p_partkey || '@mail.example.net' AS email, p_type AS category, p_brand || ' street, Town ' || p_size AS address, CAST(p_size % 5 AS VARCHAR) AS rating FROM part")
def structured_listings(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    address = F.struct(F.concat("p_brand", F.lit(" street")).alias("streetAddress"), F.concat(F.lit("Town "), F.col("p_size").cast("string")).alias("addressLocality"))
    key = F.col("p_partkey").cast("string")
    data = F.to_json(F.struct(F.col("p_type").alias("@type"), F.col("p_name").alias("name"), F.concat(F.lit("https://"), key, F.lit(".example.net/")).alias("url"), F.concat(F.lit("+6281"), (F.col("p_partkey") + 10000000).cast("string")).alias("telephone"), F.concat(F.lit("p"), key, F.lit("@mail.example.net")).alias("email"), address.alias("address"), F.struct((F.col("p_size") % 5).alias("ratingValue")).alias("aggregateRating")))
    return results.structured_listings(p.select("p_partkey", F.concat(F.lit('<script type="application/ld+json">'), data, F.lit("</script><script type=\"application/ld+json\">{\"url\":\"x\"}</script>")).alias("html")))


@query("SELECT doc_id, e AS email FROM (SELECT doc_id, lang || doc_id || '@mail' || doc_id % 7 || '.net' AS e FROM documents)")
def shielded_emails(spark, sf_dir):
    """Emails hidden as hex digits under a key, and found again."""
    mail = F.concat("lang", F.col("doc_id").cast("string"), F.lit("@mail"), (F.col("doc_id") % 7).cast("string"), F.lit(".net"))
    key = (F.col("doc_id") % 250 + 1).cast("int")
    letters = F.transform(F.split(mail, ""), lambda c: F.lpad(F.hex(F.ascii(c).bitwiseXOR(key)), 2, "0"))
    html = F.concat(F.lit('<a href="/x" data-cfemail="'), F.lower(F.concat(F.lpad(F.hex(key), 2, "0"), F.array_join(letters, ""))), F.lit('">[email]</a>'))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(ct.page_emails(html)).alias("email"))


@query("SELECT c_custkey, '+6221' || (10000000 + c_custkey) AS phone FROM customer UNION ALL SELECT c_custkey, '0812' || (1000000 + c_custkey) AS phone FROM customer")
def page_phones(spark, sf_dir):
    key = F.col("c_custkey")
    html = F.concat(F.lit("<a href='tel:+62%2021 "), (key + 10000000).cast("string"), F.lit("'>call</a> or 0812-"), (key + 1000000).cast("string"), F.lit("."))
    return table(spark, sf_dir, "customer").select("c_custkey", F.explode(ct.filter_phones(ct.page_phones(html))).alias("phone"))


_TAILS = (("Tokyo, Japan", "JAPAN"), ("Austin, United States", "UNITED STATES"), ("Madrid, Spain", "SPAIN"), ("Italy", "ITALY"), ("x, Bali", ""), ("Paris FR ", "FR"), ("Sydney NSW", ""), ("São Paulo, SP", ""), ("Ontario, on", ""), ("12345", ""), ("Wellington, new zealand", "NEW ZEALAND"), ("Seoul,KOR", "KOR"))


@query(f"SELECT address, country, '' AS kind FROM ({sql_values(*_TAILS)}) v(address, country) UNION ALL SELECT n_name || ' 1, Town, ' || name, upper(name), 'made' FROM nation, (VALUES {', '.join(f'({chr(39)}{n}{chr(39)})' for n in dims.ADDRESS_COUNTRIES)}) w(name)")
def country_tails(spark, sf_dir):
    """Every known name at the end of an address."""
    names = F.array(*[F.lit(n) for n in dims.ADDRESS_COUNTRIES])
    made = table(spark, sf_dir, "nation").select(F.explode(F.transform(names, lambda n: F.concat("n_name", F.lit(" 1, Town, "), n))).alias("address"), F.lit("made").alias("kind"))
    given = rows(spark, "address string, _ string", *_TAILS).select("address", F.lit("").alias("kind"))
    return given.unionAll(made).select("address", ct.country_tail(F.col("address")).alias("country"), "kind")


@query(f"SELECT n_name, CASE lower(n_name) {' '.join(f'WHEN {chr(39)}{k.replace(chr(39), chr(39) * 2)}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in dims.COUNTRY_NAMES.items())} ELSE n_name END AS country FROM nation")
def country_fold(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_name", F.col("n_name").alias("country"))
    return backfill.normal_countries(n)


def _listings(spark, sf_dir):
    """Orders as listings, with domain, website and the like made up from them."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("id"),
        F.concat(F.lit("d"), (key % 50).cast("string"), F.lit(".net")).alias("domain"),
        F.when(key % 2 == 0, F.concat(F.lit("https://w"), key.cast("string"))).alias("website"),
        F.col("o_orderpriority").alias("business_name"),
        F.when(key % 3 != 0, F.col("o_orderstatus")).alias("category"),
        F.when(key % 4 == 0, F.lit("+62811")).alias("phone"),
        F.when(key % 5 == 0, F.array(F.lit("0811"))).alias("phones"),
        F.when(key % 3 == 1, F.lit("1 Road")).alias("address"),
        F.lit("Ubud").alias("city"),
        F.when(key % 7 == 0, F.lit("ID")).otherwise(F.lit("")).alias("country"),
        F.when(key % 2 == 1, F.create_map(F.lit("x"), F.lit("y"))).alias("social_links"),
        F.lit(None).cast("timestamp").alias("re_enriched_at"),
        F.when(key % 11 == 0, F.expr(AS_OF)).alias("re_enrich_locked_at"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def _links(spark, sf_dir):
    """Lines as the listings' emails."""
    mail = F.concat(F.lit("m"), F.col("l_partkey").cast("string"), F.when(F.col("l_suppkey") % 2 == 0, F.lit("@gmail.com")).otherwise(F.lit("@b.net")))
    status = F.when(F.col("l_returnflag") == "N", F.lit("valid")).when(F.col("l_returnflag") == "R", F.lit("invalid")).otherwise(F.lit("pending"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), mail.alias("email"), status.alias("validation_status"))


_L = """WITH l AS (SELECT o_orderkey AS id, 'd' || o_orderkey % 50 || '.net' AS domain, CASE WHEN o_orderkey % 2 = 0 THEN 'https://w' || o_orderkey END AS website, o_orderpriority AS business_name, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS category,
 CASE WHEN o_orderkey % 4 = 0 THEN '+62811' END AS phone, o_orderkey % 5 = 0 AS more, CASE WHEN o_orderkey % 3 = 1 THEN '1 Road' END AS address, CASE WHEN o_orderkey % 7 = 0 THEN 'ID' ELSE '' END AS country, o_orderkey % 2 = 1 AS social, o_orderkey % 11 = 0 AS held, o_orderdate AS created_at FROM orders),
m AS (SELECT l_orderkey AS id, 'm' || l_partkey || CASE WHEN l_suppkey % 2 = 0 THEN '@gmail.com' ELSE '@b.net' END AS email, CASE l_returnflag WHEN 'N' THEN 'valid' WHEN 'R' THEN 'invalid' ELSE 'pending' END AS status FROM lineitem)"""


@query(_L + " SELECT id FROM l WHERE domain = 'd7.net' AND business_name ILIKE '%e%' AND id IN (SELECT id FROM m) AND id IN (SELECT id FROM m WHERE email LIKE '%@gmail.com') AND id IN (SELECT id FROM m WHERE status = 'valid')")
def results_filter(spark, sf_dir):
    return listing.results_filter(_listings(spark, sf_dir), _links(spark, sf_dir), domain="d7.net", has_email=True, provider="gmail.com", status="valid", search="e").select("id")


@query(_L + """, s AS (SELECT *, (id IN (SELECT id FROM m WHERE status = 'valid'))::INT * 40 + (phone IS NOT NULL OR more)::INT * 20 + (business_name <> '' AND category IS NOT NULL)::INT * 15 + (address IS NOT NULL OR country <> '')::INT * 15 + social::INT * 10 AS score FROM l)
SELECT id, score, coalesce(website, 'https://' || domain) AS url FROM s WHERE NOT held AND score < 90 ORDER BY sha256(id || ':7') LIMIT 100""")
def eligible_batch(spark, sf_dir):
    scored = backfill.completeness(_listings(spark, sf_dir), _links(spark, sf_dir), "id", F.col("validation_status") == "valid")
    return backfill.eligible(scored, F.expr(AS_OF), seed="7").select("id", "score", "url")


@query(_L + """, e AS (SELECT id, string_agg(email, ';' ORDER BY email) AS emails, count(*) AS n, count(*) FILTER (status = 'valid') AS v FROM m GROUP BY id)
SELECT CAST(id AS VARCHAR) AS id, business_name, coalesce(category, '') AS category, domain, coalesce(website, '') AS website, coalesce(address, '') AS address, '' AS location, coalesce(phone, '') AS phone, coalesce(emails, '') AS emails, CAST(coalesce(n, 0) AS VARCHAR) AS email_count, CAST(coalesce(v, 0) AS VARCHAR) AS valid_email_count,
 strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM l LEFT JOIN e USING (id)""")
def export_v2(spark, sf_dir):
    return exports.v2_export(_listings(spark, sf_dir).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")), _links(spark, sf_dir))


@query(_L + """, e AS (SELECT id, string_agg(DISTINCT email, ';' ORDER BY email) AS emails FROM m WHERE status <> 'invalid' GROUP BY id)
SELECT business_name, coalesce(category, '') AS category, coalesce(website, '') AS website, coalesce(emails, '') AS emails, domain, CASE WHEN social THEN '{"x":"y"}' ELSE '{}' END AS social_links, coalesce(address, '') AS address, '' AS location, coalesce(phone, '') AS phone FROM l LEFT JOIN e USING (id) WHERE id IN (SELECT id FROM m WHERE ends_with(email, '@gmail.com'))""")
def export_v1(spark, sf_dir):
    return exports.v1_export(_listings(spark, sf_dir), _links(spark, sf_dir), provider="gmail.com")


@query(_L + """, e AS (SELECT id, string_agg(DISTINCT email, ';' ORDER BY email) AS emails FROM m GROUP BY id)
SELECT emails, coalesce(phone, '') AS phone, domain, '' AS url, business_name, coalesce(category, '') AS category, '' AS page_title, coalesce(website, '') AS website, coalesce(address, '') AS address, '' AS location, '' AS opening_hours, '' AS rating, CASE WHEN social THEN '{"x":"y"}' ELSE '{}' END AS social_links
FROM l JOIN e USING (id) WHERE id IN (SELECT id FROM m WHERE split_part(email, '@', 2) = 'gmail.com') ORDER BY created_at DESC, id LIMIT 50000""")
def export_chat(spark, sf_dir):
    return exports.chat_export(_listings(spark, sf_dir).withColumn("location", F.lit("")), _links(spark, sf_dir), word="Gmail")


_JOBS = "url_hash string, url string, domain string, status string, raw_emails array<string>, raw_phones array<string>, raw_social map<string,string>, raw_category string, raw_address string, completed_at timestamp"


def _jobs(spark, sf_dir):
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    none = F.array().cast("array<string>")
    return o.select(
        key.cast("string").alias("url_hash"),
        F.concat(F.lit("u"), key.cast("string")).alias("url"),
        F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("domain"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("pending").alias("status"),
        F.array(F.concat(F.lit("M"), F.col("o_custkey").cast("string"), F.lit("@b.net"))).alias("raw_emails"),
        F.when(key % 3 == 0, F.array(F.concat(F.lit("0811"), key.cast("string")))).otherwise(none).alias("raw_phones"),
        F.create_map(F.lit("facebook"), F.concat(F.lit("f"), key.cast("string"))).alias("raw_social"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).alias("raw_category"),
        F.when(key % 4 == 0, F.concat(F.lit("1 Road, Town"), key.cast("string"), F.lit(", Japan"))).alias("raw_address"),
        F.col("o_orderdate").cast("timestamp").alias("completed_at"),
    )


@query("""WITH j AS (SELECT o_orderkey AS k, o_orderstatus = 'F' AS done, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS category FROM orders), f AS (SELECT k + 7 AS k, CASE WHEN k % 5 = 0 THEN 'new' END AS category FROM j WHERE k % 3 = 0)
SELECT coalesce(j.k, f.k)::VARCHAR AS url_hash, CASE WHEN f.k IS NOT NULL OR done THEN 'completed' ELSE 'pending' END AS status, coalesce(f.category, j.category) AS raw_category, CASE WHEN f.k IS NOT NULL THEN 'fresh' ELSE 'f' || j.k END AS facebook FROM j FULL JOIN f ON j.k = f.k""")
def reenriched_jobs(spark, sf_dir):
    """Fresh results merged into jobs: arrays, links and status replaced, texts kept where there is nothing new."""
    jobs, key = _jobs(spark, sf_dir), F.col("url_hash").cast("long")
    fresh = jobs.where(key % 3 == 0).select((key + 7).cast("string").alias("url_hash"), "url", "domain", F.lit("completed").alias("status"), "raw_emails", "raw_phones", F.create_map(F.lit("facebook"), F.lit("fresh")).alias("raw_social"), F.when(key % 5 == 0, "new").alias("raw_category"), "completed_at")
    return backfill.merge_enriched(jobs, fresh).select("url_hash", "status", "raw_category", F.col("raw_social")["facebook"].alias("facebook"))


@query("""WITH j AS (SELECT o_custkey AS c, o_orderkey AS k, struct_pack(t := o_orderdate, h := o_orderkey::VARCHAR) AS tt FROM orders WHERE o_orderstatus = 'F'), p AS (SELECT c, arg_max(k, tt) AS k FROM j WHERE k % 3 = 0 GROUP BY c), a AS (SELECT c, arg_max(k, tt) AS k FROM j WHERE k % 4 = 0 GROUP BY c)
SELECT 'd' || c_custkey AS domain, CASE WHEN c_custkey % 5 = 0 THEN 'own' ELSE coalesce('0811' || p.k, '') END AS phones, CASE WHEN c_custkey % 2 = 0 THEN 'ID' WHEN a.k IS NOT NULL THEN 'JAPAN' END AS country, CASE WHEN a.k IS NOT NULL THEN 'Town' || a.k ELSE '' END AS city, 'facebook' AS links
FROM customer LEFT JOIN p ON p.c = c_custkey LEFT JOIN a ON a.c = c_custkey""")
def backfilled_listings(spark, sf_dir):
    c, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    own = c.select(
        F.concat(F.lit("d"), key.cast("string")).alias("domain"),
        F.when(key % 5 == 0, F.array(F.lit("own"))).otherwise(F.array().cast("array<string>")).alias("phones"),
        F.when(key % 2 == 0, F.lit("ID")).alias("country"),
        F.lit("").alias("city"),
        F.create_map(F.lit("facebook"), F.lit("f"), F.lit("tiktok"), F.lit("t")).alias("social_links"),
    )
    out = backfill.backfill(own, _jobs(spark, sf_dir))
    return out.select("domain", F.array_join("phones", ",").alias("phones"), "country", "city", F.array_join(F.map_keys("social_links"), ",").alias("links"))


@query("""WITH j AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderdate AS t, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, 'u' || o_orderkey) = 1)
SELECT 'm' || c || '@b.net' AS email, 'd' || c AS domain, 'u' || k AS source_url, CASE WHEN k % 3 = 0 THEN '0811' || k ELSE '' END AS phone, CASE WHEN k % 2 = 0 THEN p ELSE '' END AS business_category, 'f' || k AS facebook, 17 AS n_columns FROM j""")
def export_standalone(spark, sf_dir):
    out = exports.standalone_export(_jobs(spark, sf_dir).withColumns({c: F.lit("") for c in ("raw_business_name", "raw_description", "raw_location", "raw_opening_hours", "raw_rating")}))
    return out.select("email", "domain", "source_url", "phone", "business_category", "facebook", F.lit(len(out.columns)).alias("n_columns"))
