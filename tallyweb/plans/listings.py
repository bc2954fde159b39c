"""Queries over listings with links: orders, lineitem, part, customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweb.functions import contacts as ct
from tallyweb.functions import urls as u
from tallyweb.operators import enrich, listing, merge
from tallyweb.plans.registry import AS_OF, query, table
from tallyweb.plans.urls import PAGES
from tallyweb.sources.exports import csv_line, exportable


@query("SELECT p_type, count(DISTINCT p_partkey) AS n_listings, count(DISTINCT l_orderkey) AS n_orders FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_type ORDER BY n_listings DESC, p_type LIMIT 100")
def category_stats(spark, sf_dir):
    j = table(spark, sf_dir, "part").join(table(spark, sf_dir, "lineitem"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return j.groupBy("p_type").agg(F.countDistinct("p_partkey").alias("n_listings"), F.countDistinct("l_orderkey").alias("n_orders")).orderBy(F.desc("n_listings"), "p_type").limit(100)


@query("SELECT o_custkey, count(l_linenumber) AS n_items FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey ORDER BY n_items DESC, o_custkey LIMIT 500")
def domain_email_counts(spark, sf_dir):
    j = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return j.groupBy("o_custkey").agg(F.count("l_linenumber").alias("n_items")).orderBy(F.desc("n_items"), "o_custkey").limit(500)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def has_child_semi(spark, sf_dir):
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    return listing.with_match(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), links, "o_orderkey", F.col("l_returnflag") == "R")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority ILIKE '%high%' AND EXISTS (SELECT 1 FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_orderkey = o_orderkey AND p_brand LIKE '%1')")
def filtered_listing(spark, sf_dir):
    links = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o_orderkey"), "p_brand")
    o = listing.filtered(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "O", F.col("o_orderpriority").ilike("%high%"), None)
    return listing.with_match(o.select("o_orderkey"), links, "o_orderkey", F.col("p_brand").endswith("1"))


@query("SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS emails, count(*) AS n_emails, count(*) FILTER (l_returnflag = 'N') AS n_valid FROM lineitem GROUP BY l_orderkey")
def listing_rollup(spark, sf_dir):
    r = listing.email_rollup(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", ["l_returnflag", "l_linenumber"], F.col("l_returnflag") == "N")
    return r.select("l_orderkey", F.array_join("emails", ",").alias("emails"), "n_emails", "n_valid")


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS v, event_type AS k, CAST(event_id AS VARCHAR) AS m FROM events), l AS (SELECT user_id, k, arg_max(m, event_id) AS m FROM e GROUP BY user_id, k)
SELECT e.user_id, arg_max(v, event_id) FILTER (v IS NOT NULL) AS newest, arg_min(event_id, event_id) AS first_id, (SELECT string_agg(DISTINCT k, ',' ORDER BY k) FROM e x WHERE x.user_id = e.user_id) AS phones, (SELECT string_agg(k || '=' || m, ',' ORDER BY k) FROM l WHERE l.user_id = e.user_id) AS links FROM e GROUP BY e.user_id""")
def listing_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("v"), F.array("event_type").alias("a"), F.create_map("event_type", F.col("event_id").cast("string")).alias("m"))
    g = e.groupBy("user_id").agg(merge.newest(F.col("v"), "event_id").alias("newest"), merge.oldest(F.col("event_id"), "event_id").alias("first_id"))
    g = g.join(merge.distinct_union(e, "user_id", "a", "a"), "user_id").join(merge.merged_map(e, "user_id", "m", "m", "event_id"), "user_id")
    pairs = F.array_sort(F.transform(F.map_entries("m"), lambda x: F.concat(x["key"], F.lit("="), x["value"])))
    return g.select("user_id", "newest", "first_id", F.array_join("a", ",").alias("phones"), F.array_join(pairs, ",").alias("links"))


@query("SELECT c_custkey, coalesce(max(o_orderstatus) FILTER (o_orderstatus <> 'P'), c_mktsegment) AS category, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment")
def reenrich_merge(spark, sf_dir):
    new = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))).alias("s"), F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").join(new, F.col("c_custkey") == F.col("o_custkey"), "left")
    return c.select("c_custkey", F.coalesce("s", "c_mktsegment").alias("category"), F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 1000")
def keyset_page(spark, sf_dir):
    return listing.keyset_page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100, 1000)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 50 OFFSET 100")
def offset_page(spark, sf_dir):
    return listing.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 3, 50, F.desc("o_orderkey"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderpriority DESC, o_orderdate, o_orderkey LIMIT 50")
def sorted_listing(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_orderpriority"), "o_orderdate", "o_orderkey").select("o_orderkey").limit(50)


@query("""WITH s AS (SELECT o_orderkey, (EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND (l_returnflag = 'R' OR l_discount >= 0.07)))::INT * 40 + (o_totalprice > 100000)::INT * 20 + (o_orderpriority <> '')::INT * 15 + (o_orderstatus = 'F')::INT * 15 + (o_custkey % 2 = 0)::INT * 10 AS score FROM orders)
SELECT o_orderkey, score FROM s WHERE score < 90""")
def completeness_score(spark, sf_dir):
    good = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' OR l_discount >= 0.07").select(F.col("l_orderkey").alias("_k")).distinct()
    o = table(spark, sf_dir, "orders").join(good, F.col("o_orderkey") == F.col("_k"), "left")
    s = ct.completeness(F.col("_k").isNotNull(), F.col("o_totalprice") > 100000, F.col("o_orderpriority") != "", F.col("o_orderstatus") == "F", F.col("o_custkey") % 2 == 0)
    return o.select("o_orderkey", s.alias("score")).where("score < 90")


@query('''WITH e AS (SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS emails FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
SELECT c_custkey, c_custkey || ',"' || c_name || ', ""co""",' || emails AS line FROM customer JOIN e ON o_custkey = c_custkey''')
def csv_escape_export(spark, sf_dir):
    links = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", F.expr("CASE o_orderstatus WHEN 'P' THEN 'invalid' WHEN 'O' THEN 'pending' ELSE 'valid' END").alias("status"))
    out = exportable(table(spark, sf_dir, "customer"), links, "c_custkey", "o_orderpriority", "status")
    return out.select("c_custkey", csv_line(F.col("c_custkey"), F.concat("c_name", F.lit(', "co"')), F.col("emails")).alias("line"))


@query(PAGES + r" SELECT domain, arg_min(url, sha256(canonical)) AS url, arg_max(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), sha256(canonical)) AS page_title, count(*) >= 1 AS listed FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY url) = 1) GROUP BY domain")
def page_listings(spark, sf_dir):
    """Pages all the way to listings."""
    found = enrich.enrich(table(spark, sf_dir, "pages"), F.expr(AS_OF), metadata=False)
    listings, _, _, _ = merge.normalize(found)
    return listings.select("domain", "url", "page_title", F.lit(True).alias("listed"))


@query(PAGES + " SELECT url_hash, domain FROM (SELECT sha256(canonical) AS url_hash, domain, min(page_id) AS page_id FROM p GROUP BY ALL) WHERE url_hash NOT IN (SELECT sha256(canonical) FROM p WHERE page_id % 4 = 0)")
def discovered_jobs(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    known = p.where("page_id % 4 = 0").select(u.hash_url(F.col("url")).alias("url_hash"))
    return enrich.discovered(p, known).select("url_hash", "domain")
