"""Queries over the job state machine, on orders, customers and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweb.operators import dedup, jobs, keywords
from tallyweb.plans.registry import AS_OF, query, rows, stamp, table

_BUSY = "o_orderstatus IN ('P', 'O')"


@query("SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS result_count FROM orders GROUP BY o_custkey HAVING count(*) FILTER (o_orderstatus = 'P') = 0")
def query_completion(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return jobs.completed_parents(o, "o_custkey", F.col("o_orderstatus") == "P", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def zombie_heal(spark, sf_dir):
    return jobs.zombies(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table(spark, sf_dir, "orders"), "c_custkey", "o_custkey", F.col("o_orderstatus") == "P")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) <= 20")
def claim_topn_per_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return dedup.claim(o, 20, F.desc("o_totalprice"), "o_orderkey", per="o_orderstatus").drop("o_totalprice")


_ERROR = "CASE event_id % 5 WHEN 0 THEN 'HTTP 404' WHEN 1 THEN 'HTTP 403' WHEN 2 THEN 'timeout' WHEN 3 THEN 'x509: bad' ELSE NULL END"


def _errors(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type = 'error'")
    return e.select("event_id", "ts", F.expr(_ERROR).alias("error_msg"), (F.col("event_id") % 12).cast("int").alias("attempts"))


@query(f"""WITH e AS (SELECT event_id, ts, {_ERROR} AS m, CAST(event_id % 12 AS INTEGER) AS a FROM events WHERE event_type = 'error')
SELECT event_id, a + 1 AS attempts, CASE WHEN coalesce(m IN ('HTTP 404', 'x509: bad'), false) OR a + 1 >= 10 THEN 'dead' ELSE 'failed' END AS status, strftime({AS_OF} + to_seconds(30 * pow(2, a)), '%Y-%m-%d %H:%M:%S') AS next_attempt_at FROM e""")
def job_failure_backoff(spark, sf_dir):
    out = jobs.fail(_errors(spark, sf_dir), F.expr(AS_OF), 10)
    return out.select("event_id", "attempts", "status", stamp("next_attempt_at").alias("next_attempt_at"))


@query(f"WITH e AS (SELECT {_ERROR} AS m FROM events WHERE event_type = 'error') SELECT count(*) FILTER (m LIKE 'HTTP 404%') AS n_404, count(*) FILTER (m LIKE 'HTTP 403%') AS n_403, count(*) FILTER (m NOT LIKE 'HTTP 404%' AND m NOT LIKE 'HTTP 403%') AS n_other FROM e")
def dead_breakdown(spark, sf_dir):
    m = F.col("error_msg")
    return _errors(spark, sf_dir).agg(F.count_if(m.like("HTTP 404%")).alias("n_404"), F.count_if(m.like("HTTP 403%")).alias("n_403"), F.count_if(~m.like("HTTP 404%") & ~m.like("HTTP 403%")).alias("n_other"))


@query(f"WITH e AS (SELECT event_id, {_ERROR} AS m FROM events WHERE event_type = 'error') SELECT event_id, m AS error_msg FROM e WHERE m NOT LIKE 'HTTP 403%' AND m NOT LIKE 'HTTP 404%' AND m NOT LIKE '%x509%'")
def error_class_filter(spark, sf_dir):
    return _errors(spark, sf_dir).where(jobs.resurrectable(F.col("error_msg"))).select("event_id", "error_msg")


_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'processing' WHEN 'click' THEN 'pending' ELSE 'completed' END"


def _jobs(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", F.expr(_STATUS).alias("status"), (F.col("event_id") % 14).cast("int").alias("attempts"))


@query(f"WITH j AS (SELECT ts, {_STATUS} AS s FROM events) SELECT CASE WHEN s = 'processing' AND ts < {AS_OF} - INTERVAL 5 DAY THEN 'pending' ELSE s END AS status, count(*) AS n FROM j GROUP BY 1")
def stale_reset(spark, sf_dir):
    return jobs.reset_stale(_jobs(spark, sf_dir), F.expr(AS_OF), "5 DAY", "ts").groupBy("status").agg(F.count("*").alias("n"))


@query(f"""WITH j AS (SELECT ts, {_STATUS} AS s, CAST(event_id % 14 AS INTEGER) AS a FROM events), k AS (SELECT CASE WHEN s = 'failed' AND ts < {AS_OF} - INTERVAL 1 DAY THEN CASE WHEN a < 10 THEN 'new' ELSE 'dead' END ELSE s END AS status, CASE WHEN s = 'failed' AND ts < {AS_OF} - INTERVAL 1 DAY AND a < 10 THEN a + 1 ELSE a END AS a FROM j)
SELECT status, count(*) AS n, sum(a)::BIGINT AS attempts FROM k GROUP BY status""")
def retry_requeue(spark, sf_dir):
    out = jobs.bury(_jobs(spark, sf_dir), F.expr(AS_OF), 10, "1 DAY", "ts")
    return out.groupBy("status").agg(F.count("*").alias("n"), F.sum("attempts").alias("attempts"))


@query(f"WITH j AS (SELECT ts, {_STATUS} AS s, CAST(event_id % 14 AS INTEGER) AS a, ts + to_seconds(30 * pow(2, event_id % 14)) AS due FROM events) SELECT CASE WHEN s = 'failed' AND due <= {AS_OF} AND a < 10 THEN 'pending' ELSE s END AS status, count(*) AS n FROM j GROUP BY 1")
def retry_due(spark, sf_dir):
    j = _jobs(spark, sf_dir).withColumn("next_attempt_at", F.col("ts") + F.make_dt_interval(secs=(30 * F.pow(F.lit(2), F.col("attempts"))).cast("decimal(18,6)")))
    return jobs.retry_due(j, F.expr(AS_OF), 10).groupBy("status").agg(F.count("*").alias("n"))


@query(f"WITH w AS (SELECT user_id, max(ts) AS t FROM events GROUP BY user_id) SELECT user_id, CASE WHEN t < {AS_OF} - INTERVAL 12 HOUR THEN 'dead' ELSE 'idle' END AS status FROM w")
def worker_liveness(spark, sf_dir):
    w = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_heartbeat")).withColumn("status", F.lit("idle"))
    return jobs.dead_workers(w, F.expr(AS_OF), "12 HOUR").select("user_id", "status")


@query("""WITH t AS (SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0), i AS (SELECT o_orderkey, 'new' AS status, 0.0::DOUBLE AS price FROM orders WHERE o_orderkey % 2 = 1)
SELECT o_orderkey, CASE WHEN t.status IS NULL OR (t.status = 'F' AND i.status IS NOT NULL) THEN i.status ELSE t.status END AS status, CASE WHEN t.status IS NULL OR (t.status = 'F' AND i.status IS NOT NULL) THEN i.price ELSE t.price END AS price FROM t FULL JOIN i USING (o_orderkey)""")
def conditional_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    target = o.where("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    incoming = o.where("o_orderkey % 2 = 1").select("o_orderkey", F.lit("new").alias("status"), F.lit(0.0).alias("price"))
    return dedup.conditional_upsert(target, incoming, "o_orderkey", F.col("status") == "F")


@query("SELECT (SELECT count(*) FROM customer WHERE c_mktsegment <> 'BUILDING') AS n_parents, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) AS n_children")
def cascade_delete(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    parents, children = dedup.cascade_delete(c, o, c.where("c_mktsegment = 'BUILDING'"), "c_custkey", "o_custkey")
    return parents.agg(F.count("*").alias("n_parents")).join(children.agg(F.count("*").alias("n_children")))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY sha256(o_orderkey || ':seed'), o_orderkey LIMIT 100")
def seeded_claim(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    return dedup.claim(o, 100, dedup.seeded_order("o_orderkey", "seed"), "o_orderkey")


@query("SELECT count(*) AS n FROM (SELECT 1 FROM orders WHERE o_orderstatus = 'O' LIMIT 5000)")
def bounded_count(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").limit(5000).agg(F.count("*").alias("n"))


_OPS = ", ".join("('" + o + "')" for o in keywords.OPERATORS)


@query(f"SELECT DISTINCT lower(r_name || ' ' || n_name || ' ' || o) AS keyword FROM region, nation, (VALUES {_OPS}) v(o)")
def keyword_cartesian(spark, sf_dir):
    return keywords.cartesian(table(spark, sf_dir, "region").select("r_name"), table(spark, sf_dir, "nation").select("n_name"))


@query("SELECT * FROM (VALUES ('spa in Ubud near me'), ('spa in Paris near me'), ('Yoga in Ubud near me'), ('Yoga in Paris near me')) v(keyword)")
def template_expand(spark, sf_dir):
    return keywords.expand_template(spark, " {niche} in {city} near me ", {"niche": ["spa", "Yoga", "SPA"][:2], "city": ["Ubud", "Paris"], "unused": ["x"]})


@query("SELECT min(k) AS keyword FROM (SELECT n_name AS k FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT lower(r_name) FROM region) GROUP BY lower(k)")
def keyword_union(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation").select(F.col("n_name").alias("keyword")), table(spark, sf_dir, "region").select(F.col("r_name").alias("keyword"))
    return keywords.distinct_keywords(n.unionByName(r).unionByName(r.select(F.lower("keyword").alias("keyword"))))


@query("WITH d AS (SELECT n_name AS q FROM nation ORDER BY n_nationkey LIMIT 10), v AS (SELECT q || ' ' || s AS query_text FROM d, (VALUES ('near me'), ('contact')) x(s)) SELECT query_text, sha256(lower(query_text)) AS text_hash FROM v WHERE lower(query_text) NOT IN (SELECT lower(n_name) || ' contact' FROM nation WHERE n_nationkey < 3)")
def query_expansion(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("query_text"), "n_nationkey")
    known = n.where("n_nationkey < 3").select(F.sha2(F.concat(F.lower("query_text"), F.lit(" contact")), 256).alias("text_hash"))
    return keywords.expand_queries(n, known, 10, ("near me", "contact"), "n_nationkey").select("query_text", "text_hash")


@query("SELECT lower(t) AS k, arg_min(doc_id, doc_id) AS doc_id FROM (SELECT doc_id, source AS t FROM documents UNION ALL SELECT doc_id, upper(source) FROM documents) GROUP BY lower(t)")
def import_first_wins(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    both = d.unionAll(d.select("doc_id", F.upper("source").alias("source")))
    return dedup.first_wins(both, F.lower("source"), "doc_id", "source").select(F.lower("source").alias("k"), "doc_id")


@query("SELECT lower(r_name) AS city, min(lower(n_name)) AS country FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def dim_first_wins(spark, sf_dir):
    from tallyweb.sources.exports import dump_dimensions

    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return dump_dimensions(n.select(F.col("r_name").alias("city"), F.col("n_name").alias("country")), rows(spark, "niche string", ("day spa",)))[0]
