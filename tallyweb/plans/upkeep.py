"""Queries over the upkeep of jobs with its limits, over the fleet, and over lists for a look at the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweb.operators import analytics as an
from tallyweb.operators import enrich, jobs, listing
from tallyweb.plans.registry import AS_OF, query, stamp, table

_STATUS = "CASE event_id % 4 WHEN 0 THEN 'processing' WHEN 1 THEN 'failed' WHEN 2 THEN 'dead' ELSE 'pending' END"
_MESSAGE = "CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'permanently dead: old' END"
_JOBS = f"WITH j AS (SELECT event_id AS id, user_id AS parent, ts AS since, {_STATUS} AS status, {_MESSAGE} AS error_msg, CAST(event_id % 23 AS INTEGER) AS attempts FROM events)"


def _jobs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("user_id").alias("parent"), F.col("ts").alias("since"), F.expr(_STATUS).alias("status"), F.expr(_MESSAGE).alias("error_msg"), (F.col("event_id") % 23).cast("int").alias("attempts"))


@query(f"""{_JOBS}, h AS (SELECT id FROM j WHERE status = 'processing' AND since < {AS_OF} - INTERVAL 5 MINUTE ORDER BY since, id LIMIT 200)
SELECT id, CASE WHEN id IN (SELECT id FROM h) THEN 'pending' ELSE status END AS status FROM j""")
def stuck_reset(spark, sf_dir):
    return jobs.reset_stuck(_jobs(spark, sf_dir), F.expr(AS_OF), "id", at="since").select("id", "status")


@query(f"""{_JOBS}, o AS (SELECT *, status = 'failed' AND since < {AS_OF} - INTERVAL 1 HOUR AS old FROM j), h AS (SELECT id FROM o WHERE old AND attempts < 10 ORDER BY since, id LIMIT 500)
SELECT id, CASE WHEN old AND attempts >= 10 THEN 'dead' WHEN id IN (SELECT id FROM h) THEN 'new' ELSE status END AS status, (attempts + CASE WHEN id IN (SELECT id FROM h) THEN 1 ELSE 0 END)::INT AS attempts FROM o""")
def failed_heal(spark, sf_dir):
    return jobs.heal_failed(_jobs(spark, sf_dir), F.expr(AS_OF), "id", at="since").select("id", "status", "attempts")


@query(f"{_JOBS} SELECT id, CASE WHEN status = 'dead' AND attempts >= 15 AND NOT starts_with(error_msg, 'permanently dead') THEN 'permanently dead: max resurrections reached' ELSE error_msg END AS error_msg FROM j")
def permanent_label(spark, sf_dir):
    return jobs.label_permanent(_jobs(spark, sf_dir)).select("id", "error_msg")


@query(f"""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'processing' ELSE 'done' END AS status, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 40 AS INTEGER)) AS updated_at FROM customer),
z AS (SELECT c_custkey FROM c WHERE status = 'processing' AND updated_at < {AS_OF} - INTERVAL 10 MINUTE AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') ORDER BY updated_at, c_custkey LIMIT 1000)
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT c_custkey FROM z) THEN 'pending' ELSE status END AS status FROM c""")
def zombie_requeue(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 2 = 0 THEN 'processing' ELSE 'done' END AS status", "TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 40 AS INT)) AS updated_at")
    return jobs.heal_zombies(c, table(spark, sf_dir, "orders"), F.expr(AS_OF), "c_custkey", "o_custkey", F.col("o_orderstatus") == "P").select("c_custkey", "status")


@query(f"""{_JOBS}, c AS (SELECT id FROM j WHERE status = 'pending' QUALIFY row_number() OVER (PARTITION BY parent ORDER BY since DESC, id) <= 2)
SELECT id, parent, CASE WHEN id IN (SELECT id FROM c) THEN 'processing' ELSE status END AS status, id IN (SELECT id FROM c) AS claimed FROM j""")
def claim_states(spark, sf_dir):
    claimed, rest = jobs.claim_jobs(_jobs(spark, sf_dir), F.expr(AS_OF), 2, "id", F.desc("since"), per="parent")
    return claimed.select("id", "parent", "status", F.lit(True).alias("claimed")).unionByName(rest.select("id", "parent", "status", F.lit(False).alias("claimed")))


@query(f"""{_JOBS} SELECT id, (attempts % 6 + 1)::INT AS attempts, CASE WHEN attempts % 6 + 1 >= 5 THEN 'failed' ELSE 'new' END AS status, CASE WHEN attempts % 6 + 1 < 5 THEN strftime({AS_OF} + to_seconds(30 * pow(2, attempts % 6)), '%Y-%m-%d %H:%M:%S') END AS next_attempt_at FROM j""")
def search_backoff(spark, sf_dir):
    out = jobs.fail_search(_jobs(spark, sf_dir).withColumn("attempts", F.col("attempts") % 6), F.expr(AS_OF))
    return out.select("id", "attempts", "status", stamp("next_attempt_at").alias("next_attempt_at"))


@query(f"""WITH q AS (SELECT c_custkey, 'new' AS status FROM customer), n AS (SELECT count(*) AS n FROM events)
SELECT c_custkey, CASE WHEN n > 500 THEN 'pending' ELSE status END AS status, CASE WHEN n > 500 THEN strftime({AS_OF} + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') END AS enqueue_at FROM q, n""")
def backpressure(spark, sf_dir):
    q = table(spark, sf_dir, "customer").select("c_custkey", F.lit("new").alias("status"), F.lit(None).cast("timestamp").alias("enqueue_at"))
    out = jobs.push_back(q, table(spark, sf_dir, "events"), F.expr(AS_OF), most=500)
    return out.select("c_custkey", "status", stamp("enqueue_at").alias("enqueue_at"))


_WORKER = "CASE user_id % 5 WHEN 0 THEN 'dead' WHEN 1 THEN 'idle' ELSE 'working' END"


@query(f"""WITH w AS (SELECT event_type, {_WORKER} AS status, event_id % 9 AS delta FROM events)
SELECT event_type, count(*) FILTER (status <> 'dead') AS n_online, count(*) FILTER (status = 'working') AS n_busy, count(*) FILTER (status = 'dead') AS n_dead, (120 * coalesce(sum(delta) FILTER (status <> 'dead'), 0))::BIGINT AS per_hour FROM w GROUP BY event_type""")
def fleet_summary(spark, sf_dir):
    w = table(spark, sf_dir, "events").select("event_type", F.expr(_WORKER).alias("status"), (F.col("event_id") % 9).alias("delta"))
    return an.fleet(w, "event_type", "status", "delta")


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS n_purchase FROM events GROUP BY 1)
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, n - lag(n) OVER (ORDER BY hour) AS n_change, n_purchase - lag(n_purchase) OVER (ORDER BY hour) AS n_purchase_change FROM h""")
def snapshot_changes(spark, sf_dir):
    h = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("n_purchase"))
    return an.snapshots(h, "hour", "n", "n_purchase").select(stamp("hour").alias("hour"), "n_change", "n_purchase_change")


@query("SELECT event_type, CASE WHEN 1000000 > count(*) AND count(*) FILTER (event_id % 2 = 0) > 0 THEN ((1000000 - count(*)) // (24 * count(*) FILTER (event_id % 2 = 0)))::BIGINT END AS eta_days FROM events GROUP BY event_type")
def target_eta(spark, sf_dir):
    c = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("event_id") % 2 == 0).alias("per_hour"))
    return c.select("event_type", an.eta_days(F.col("n"), 1_000_000, F.col("per_hour")).alias("eta_days"))


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality = 1, true)")
def acceptable_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "quality", (F.col("quality") == 1).alias("good")), "doc_id", "left")
    return enrich.acceptable(d, "good").select("doc_id", "quality")


@query(f"{_JOBS} SELECT id, strftime(since, '%Y-%m-%d %H:%M:%S') AS since FROM j ORDER BY j.since DESC, id LIMIT 50")
def newest_jobs(spark, sf_dir):
    return listing.newest_jobs(_jobs(spark, sf_dir), at="since").select("id", stamp("since").alias("since"))


@query(f"{_JOBS} SELECT id, parent FROM j WHERE status = 'pending' ORDER BY id LIMIT 100")
def pending_jobs(spark, sf_dir):
    return listing.pending(_jobs(spark, sf_dir), 100).select("id", "parent")


_KEYS = list(range(3, 3000, 7))


@query(f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN ({', '.join(map(str, _KEYS))})")
def id_list(spark, sf_dir):
    return listing.in_list(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", _KEYS)
