"""Counts, rates and KPIs over events, orders and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweb.functions import contacts as ct
from tallyweb.operators import analytics as an
from tallyweb.plans.registry import AS_OF, query, stamp, table
from tallyweb.streaming import streams

_NOW = F.expr
_TYPES = ["signup", "error", "click", "view", "purchase"]


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf_dir):
    return an.status_counts(table(spark, sf_dir, "orders"), "o_orderstatus")


@query("SELECT " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in _TYPES) + ", count(*) AS n_total FROM events")
def status_pivot(spark, sf_dir):
    return an.pivot_counts(table(spark, sf_dir, "events"), "event_type", _TYPES)


@query("SELECT coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 0)::DECIMAL(18, 2)::VARCHAR AS done, count(*) FILTER (o_orderstatus = 'X') AS n_none FROM (SELECT o_orderstatus, CAST(o_totalprice AS DECIMAL(18, 2)) AS o_totalprice FROM orders)")
def conditional_sum(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    return o.agg(F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("p"))), F.lit(0)).cast("decimal(18,2)").cast("string").alias("done"), F.count_if(F.col("o_orderstatus") == "X").alias("n_none"))


@query(f"SELECT count(*) AS n_total, count(*) FILTER (ts > {AS_OF} - INTERVAL 1 DAY) AS n_day, count(*) FILTER (ts > {AS_OF} - INTERVAL 7 DAY) AS n_week, count(*) FILTER (ts > {AS_OF} - INTERVAL 2 DAY) * 12 AS per_day_12 FROM events")
def window_rates(spark, sf_dir):
    now, ts = F.expr(AS_OF), F.col("ts")
    return table(spark, sf_dir, "events").agg(F.count("*").alias("n_total"), F.count_if(an.between(ts, now, "1 DAY")).alias("n_day"), F.count_if(an.between(ts, now, "7 DAY")).alias("n_week"), (F.count_if(an.between(ts, now, "2 DAY")) * 12).alias("per_day_12"))


@query(f"""WITH c AS (SELECT event_type, count(*) FILTER (ts > {AS_OF} - INTERVAL 7 DAY) AS now, count(*) FILTER (ts > {AS_OF} - INTERVAL 14 DAY AND ts <= {AS_OF} - INTERVAL 7 DAY) AS before FROM events GROUP BY event_type)
SELECT event_type, now, before, CASE WHEN before = 0 AND now > 0 THEN '(new)' WHEN before = 0 THEN '' WHEN now > before THEN printf('(+%.0f%%)', (now - before) / before * 100) WHEN now < before THEN printf('(%.0f%%)', (now - before) / before * 100) ELSE '(=)' END AS delta FROM c""")
def period_compare(spark, sf_dir):
    now, ts = F.expr(AS_OF), F.col("ts")
    c = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(an.between(ts, now, "7 DAY")).alias("now"), F.count_if(an.between(ts, now, "14 DAY", "7 DAY")).alias("before"))
    return c.withColumn("delta", ct.delta_text(F.col("now"), F.col("before")))


def _bucket_oracle(unit, n):
    last = f"date_trunc('{unit}', {AS_OF} + INTERVAL 36 HOUR)"
    return f"""WITH s AS (SELECT unnest(generate_series({last} - INTERVAL {n - 1} {unit}, {last}, INTERVAL 1 {unit})) AS b), e AS (SELECT date_trunc('{unit}', ts) AS b, count(*) FILTER (event_type = 'purchase') AS n_purchase, count(*) AS n FROM events GROUP BY 1)
SELECT strftime(s.b, '%Y-%m-%d %H:%M:%S') AS bucket, coalesce(n_purchase, 0) AS n_purchase, coalesce(n, 0) AS n FROM s LEFT JOIN e ON e.b = s.b"""


def _buckets(spark, sf_dir, unit, n):
    """Up to a day after the last event, so that there are empty buckets."""
    out = an.buckets(table(spark, sf_dir, "events"), "ts", unit, f"{AS_OF} + INTERVAL 36 HOUR", n, F.count_if(F.col("event_type") == "purchase").alias("n_purchase"), F.count("*").alias("n"))
    return out.withColumn("bucket", stamp("bucket"))


@query(_bucket_oracle("HOUR", 48))
def hour_buckets_zero_fill(spark, sf_dir):
    return _buckets(spark, sf_dir, "HOUR", 48)


@query(_bucket_oracle("DAY", 40))
def day_buckets(spark, sf_dir):
    return _buckets(spark, sf_dir, "DAY", 40)


@query("SELECT count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_orderkey) AS n_orders FROM lineitem")
def distinct_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(*[F.countDistinct(c).alias(n) for c, n in (("l_partkey", "n_parts"), ("l_suppkey", "n_suppliers"), ("l_orderkey", "n_orders"))])


@query("SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS n_{t}" for t in ("customer", "orders", "lineitem", "part", "supplier")))
def table_totals(spark, sf_dir):
    out = None
    for t in ("customer", "orders", "lineitem", "part", "supplier"):
        one = table(spark, sf_dir, t).agg(F.count("*").alias(f"n_{t}"))
        out = one if out is None else out.join(one)
    return out


@query("SELECT count(*) AS n, true AS known, count(*) FILTER (p_name <> '') AS n_named FROM part WHERE p_type LIKE '%COPPER%' OR p_size > 10")
def filtered_count(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_type LIKE '%COPPER%' OR p_size > 10").agg(F.count("*").alias("n"), F.lit(True).alias("known"), F.count_if(F.col("p_name") != "").alias("n_named"))


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 20")
def category_topk(spark, sf_dir):
    return an.top(table(spark, sf_dir, "part"), "p_type", 20, F.count("*").alias("n"))


@query(f"SELECT event_type, count(*) AS n FROM events WHERE ts > {AS_OF} - INTERVAL 26 HOUR AND value > 1 GROUP BY event_type")
def engine_last_hour(spark, sf_dir):
    return table(spark, sf_dir, "events").where(an.between(F.col("ts"), F.expr(AS_OF), "26 HOUR") & (F.col("value") > 1)).groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"""WITH c AS (SELECT count(DISTINCT user_id) FILTER (event_type = 'purchase') AS a, count(*) FILTER (event_type = 'view') AS done, count(*) FILTER (event_type = 'error') AS dead, count(*) AS n, count(*) FILTER (ts > {AS_OF} - INTERVAL 1 DAY) AS day FROM events)
SELECT round(a * 100.0 / done, 2)::DOUBLE AS yield_percent, round(done * 100.0 / (done + dead), 2)::DOUBLE AS success_percent, (10000000 - n) // day AS eta_days, CASE WHEN n >= 1000000 THEN printf('%.1fM', n / 1000000) WHEN n >= 10000 THEN (n // 1000) || 'K' WHEN n >= 1000 THEN printf('%.1fK', n / 1000) ELSE n::VARCHAR END AS n_short FROM c""")
def pipeline_kpis(spark, sf_dir):
    kind = F.col("event_type")
    c = table(spark, sf_dir, "events").agg(
        F.count_distinct(F.when(kind == "purchase", F.col("user_id"))).alias("a"), F.count_if(kind == "view").alias("done"), F.count_if(kind == "error").alias("dead"), F.count("*").alias("n"), F.count_if(an.between(F.col("ts"), F.expr(AS_OF), "1 DAY")).alias("day")
    )
    return c.select(an.percent(F.col("a"), F.col("done")).alias("yield_percent"), an.percent(F.col("done"), F.col("done") + F.col("dead")).alias("success_percent"), F.expr("(10000000 - n) div nullif(day, 0)").alias("eta_days"), ct.short_count(F.col("n")).alias("n_short"))


@query("WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type), m AS (SELECT max(n) AS m FROM c) SELECT event_type, repeat('█', (n * 8 // m)::INT) || repeat('░', 8 - (n * 8 // m)::INT) AS bar FROM c, m")
def count_format(spark, sf_dir):
    c = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return c.join(c.agg(F.max("n").alias("m"))).select("event_type", ct.bar(F.col("n"), F.col("m")).alias("bar"))


@query("SELECT event_id, user_id, event_id - coalesce(lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS delta FROM events")
def worker_delta(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.struct("ts", "event_id").alias("at"))
    return an.heartbeat_delta(e, "user_id", "at", "event_id").select("event_id", "user_id", "delta")


@query("WITH s AS (SELECT event_type, epoch(date_trunc('minute', ts))::BIGINT AS second, count(*) AS n FROM events GROUP BY 1, 2) SELECT event_type, second, (sum(n) OVER (PARTITION BY event_type ORDER BY second RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW))::BIGINT * 1 AS per_hour FROM s")
def sliding_rate(spark, sf_dir):
    s = table(spark, sf_dir, "events").groupBy("event_type", F.unix_timestamp(F.date_trunc("minute", "ts")).alias("second")).agg(F.count("*").alias("n"))
    return an.sliding_rate(s, "event_type", "second", "n", 3600).select("event_type", "second", "per_hour")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_hourly_counts(spark, sf_dir):
    out = streams.window_counts(table(spark, sf_dir, "events"), "1 hour")
    return out.select(stamp("start").alias("start"), "event_type", "n")


@query("WITH s AS (SELECT event_type, unnest(range(0, 5)) AS k, ts FROM events) SELECT strftime(date_trunc('minute', ts) - to_minutes(k::BIGINT), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM s GROUP BY 1, 2")
def stream_sliding_counts(spark, sf_dir):
    out = streams.window_counts(table(spark, sf_dir, "events"), "5 minutes", "1 minute")
    return out.select(stamp("start").alias("start"), "event_type", "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS end, count(*) AS n_beats FROM s GROUP BY user_id, k""")
def stream_sessions(spark, sf_dir):
    out = streams.sessions(table(spark, sf_dir, "events"), "user_id", "6 hours")
    return out.select("user_id", stamp("start").alias("start"), stamp("end").alias("end"), "n_beats")
