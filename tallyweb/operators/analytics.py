"""Counts, rates, time buckets, comparisons, KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"))


def pivot_counts(df: DataFrame, status: str, values: list[str]) -> DataFrame:
    """One row: a count of each value, and the total."""
    return df.agg(*[F.count_if(F.col(status) == v).alias(f"n_{v.lower()}") for v in values], F.count("*").alias("n_total"))


def between(at: Column, as_of: Column, start: str, end: str | None = None) -> Column:
    """at lies after as_of - start (and not after as_of - end)."""
    out = at > as_of - F.expr(f"INTERVAL {start}")
    return out if end is None else out & (at <= as_of - F.expr(f"INTERVAL {end}"))


def buckets(df: DataFrame, at: str, unit: str, as_of: str, n: int, *counts: Column) -> DataFrame:
    """The last n hours or days up to as_of, each with its counts; 0 where nothing happened.

    The spine has n rows, so it is broadcast; the table is aggregated once, by equality.
    """
    spark = df.sparkSession
    last = F.date_trunc(unit, F.expr(as_of))
    spine = spark.range(1).select(F.explode(F.sequence(last - F.expr(f"INTERVAL {n - 1} {unit}"), last, F.expr(f"INTERVAL 1 {unit}"))).alias("bucket"))
    rows = df.where((F.col(at) >= last - F.expr(f"INTERVAL {n - 1} {unit}")) & (F.col(at) < last + F.expr(f"INTERVAL 1 {unit}")))
    own = rows.groupBy(F.date_trunc(unit, F.col(at)).alias("bucket")).agg(*counts)
    names = [c for c in own.columns if c != "bucket"]
    return spine.join(own, "bucket", "left").select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def top(df: DataFrame, key: str, n: int, *counts: Column) -> DataFrame:
    """The n keys with the greatest first count; ties by key."""
    own = df.groupBy(key).agg(*counts)
    return own.orderBy(F.desc(own.columns[1]), key).limit(n)


def heartbeat_delta(df: DataFrame, worker: str, at: str, counter: str) -> DataFrame:
    """Change of a counter since the worker's last heartbeat (the first: all of it)."""
    w = Window.partitionBy(worker).orderBy(at)
    return df.withColumn("delta", F.col(counter) - F.coalesce(F.lag(counter).over(w), F.lit(0)))


def sliding_rate(df: DataFrame, key: str, second: str, amount: str, seconds: int = 60) -> DataFrame:
    """Sum of the last seconds, as a rate per hour, for each key."""
    w = Window.partitionBy(key).orderBy(second).rangeBetween(-(seconds - 1), 0)
    return df.withColumn("per_hour", F.sum(amount).over(w) * F.lit(3600 // seconds))


def fleet(heartbeats: DataFrame, kind: str, status: str, delta: str) -> DataFrame:
    """Workers by kind: online, busy, dead, and the throughput per hour that 30-second deltas add up to."""
    online = F.col(status) != "dead"
    return heartbeats.groupBy(kind).agg(
        F.count_if(online).alias("n_online"), F.count_if(F.col(status) == "working").alias("n_busy"), F.count_if(~online).alias("n_dead"), (F.coalesce(F.sum(F.when(online, F.col(delta))), F.lit(0)) * 120).alias("per_hour")
    )


def snapshots(df: DataFrame, at: str, *counters: str) -> DataFrame:
    """Each snapshot's change from the one before. Snapshots are few (one a minute), so one order over all is small."""
    w = Window.orderBy(at)
    return df.withColumns({f"{c}_change": F.col(c) - F.lag(c).over(w) for c in counters})


def eta_days(total: Column, target: int, per_hour: Column) -> Column:
    """Whole days until the target at this rate; null without progress."""
    left, per_day = F.lit(target) - total, per_hour * 24
    return F.when((per_day > 0) & (left > 0), F.floor(left / per_day).cast("long"))


def observed(df: DataFrame, name: str, **counts: Column):
    """(df, observation): counters filled by whatever action runs df, without another pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen
