"""The job state machine as pure functions of a table and a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb import dims
from tallyweb.functions.contacts import permanent_error


def ago(as_of: Column, interval: str) -> Column:
    return as_of - F.expr(f"INTERVAL {interval}")


def fail(df: DataFrame, as_of: Column, most: int, error: str = "error_msg", attempts: str = "attempts", base_seconds: int = 30) -> DataFrame:
    """After a failure: one more attempt; dead at the most or on an error no retry mends, else failed; next try after base * 2^attempts so far."""
    dead = permanent_error(F.col(error)) | (F.col(attempts) + 1 >= most)
    wait = F.make_dt_interval(secs=(F.lit(base_seconds) * F.pow(F.lit(2), F.col(attempts))).cast("decimal(18,6)"))
    return df.withColumns({"next_attempt_at": as_of + wait, "status": F.when(F.coalesce(dead, F.lit(False)), F.lit("dead")).otherwise(F.lit("failed")), attempts: F.col(attempts) + 1})


def fail_search(df: DataFrame, as_of: Column, most: int = 5, attempts: str = "attempts", base_seconds: int = 30) -> DataFrame:
    """After a failed search: one more attempt; failed at the most, else new again, to be tried after base * 2^(attempts before)."""
    spent = F.col(attempts) + 1 >= most
    wait = F.make_dt_interval(secs=(F.lit(base_seconds) * F.pow(F.lit(2), F.col(attempts))).cast("decimal(18,6)"))
    return df.withColumns({"next_attempt_at": F.when(~spent, as_of + wait), "status": F.when(spent, F.lit("failed")).otherwise(F.lit("new")), attempts: F.col(attempts) + 1})


def first_of(df: DataFrame, key: str, condition: Column, n: int, *order: Column | str) -> DataFrame:
    """df with _hit: whether a row is one of the first n, by order and key, of those that satisfy a condition."""
    chosen = df.where(condition).orderBy(*order, key).limit(n).select(key, F.lit(True).alias("_hit"))
    return df.join(chosen, key, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def _changed(df: DataFrame, marked: DataFrame, **changes: Column) -> DataFrame:
    return marked.withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in changes.items()}).select(*df.columns)


def reset_stuck(df: DataFrame, as_of: Column, key: str, n: int = 200, interval: str = "5 MINUTES", at: str = "locked_at", to: str = "pending") -> DataFrame:
    """Up to n jobs that are held for too long go back, the longest held first."""
    return _changed(df, first_of(df, key, (F.col("status") == "processing") & (F.col(at) < ago(as_of, interval)), n, at), status=F.lit(to))


def heal_zombies(parents: DataFrame, children: DataFrame, as_of: Column, key: str, child_key: str, active: Column, n: int = 1000, interval: str = "10 MINUTES", at: str = "updated_at") -> DataFrame:
    """Up to n processing parents of that age without an active child are pending again, the oldest first."""
    idle = parents.where((F.col("status") == "processing") & (F.col(at) < ago(as_of, interval)))
    chosen = zombies(idle, children, key, child_key, active).orderBy(at, key).limit(n).select(key, F.lit(True).alias("_hit"))
    return _changed(parents, parents.join(chosen, key, "left").withColumn("_hit", F.coalesce("_hit", F.lit(False))), status=F.lit("pending"))


def heal_failed(df: DataFrame, as_of: Column, key: str, most: int = 10, n: int = 500, interval: str = "1 HOUR", at: str = "updated_at", attempts: str = "attempts") -> DataFrame:
    """Failed jobs of that age: dead if tried often enough; of the others up to n are new again, one attempt on, the oldest first."""
    old = (F.col("status") == "failed") & (F.col(at) < ago(as_of, interval))
    out = df.withColumn("status", F.when(old & (F.col(attempts) >= most), F.lit("dead")).otherwise(F.col("status")))
    return _changed(out, first_of(out, key, old & (F.col("status") == "failed"), n, at), status=F.lit("new"), **{attempts: F.col(attempts) + 1})


PERMANENT = "permanently dead: max resurrections reached"


def label_permanent(df: DataFrame, most: int = 15, error: str = "error_msg", attempts: str = "attempts") -> DataFrame:
    """Dead jobs that were tried so often are labelled; a null error stays, as it can't be compared."""
    hit = (F.col("status") == "dead") & (F.col(attempts) >= most) & ~F.col(error).like("permanently dead%")
    return df.withColumn(error, F.when(hit, F.lit(PERMANENT)).otherwise(F.col(error)))


def claim_jobs(df: DataFrame, as_of: Column, n: int, key: str, *order: Column | str, status: str = "pending", per: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(claimed, rest): the first n free jobs, of each value of per, are processing and picked now; all others as they are."""
    from tallyweb.operators.dedup import claim

    free = df.where(F.col("status") == status)
    chosen = claim(free, n, *order, key, per=per)
    claimed = chosen.withColumns({"status": F.lit("processing"), "picked_at": as_of})
    return claimed, df.join(chosen.select(key), key, "left_anti")


def push_back(df: DataFrame, pending: DataFrame, as_of: Column, most: int = 50_000, seconds: int = 60) -> DataFrame:
    """Queries wait a while where more jobs than that are pending; counted no further than needed."""
    if pending.limit(most + 1).count() <= most:
        return df
    return df.withColumns({"status": F.lit("pending"), "enqueue_at": as_of + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))})


def reset_stale(df: DataFrame, as_of: Column, interval: str, at: str, held: str = "processing", to: str = "pending") -> DataFrame:
    """Jobs held for too long go back."""
    stale = (F.col("status") == held) & (F.col(at) < ago(as_of, interval))
    return df.withColumn("status", F.when(stale, F.lit(to)).otherwise(F.col("status")))


def bury(df: DataFrame, as_of: Column, most: int, interval: str = "1 HOUR", at: str = "updated_at", attempts: str = "attempts") -> DataFrame:
    """Failed jobs that were tried often enough, long enough ago, are dead; the others of that age are new again."""
    old = (F.col("status") == "failed") & (F.col(at) < ago(as_of, interval))
    again = old & (F.col(attempts) < most)
    return df.withColumns({"status": F.when(again, F.lit("new")).when(old, F.lit("dead")).otherwise(F.col("status")), attempts: F.when(again, F.col(attempts) + 1).otherwise(F.col(attempts))})


def resurrectable(error: Column) -> Column:
    """Not one of the final errors; a null error is unknown, so it isn't either."""
    out = F.lit(True)
    for pattern in dims.FINAL_ERRORS:
        out = out & ~error.like(pattern)
    return out


def retry_due(df: DataFrame, as_of: Column, most: int, attempts: str = "attempts") -> DataFrame:
    due = (F.col("status") == "failed") & (F.col("next_attempt_at") <= as_of) & (F.col(attempts) < most)
    return df.withColumn("status", F.when(due, F.lit("pending")).otherwise(F.col("status")))


def completed_parents(children: DataFrame, parent: str, active: Column, results: Column) -> DataFrame:
    """Parents without an active child, and the sum of their children's results."""
    return children.groupBy(parent).agg(F.count_if(active).alias("_active"), F.sum(results).alias("result_count")).where("_active = 0").drop("_active")


def zombies(parents: DataFrame, children: DataFrame, key: str, child_key: str, active: Column) -> DataFrame:
    """Parents without any active child."""
    busy = children.where(active).select(F.col(child_key).alias(key))
    return parents.join(busy, key, "left_anti")


def dead_workers(df: DataFrame, as_of: Column, interval: str = "2 MINUTES", at: str = "last_heartbeat") -> DataFrame:
    return df.withColumn("status", F.when(F.col(at) < ago(as_of, interval), F.lit("dead")).otherwise(F.col("status")))


def resurrect(df: DataFrame, as_of: Column, most: int, n: int, key: str, interval: str = "1 HOUR", at: str = "updated_at", error: str = "error_msg", attempts: str = "attempts") -> DataFrame:
    """Up to n dead jobs, the longest dead first, whose errors may pass are pending again, one attempt on."""
    may = df.where((F.col("status") == "dead") & (F.col(attempts) < most) & (F.col(at) < ago(as_of, interval)) & resurrectable(F.col(error)))
    chosen = may.orderBy(at, key).limit(n).select(key, F.lit(True).alias("_chosen"))
    out = df.join(chosen, key, "left")
    return out.withColumns({"status": F.when(F.col("_chosen"), F.lit("pending")).otherwise(F.col("status")), attempts: F.when(F.col("_chosen"), F.col(attempts) + 1).otherwise(F.col(attempts))}).drop("_chosen").select(*df.columns)


def complete(parents: DataFrame, children: DataFrame, key: str, child_key: str, active: Column, results: Column) -> DataFrame:
    """Processing parents without an active child are completed, with their children's results."""
    done = completed_parents(children, child_key, active, results).select(F.col(child_key).alias("_done"), F.col("result_count").alias("_n"))
    out = parents.join(done, F.col(key) == F.col("_done"), "left")
    hit = F.col("_done").isNotNull() & (F.col("status") == "processing")
    return out.withColumns({"status": F.when(hit, F.lit("completed")).otherwise(F.col("status")), "result_count": F.when(hit, F.col("_n")).otherwise(F.col("result_count"))}).select(*parents.columns)


def guarded(df: DataFrame, change, condition: Column, least: int) -> DataFrame:
    """change(df) where at least so many rows satisfy the condition, else df."""
    return change(df) if df.where(condition).limit(least).count() >= least else df


def requeue(df: DataFrame, held: str = "error", to: str = "pending") -> DataFrame:
    return df.withColumn("status", F.when(F.col("status") == held, F.lit(to)).otherwise(F.col("status")))
