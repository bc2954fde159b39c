"""First-wins dedup, insert-ignore, conditional upsert, cascading delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Column | str, *order: Column | str) -> DataFrame:
    """One row per key, the first by order. min_by combines map-side, so a hot key costs no sort."""
    rows = df.select(F.struct(*df.columns).alias("_row"), (F.col(key) if isinstance(key, str) else key).alias("_key"), F.struct(*order).alias("_order"))
    best = rows.groupBy("_key").agg(F.min_by("_row", "_order").alias("_row"))
    return best.select("_row.*")


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of incoming that an INSERT ... ON CONFLICT DO NOTHING would add."""
    return first_wins(incoming, key, *order).join(target.select(key), key, "left_anti")


def insert_counts(target: DataFrame, incoming: DataFrame, key: str, *order: str) -> DataFrame:
    """(n_total, n_inserted, n_duplicate) in one row."""
    total = incoming.agg(F.count("*").alias("n_total"))
    added = insert_ignore(target, incoming, key, *order).agg(F.count("*").alias("n_inserted"))
    return total.join(added).withColumn("n_duplicate", F.col("n_total") - F.col("n_inserted"))


def conditional_upsert(target: DataFrame, incoming: DataFrame, key: str, replaceable: Column) -> DataFrame:
    """Full outer merge: new keys are added; an existing row is replaced only where replaceable (over target's columns) holds."""
    old = target.withColumn("_may", F.coalesce(replaceable, F.lit(False))).select(key, F.struct(*[c for c in target.columns if c != key]).alias("_old"), "_may")
    new = incoming.select(key, F.struct(*[c for c in target.columns if c != key]).alias("_new"))
    both = old.join(new, key, "full")
    row = F.when(F.col("_old").isNull() | (F.col("_may") & F.col("_new").isNotNull()), F.col("_new")).otherwise(F.col("_old"))
    return both.select(key, row.alias("_row")).select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in target.columns])


def cascade_delete(parents: DataFrame, children: DataFrame, doomed: DataFrame, key: str, child_key: str) -> tuple[DataFrame, DataFrame]:
    """Both tables without the doomed keys; what the children point at stays."""
    ids = doomed.select(F.col(key).alias("_gone")).distinct()
    return parents.join(ids, F.col(key) == F.col("_gone"), "left_anti"), children.join(ids, F.col(child_key) == F.col("_gone"), "left_anti")


def claim(df: DataFrame, n: int, *order: Column | str, per: str | None = None) -> DataFrame:
    """The first n rows by order, of each value of per."""
    if per is None:
        return df.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(per).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def seeded_order(key: str, seed: str) -> Column:
    """A random order that is the same on every run."""
    return F.sha2(F.concat(F.col(key).cast("string"), F.lit(":" + seed)), 256)
