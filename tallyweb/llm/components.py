"""Distributed connected components with DataFrame operations only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweb.llm.common import forget, store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    out = store(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
    forget(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = store(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = store(moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    forget(least)
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """(id, component) for every id that has a link; component is the smallest id reachable.

    Alternating large-star and small-star contraction. Each star is an aggregation with
    map-side combine, whose result is a table of its own, and an equi-join with it: both
    sides of the join are plain shuffles, which adaptive execution can split, so a hub of
    any degree is not left to one task. Links with a null end and loops are ignored;
    repeated links count once. Every round is a table in the shared folder.
    """
    now = store(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b"), "links")
    seen = None
    for _ in range(rounds):
        sums = now.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("s")).first()
        if sums["n"] == 0 or tuple(sums) == seen:
            break
        seen = tuple(sums)
        half = _large_star(now)
        forget(now)
        now = _small_star(half)
        forget(half)
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the graph with links a-b: each node to the least node of its component."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[out], nodes[label[out]]
