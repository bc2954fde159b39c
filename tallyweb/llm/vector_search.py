"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Index: equal rows are made one. Centroids are fitted on a bounded sample (SAMPLE vectors,
chosen by a hash of id and vector); every vector goes to the list of its nearest centroid. A list is cut into blocks of
about BLOCK_ROWS vectors by a hash of the id, so a hot list (a third of all vectors may be
equal) is spread over many tasks. The number of lists probed is the least that covers
TARGET of the true neighbours within the sample.

Scan: vectors are rotated by a random orthogonal matrix, whose columns are read in blocks;
after each block a hypothesis test on the partial distance, scaled to all dimensions,
abandons the candidates that are farther than the query's current bound almost surely.
Each query starts with a bound from the sample, whose nearest vectors are candidates too.
Survivors get their exact distance, in double precision on the original vectors.

Scale: nothing that grows with the table is broadcast; a task holds one block of vectors
and streams the queries that probe it. Per block and query at most k rows go on.

Defined cases: vectors that are null, zero, of another length than most, or that hold null
or non-finite components take no part; rows with a null id take no part; rows that repeat
an id count once as neighbours of a query and not at all for that id; ties go to the
smaller id; fewer than k candidates are all returned; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyweb.llm.common import store

K = 10
SAMPLE = 8192
BLOCK_ROWS = 4096
MAX_LISTS = 4096
TARGET = 0.98
COLUMNS = 16
#: Width of the hypothesis test: a candidate is abandoned wrongly with a chance of about exp(-EPSILON^2).
EPSILON = 2.1


def _matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors that take part, as doubles; their rows)."""
    flat = column.flatten()
    lengths = np.array(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False), dtype=np.int64)
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    values = np.array(flat.fill_null(float("nan")).to_numpy(zero_copy_only=False), dtype=np.float64)
    rows = np.flatnonzero(lengths == size)
    out = values[starts[rows, None] + np.arange(size)] if len(rows) else np.empty((0, size))
    good = np.isfinite(out).all(axis=1) & (out != 0).any(axis=1)
    return out[good], rows[good]


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :], 0)


def exact(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distances of the rows of a to q, summed in the order of the dimensions."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        x = a[:, d] - q[d]
        total += x * x
    return np.sqrt(total)


def _centroids(sample: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    distinct = np.unique(sample, axis=0)
    lists = min(lists, len(distinct))
    out = distinct[rng.choice(len(distinct), lists, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([_squared(sample[i : i + 2048], out).argmin(1) for i in range(0, len(sample), 2048)])
        sums = np.zeros_like(out)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=lists)
        out[n > 0] = sums[n > 0] / n[n > 0, None]
    return out


class Index:
    """Centroids, the sample with its ids, the rotation and the number of lists to probe."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, total: int, k: int, seed: int):
        rng = np.random.default_rng(seed)
        self.size = sample.shape[1]
        self.ids, self.sample, self.k = ids, sample, k
        self.repeats = len(np.unique(ids)) < len(ids)
        self.centroids = _centroids(sample, max(1, min(MAX_LISTS, round(total**0.5))), rng)
        self.rotation = np.linalg.qr(rng.standard_normal((self.size, self.size)))[0]
        own = rng.choice(len(sample), min(512, len(sample)), replace=False)
        near = np.concatenate([_squared(sample[i : i + 2048], self.centroids).argmin(1) for i in range(0, len(sample), 2048)])
        d = _squared(sample[own], sample)
        d[np.arange(len(own)), own] = np.inf
        best = np.argsort(d, axis=1)[:, :k]
        rank = np.argsort(np.argsort(_squared(sample[own], self.centroids), axis=1), axis=1)
        needed = np.sort(np.take_along_axis(rank, near[best], 1).ravel()) + 1
        self.probes = int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))) - 1)]) if len(needed) else 1

    def lists(self, x: np.ndarray, n: int) -> np.ndarray:
        d = _squared(x, self.centroids)
        return np.argsort(d, axis=1, kind="stable")[:, :n]

    def seeds(self, vec_id: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sample's k nearest ids to q but for vec_id, each once: ids and exact distances, nearest first."""
        d = _squared(self.sample, q[None, :])[:, 0]
        d[self.ids == vec_id] = np.inf
        if self.repeats:
            order = np.lexsort((d, self.ids))
            d[order[1:][self.ids[order[1:]] == self.ids[order[:-1]]]] = np.inf  # an id's nearest vector stands for it
        k = min(self.k, int(np.isfinite(d).sum()))
        if not k:
            return np.empty(0, np.int64), np.empty(0)
        worst = np.partition(d, k - 1)[k - 1]
        at = np.flatnonzero(d <= worst * (1 + 1e-9) + 1e-12)
        own = exact(self.sample[at], q)
        order = np.lexsort((self.ids[at], own))[:k]
        return self.ids[at][order], own[order]


def scan(block: np.ndarray, rotated: np.ndarray, q: np.ndarray, turned: np.ndarray, bound: float) -> np.ndarray:
    """Rows of a block that may be within bound of q; turned: q rotated as the block is."""
    size = len(q)
    alive = np.arange(len(block))
    partial = np.zeros(len(block))
    limit = bound * bound * (1 + 1e-9) + 1e-12
    for at in range(0, size, COLUMNS):
        part = rotated[alive, at : at + COLUMNS] - turned[at : at + COLUMNS]
        partial = partial + (part * part).sum(axis=1)
        d = min(at + COLUMNS, size)
        stay = partial * (size / d) <= limit * (1 + EPSILON / d**0.5) ** 2 if d < size else partial <= limit
        alive, partial = alive[stay], partial[stay]
        if not len(alive):
            break
    return alive


def _rows(vectors: DataFrame, index: Index) -> DataFrame:
    """(list, vec_id, v) of all vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x, rows = _matrix(part.column(1), index.size)
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(index.lists(x, 1)[:, 0].astype(np.int32)), part.column(0).take(pa.array(rows)), pa.array(list(x), type=pa.list_(pa.float64()))], names=["list", "vec_id", "v"])

    return vectors.mapInArrow(run, "list int, vec_id long, v array<double>")


def _probes(queries: DataFrame, index: Index, blocks: np.ndarray, found: bool) -> DataFrame:
    """found: the sample's nearest of each query; else (list, block, query_id, v, bound) for each block that a query probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                x, rows = _matrix(part.column(1), index.size)
                ids = part.column(0).take(pa.array(rows)).to_numpy(zero_copy_only=False)
                seeds = [index.seeds(i, q) for i, q in zip(ids, x, strict=True)]
                if found:
                    n = [len(s[0]) for s in seeds]
                    if sum(n):
                        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(np.concatenate([s[0] for s in seeds])), pa.array(np.concatenate([s[1] for s in seeds]))], names=["query_id", "vec_id", "score"])
                    continue
                for i, q, (_, d), lists in zip(ids, x, seeds, index.lists(x, index.probes) if len(x) else [], strict=True):
                    bound = float(d[-1]) if len(d) == index.k else float("inf")
                    own = np.repeat(lists, blocks[lists])
                    block = np.concatenate([np.arange(blocks[k]) for k in lists])
                    if len(own):
                        n = len(own)
                        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(np.full(n, i)), pa.array([q] * n, type=pa.list_(pa.float64())), pa.array(np.full(n, bound))], names=["list", "block", "vec_id", "v", "bound"])

    return queries.mapInArrow(run, "query_id long, vec_id long, score double" if found else "list int, block int, vec_id long, v array<double>, bound double")


def _search(rows: DataFrame, index: Index) -> DataFrame:
    """rows: (list, block, vec_id, v, bound), sorted so that a block's vectors (bound null) come before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, int] | None = None
        held: list[np.ndarray] = []
        held_ids: list[np.ndarray] = []
        block = rotated = ids = None
        for batch in batches:
            lists, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vec = batch.column(2).to_numpy()
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, index.size)
            query = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            bounds = batch.column(4).fill_null(0).to_numpy()
            edges = np.flatnonzero((np.diff(lists) != 0) | (np.diff(parts) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(lists)], strict=True):
                if a == b:
                    continue
                key = (int(lists[a]), int(parts[a]))
                if key != now:
                    now, held, held_ids, block = key, [], [], None
                if not query[a]:
                    held.append(x[a:b].copy())
                    held_ids.append(vec[a:b].copy())
                    block = None
                    continue
                if not held:
                    continue
                if block is None:
                    block, ids = np.concatenate(held), np.concatenate(held_ids)
                    rotated = block @ index.rotation
                turned = x[a:b] @ index.rotation
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for j in range(a, b):
                    alive = scan(block, rotated, x[j], turned[j - a], bounds[j])
                    alive = alive[ids[alive] != vec[j]]
                    if len(alive):
                        d = exact(block[alive], x[j])
                        order = np.lexsort((ids[alive], d))
                        order = order[d[order] <= bounds[j]]
                        order = order[np.sort(np.unique(ids[alive][order], return_index=True)[1])][: index.k]
                        out.append((np.full(len(order), vec[j]), ids[alive][order], d[order]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "query_id long, vec_id long, score double")


def fit(vectors: DataFrame, k: int = K, sample: int = SAMPLE, seed: int = 11) -> Index | None:
    """An index fitted on a bounded sample of (vec_id, v)."""
    sizes = vectors.where("v IS NOT NULL AND size(v) > 0").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return None
    drawn = vectors.where(F.size("v") == sizes["n"]).orderBy(F.xxhash64("vec_id", "v", F.lit(seed)), "vec_id").limit(sample).collect()
    x, rows = _matrix(pa.array([r["v"] for r in drawn], type=pa.list_(pa.float64())), sizes["n"])
    if not len(rows):
        return None
    return Index(np.array([drawn[i]["vec_id"] for i in rows], dtype=np.int64), x, sizes["count"], k, seed)


def nearest(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", queries: str = "vec_id % 100 = 0", k: int = K, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that queries selects, among all other rows."""
    vectors = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id IS NOT NULL").dropDuplicates(["vec_id", "v"])
    vectors = store(vectors, "vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    index = fit(vectors, k, sample, seed)
    if index is None:
        return table.sparkSession.createDataFrame([], schema)
    listed = store(_rows(vectors, index), "lists")
    counts = np.zeros(len(index.centroids), dtype=np.int64)
    for r in listed.groupBy("list").count().collect():  # MAX_LISTS rows at most
        counts[r["list"]] = r["count"]
    blocks = -(-counts // block_rows)
    asked = listed.where(queries).select("vec_id", "v").dropDuplicates(["vec_id"])
    cut = F.element_at(F.array(*[F.lit(int(max(1, b))) for b in blocks]), F.col("list") + 1)
    stored = listed.select("list", F.pmod(F.xxhash64("vec_id"), cut).cast("int").alias("block"), "vec_id", "v", F.lit(None).cast("double").alias("bound"))
    both = stored.unionAll(_probes(asked, index, blocks, found=False)).repartition("list", "block").sortWithinPartitions("list", "block", F.col("bound").isNotNull())
    found = _search(both, index).unionAll(_probes(asked, index, blocks, found=True)).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
