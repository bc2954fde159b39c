"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: words are [^\\x20\\x09-\\x0D]+ of the text with A-Z lowered, shingles are
3 consecutive words joined by one space (fewer words: the whole sequence), repeats
included; a bit is 1 if set in over half of the shingles' XXH64 (seed 42). No words:
fingerprint zero, which links like any other.

Search: the 64 bits are grouped into parts of correlated bits; each part i gets a
threshold t_i >= -1 with sum(t_i + 1) = radius + 1, so two fingerprints within the radius
agree on at least one part up to its threshold. A dynamic programme allots the
thresholds by the estimated number of candidates, from counts over all fingerprints.
Fingerprints that agree on a probed part meet in a bucket and are verified there.

Scale: equal fingerprints are one node. A bucket is verified inside one task only up to
bucket_rows fingerprints; any larger one (a popular part value, a ball of near copies) is
split by the same principle on its remaining bits, again and again, so no bucket is ever
gathered whole and no link is lost. A bucket returns spanning links, never its pairs.

Defined cases: null and empty texts have fingerprint zero and link to each other; rows
with a null id take no part in linking by id order but are returned with their
fingerprint's component; repeated rows are returned as often as they come; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweb.llm.common import Words, forget, steps, store
from tallyweb.llm.components import components, forest

RADIUS = 3
SEED = 42
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_ONES = np.array([bin(x).count("1") for x in range(1 << 16)], dtype=np.uint8)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of two uint64 arrays."""
    return np.bitwise_count(a ^ b) if hasattr(np, "bitwise_count") else sum(_ONES[((a ^ b) >> np.uint64(s)) & np.uint64(0xFFFF)] for s in (0, 16, 32, 48))


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The fingerprint of each run first[k]:first[k+1] of hashes."""
    out = np.zeros(len(first) - 1, dtype=np.uint64)
    sizes = np.diff(first)
    some = np.flatnonzero(sizes)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, first[:-1][some], axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * sums > sizes[some, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint_texts(texts: pa.Array, n: int = 3) -> np.ndarray:
    """uint64 fingerprints of a step's texts."""
    import xxhash

    grid = Words(texts)
    data, at = grid.joined(_LOWER[grid.data])
    ends = at + (grid.ends - grid.starts)
    count = np.diff(grid.first)
    shingles = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(shingles)])
    doc = np.repeat(np.arange(len(count)), shingles)
    begin = grid.first[:-1][doc] + np.arange(first[-1]) - first[:-1][doc]
    stop = begin + np.minimum(count[doc], n) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[a:b], SEED) for a, b in zip(at[begin].tolist(), ends[stop].tolist(), strict=True)), dtype=np.uint64, count=len(begin))
    return _majority(hashes, first)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", kind: str = "long") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. kind: the type of the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in steps(batch, "_text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprint_texts(texts).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast(kind).alias("doc_id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, f"doc_id {kind}, fp long")


def correlated_parts(moments: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits 0-63 in groups of 64 / parts; each group grows by the bit most correlated with it.

    moments[i, j]: number of fingerprints with both bits set; n: number of fingerprints.
    """
    p = np.diag(moments) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs((moments / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(r, 0)
    left, out = list(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (r[b, left].max() if len(left) > 1 else 0, -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (r[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def allot(costs: list[list[float]], units: int) -> list[int]:
    """Thresholds with the least cost: costs[i][u] is part i's cost at threshold u - 1, and the u add up to units."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        then: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for u, more in enumerate(row):
                if used + u <= units and (used + u not in then or cost + more < then[used + u][0]):
                    then[used + u] = (cost + more, [*chosen, u - 1])
        best = then
    return best[units][1]


def _bits(values: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(values), dtype=np.uint64)
    for k, b in enumerate(bits):
        out |= ((values >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _moments(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """Counts of every pair of bits over all fingerprints: a 64 x 64 matrix per task, summed by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 1 << 14):
                x = np.unpackbits(fps[at : at + (1 << 14)].astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += x.T @ x
            n += len(fps)
        if n:
            cells = np.append(total.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097, dtype=np.int32)), pa.array(cells.astype(np.int64))], names=["cell", "n"])

    rows = nodes.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # 4,097 rows
    flat = np.zeros(4097)
    for cell, n in rows:
        flat[cell] = n
    return flat[:4096].reshape(64, 64), int(flat[4096])


def _plan(nodes: DataFrame, radius: int, parts: int, bucket_rows: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each part that is probed."""
    moments, n = _moments(nodes)
    groups = correlated_parts(moments, n, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys = np.concatenate([(np.uint64(k) << np.uint64(56)) ^ _bits(fps, g) for k, g in enumerate(groups)])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(groups), dtype=np.int32), len(fps))), pa.array(keys.view(np.int64))], names=["part", "key"])

    counts = nodes.select("fp").mapInArrow(run, "part int, key long").groupBy("part", "key").agg(F.count("*").alias("c"))
    exact = {r["part"]: float(r["pairs"]) for r in counts.groupBy("part").agg(F.sum(F.col("c") * F.least("c", F.lit(bucket_rows))).alias("pairs")).collect()}
    p = np.diag(moments) / max(n, 1)
    costs = []
    for k, g in enumerate(groups):
        differ = 2 * p[g] * (1 - p[g])
        near = float((differ / np.maximum(1 - differ, 1e-3)).sum())  # pairs one bit apart for each pair that agrees, as if bits were independent
        row, probes, pairs = [0.0], 1.0, exact.get(k, 0.0)
        for t in range(radius + 1):
            row.append(50 * probes * n + pairs)  # a probe row costs some 50 verifications
            probes += np.prod([len(g) - i for i in range(t + 1)]) / np.prod(range(1, t + 2))
            pairs += exact.get(k, 0.0) * near ** (t + 1)
        costs.append(row)
    return [(g, t) for g, t in zip(groups, allot(costs, radius + 1), strict=True) if t >= 0]


def _variants(width: int, threshold: int) -> list[int]:
    """Masks of up to threshold differing bits among width."""
    from itertools import combinations

    return [sum(1 << b for b in c) for t in range(threshold + 1) for c in combinations(range(width), t)]


def _mix(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A 64-bit key of two."""
    x = (key ^ (more * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_KEYED = "key long, fp long, rep long, free long"


def _probe(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """A row for each key that a fingerprint is probed under; free: the bits that the key doesn't fix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                fps = batch.column(0).slice(at, 1 << 14).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                rep = batch.column(1).slice(at, 1 << 14)
                for k, (bits, threshold) in enumerate(plan):
                    value, free = _bits(fps, bits), ~np.uint64(sum(1 << b for b in bits))
                    for mask in _variants(len(bits), threshold):
                        keys = _mix(np.full(len(fps), k + 1, dtype=np.uint64), value ^ np.uint64(mask))
                        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fps.view(np.int64)), rep, pa.array(np.full(len(fps), free).view(np.int64))], names=["key", "fp", "rep", "free"])

    return nodes.select("fp", "rep").mapInArrow(run, _KEYED)


def _split(rows: DataFrame, radius: int) -> DataFrame:
    """Rows of a bucket that is too large, under radius + 1 keys that also fix a share of the free bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            free_all = table["free"].to_numpy().view(np.uint64)
            for free in np.unique(free_all):
                at = np.flatnonzero(free_all == free)
                bits = [b for b in range(64) if int(free) >> b & 1]
                for j in range(0, len(at), 1 << 14):
                    part = table.take(pa.array(at[j : j + (1 << 14)]))
                    fps, keys = part["fp"].to_numpy().view(np.uint64), part["key"].to_numpy().view(np.uint64)
                    for k in range(radius + 1):
                        own = bits[k :: radius + 1]
                        more = _mix(keys, (np.uint64(k + 1) << np.uint64(56)) ^ _bits(fps, own))
                        left = np.full(len(fps), free ^ np.uint64(sum(1 << b for b in own)))
                        yield pa.RecordBatch.from_arrays([pa.array(more.view(np.int64)), pa.array(fps.view(np.int64)), part["rep"].combine_chunks(), pa.array(left.view(np.int64))], names=["key", "fp", "rep", "free"])

    return rows.select("key", "fp", "rep", "free").mapInArrow(run, _KEYED)


def _verify(rows: DataFrame, radius: int) -> DataFrame:
    """Spanning links within each bucket; rows come partitioned and sorted by key, and a bucket fits in a block."""

    def links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> pa.RecordBatch | None:
        fp, found_a, found_b = fp.view(np.uint64), [], []
        held, at = 0, np.arange(len(key))
        for shift in range(1, len(key)):
            at = at[at + shift < len(key)]
            at = at[key[at] == key[at + shift]]  # runs are contiguous: who has no partner here has none further on
            if not len(at):
                break
            near = at[_distance(fp[at], fp[at + shift]) <= radius]
            near = near[rep[near] != rep[near + shift]]
            if len(near):
                found_a.append(rep[near])
                found_b.append(rep[near + shift])
                held += len(near)
            if held > 1 << 20:
                a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
                found_a, found_b, held = [a], [b], len(a)
        if not found_a:
            return None
        a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.empty(0, np.int64)] * 3
        for batch in batches:
            rest = [np.concatenate([x, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)]) for i, x in enumerate(rest)]
            if len(rest[0]) >= 1 << 15:
                cut = int(np.searchsorted(rest[0], rest[0][-1]))
                if cut and (out := links(*[x[:cut] for x in rest])):
                    yield out
                rest = [x[cut:] for x in rest]
        if len(rest[0]) and (out := links(*rest)):
            yield out

    return rows.repartition("key").sortWithinPartitions("key").select("key", "fp", "rep").mapInArrow(run, "a long, b long")


def near_links(nodes: DataFrame, radius: int = RADIUS, parts: int = 4, bucket_rows: int = 1024) -> DataFrame:
    """Links (a, b) between reps whose fingerprints are within the radius: enough to connect all that are.

    nodes: (fp long, rep long), each fp once.
    """
    found: DataFrame | None = None
    rows = _probe(nodes, _plan(nodes, radius, parts, bucket_rows))
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("_c"), F.bit_or("free").alias("_free"))
        heavy = store(sizes.where((F.col("_c") > bucket_rows) & (F.bit_count("_free") > F.lit(2 * radius + 2))).select("key"), "heavy")
        if heavy.isEmpty():
            new = _verify(rows, radius)
            return store(new if found is None else found.unionAll(new), "near")
        new = store(_verify(rows.join(heavy, "key", "left_anti"), radius), "near")
        found = new if found is None else found.unionAll(new)
        split = store(_split(rows.join(heavy, "key", "left_semi"), radius), "split")
        forget(heavy)
        forget(rows)
        rows = split


def simhash_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every document; component_id is the smallest doc_id reachable by links."""
    prints = store(fingerprints(docs, text, doc_id), "prints")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    grown = components(near_links(nodes.where("rep IS NOT NULL"), radius))
    named = nodes.join(grown, nodes["rep"] == grown["id"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """The first document, by id and a hash of its text, of each group of linked fingerprints, with all its columns.

    Rows that repeat an id and a text come once; rows of one id with unlike texts are judged by their texts; rows with a
    null id stay, all of them.
    """
    own = [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("_th")]
    known = docs.where(F.col(doc_id).isNotNull())
    prints = store(fingerprints(known.select(F.struct(*own).alias("_id"), F.col(text).cast("string").alias("_t")), "_t", "_id", "struct<doc_id:long,_th:long>"), "prints")
    nodes = store(prints.select("fp", F.col("fp").alias("rep")).distinct(), "nodes")
    grown = components(near_links(nodes, radius))
    named = nodes.join(grown, nodes["rep"] == grown["id"], "left").select("fp", F.coalesce("component", "rep").alias("_group"))
    best = store(prints.join(named, "fp").groupBy("_group").agg(F.min("doc_id").alias("_best")).select("_best.doc_id", "_best._th").distinct(), "best")
    forget(prints)
    forget(nodes)
    first = [F.col("doc_id").alias("_first"), F.col("_th").alias("_firsth")]
    kept = known.select("*", F.xxhash64(F.col(text).cast("string")).alias("_th")).join(best.select(*first), (F.col(doc_id).cast("long") == F.col("_first")) & (F.col("_th") == F.col("_firsth")), "left_semi")
    return kept.dropDuplicates([doc_id, "_th"]).select(*docs.columns).unionAll(docs.where(F.col(doc_id).isNull()))
