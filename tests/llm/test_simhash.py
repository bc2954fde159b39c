import re

import numpy as np
import xxhash

from tallyweb.llm import simhash_dedup as sd
from tests.llm import cases


def brute(rows):
    def fp(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(cases.WORD, low)
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    out = [(i, fp(t)) for i, t in rows]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, a in out:
        for j, b in out:
            if i < j and (a ^ b).bit_count() <= 3:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, f, find(i)) for i, f in out)


def result(df):
    return sorted((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in df.collect())


def test_matches_brute_force(spark):
    docs = cases.documents(spark)
    assert result(sd.simhash_components(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_sf(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(sd.simhash_components(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty(spark):
    assert sd.simhash_components(cases.empty(spark)).count() == 0
    assert sd.keep_first(cases.empty(spark)).columns == cases.empty(spark).columns


def test_null_id(spark):
    assert sd.simhash_components(cases.documents(spark, null_id=True)).count() == len(cases.texts()) + 2


def test_links_in_large_buckets(spark):
    """Balls of near fingerprints, larger than a bucket may be: same components as all pairs give."""
    rng = np.random.default_rng(5)
    fps = set()
    for _ in range(6):
        centre = int(rng.integers(0, 2**63))
        for _ in range(80):
            x = centre
            for b in rng.choice(64, size=int(rng.integers(0, 9)), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    nodes = spark.createDataFrame([(x, k) for k, x in enumerate(signed)], "fp long, rep long").repartition(4)
    want = list(range(len(fps)))
    adjacent = [[j for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3] for i in range(len(fps))]
    for _ in range(len(fps)):
        new = [min(want[j] for j in adjacent[i]) for i in range(len(fps))]
        if new == want:
            break
        want = new
    from tallyweb.llm.components import components

    got = {r["id"]: r["component"] for r in components(sd.near_links(nodes, bucket_rows=12)).collect()}
    assert [got.get(k, k) for k in range(len(fps))] == want


def test_allot():
    assert sd.allot([[0, 5, 50, 500, 999]] * 4, 4) == [0, 0, 0, 0]
    assert sd.allot([[0, 1000, 9999, 9999, 9999], [0, 1, 2, 9999, 9999], [0, 1, 500, 9999, 9999], [0, 1, 500, 9999, 9999]], 4) == [-1, 1, 0, 0]
