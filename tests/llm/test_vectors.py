import numpy as np

from tallyweb.llm import vector_search as vs


def brute(rows, k=10):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v) and len(v) == 8]
    out = {}
    for q, x in good:
        if q % 100 == 0:
            best = sorted({(float(vs.exact(v[None, :], x)[0]), i) for i, v in good if i != q})[:k]
            out[q] = [(i, d) for d, i in best]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def rows(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, 8)) * 2
    out = [(k, [float(x) for x in centres[rng.integers(20)] + rng.standard_normal(8)]) for k in range(n)]
    hot = out[5][1]
    return [(k, hot) if k % 3 == 0 else (k, v) for k, v in out]


SCHEMA = "vec_id long, embedding array<double>, v string, list int"


def table(spark, data):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in data], SCHEMA).repartition(4)


def test_small_is_exact(spark):
    data = rows(700) + [(1000, None), (1100, []), (1200, [0.0] * 8), (1300, [1.0, None] * 4), (1400, [float("nan")] * 8), (1500, [float("inf")] * 8), (1600, [1.0] * 3), (None, [1.0] * 8)]
    assert result(vs.nearest(table(spark, data))) == brute(data)


def test_recall(spark):
    data = rows(6000, 2)
    want, got = brute(data), result(vs.nearest(table(spark, data), sample=800, block_rows=300))
    assert want.keys() == got.keys() and all(len(x) == 10 for x in got.values())
    hits = sum(len(set(want[q]) & set(got[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_few_and_none(spark):
    data = [(0, [1.0] * 8), (1, [2.0] * 8), (2, [2.0] * 8)]
    assert result(vs.nearest(table(spark, data))) == brute(data)
    assert vs.nearest(table(spark, data).limit(0)).count() == 0
    assert vs.nearest(table(spark, [(0, None)])).count() == 0


def test_recall_in_64_dimensions(spark):
    """Several column blocks, so candidates are abandoned early; the sample is a tenth of the table."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((30, 64))
    data = [(k, [float(x) for x in centres[rng.integers(30)] + 0.4 * rng.standard_normal(64)]) for k in range(4000)]
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in data], SCHEMA).repartition(4)
    good = np.array([v for _, v in data])
    want = {q: np.argsort(((good - good[q]) ** 2).sum(1), kind="stable")[1:11].tolist() for q in range(0, 4000, 100)}
    got = result(vs.nearest(docs, sample=400, block_rows=300))
    assert all(len(x) == 10 for x in got.values())
    hits = sum(len(set(want[q]) & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
