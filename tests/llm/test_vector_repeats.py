"""Repeated rows and repeated ids take no neighbour's place."""

import numpy as np

from tallyweb.llm import vector_search as vs
from tests.llm.test_vectors import brute, result, rows, table


def test_joined_to_itself(spark):
    data = rows(700)
    for n in (2, 10):
        assert result(vs.nearest(table(spark, data * n))) == brute(data)


def test_hot_id(spark):
    """One id with many vectors, all near to a query: it counts once, by its nearest."""
    data = rows(600)
    rng = np.random.default_rng(4)
    hot = [(7, [float(x) for x in np.array(data[100][1]) + 0.001 * rng.standard_normal(8)]) for _ in range(60)]
    data = [r for r in data if r[0] != 7] + hot
    best = {}
    for q, found in brute(data, k=1000).items():
        once = {}
        for i, d in found:
            once.setdefault(i, d)
        best[q] = list(once.items())[:10]
    assert result(vs.nearest(table(spark, data))) == best


def test_recall_beyond_the_sample(spark):
    """Production parameters, a table three times the sample."""
    data = rows(3 * vs.SAMPLE, 3)
    want, got = brute(data), result(vs.nearest(table(spark, data)))
    hits = sum(len(set(want[q]) & set(got[q])) for q in want)
    print("recall", hits / sum(map(len, want.values())))
    assert hits >= 0.95 * sum(map(len, want.values()))
