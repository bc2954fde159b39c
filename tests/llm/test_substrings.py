import hashlib
import re

import numpy as np
import pytest

from tallyweb.llm import substring_dedup as sd
from tests.llm import cases


def brute(rows, window=50):
    docs = [(d if d is not None else 2**63 - 1, d, re.findall(cases.WORD, t or "")) for d, t in rows]
    least = {}
    for key, _, w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, key), key)
    out = []
    for key, d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < key:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(docs):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in sd.removal_digest(docs).collect())


def passages():
    shared = [cases.prose(n, 50 + n) for n in (49, 50, 51, 60, 120, 300)]
    rows = []
    for k in range(40):
        a, b = cases.prose(30 + k, 500 + k), cases.prose(70, 900 + k)
        rows.append((k, f"{a} {shared[k % 6]} {b} {shared[(k * 5 + 1) % 6]}"))
    rows += [(50, "same " * 400), (51, "x " + "same " * 120), (52, "one two " * 200), (53, "two one " * 60)]
    return rows + [(60 + k, t) for k, t in enumerate(cases.texts())] + [(None, shared[4]), (None, shared[4] + " z"), (3, shared[5] + " other text of a repeated id")]


@pytest.mark.parametrize("most, words", [(2048, 1 << 16), (3, 500)])
def test_like_brute_force(spark, monkeypatch, most, words):
    monkeypatch.setattr(sd, "MAX_SEGMENTS", most)
    monkeypatch.setattr(sd, "INDEX_WORDS", words)
    docs = spark.createDataFrame(passages(), "doc_id long, text string").repartition(3)
    assert result(docs) == brute([tuple(r) for r in docs.collect()])


def test_awkward(spark):
    docs = cases.documents(spark, null_id=True)
    assert result(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sd.removal_digest(cases.empty(spark)).count() == 0


def test_index_against_search():
    rng = np.random.default_rng(4)
    pieces = [rng.integers(0, 6, rng.integers(5, 90)).astype(np.uint64) for _ in range(25)]
    index = sd.FMIndex(pieces, longest=32, window=5)
    queries = [rng.integers(0, 7, 200).astype(np.uint64) for _ in range(5)] + pieces
    least = index.least_by_run(np.arange(25))
    have = {}
    for k, p in enumerate(pieces):
        for i in range(len(p) - 4):
            have.setdefault(tuple(p[i : i + 5]), k)
    for q, runs in zip(queries, index.windows(queries), strict=True):
        want = [have.get(tuple(q[i : i + 5]), -1) for i in range(len(q) - 4)]
        assert [int(least[r]) if r >= 0 else -1 for r in runs] == want


def test_ranks():
    x = np.random.default_rng(1).integers(0, 11, 1000)
    w = sd.WaveletMatrix(x, 11)
    for s in range(11):
        at = np.arange(1001)
        assert (w.rank(np.full(1001, s), at) == np.concatenate([[0], np.cumsum(x == s)])).all()


def test_crowded_minimizers_by_join(spark, monkeypatch):
    """Many crowded minimizers are joined, few are sent along; both ways give the same."""
    docs = spark.createDataFrame(passages(), "doc_id long, text string")
    monkeypatch.setattr(sd, "MAX_SEGMENTS", 2)
    sent = result(docs)
    monkeypatch.setattr(sd, "CROWDED_KEYS", 0)
    assert sent == result(docs) == brute(passages())
