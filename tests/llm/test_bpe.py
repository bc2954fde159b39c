import base64
import hashlib
import struct

import public_tokenizers as P
import pytest
import tiktoken

from tallyweb.llm import byte_bpe
from tests.llm import cases

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(library, docs):
    text = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    want = []
    for i, t in text:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = sorted(tuple(r) for r in byte_bpe.round_trip(docs, PATH).collect())
    assert got == sorted(want)


def test_like_the_library(spark, library):
    check(library, cases.documents(spark))
    check(library, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_boundary_cases(spark, library):
    import itertools

    parts = ["a", "'", " ", "\n", "1", "!", "s", "re", "é", " "]
    texts = ["".join(x) for n in (1, 2, 3, 4) for x in itertools.product(parts, repeat=n)]
    texts = ["".join(texts[i :: 200]) for i in range(200)] + texts[:1500]
    check(library, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_every_code_point(spark, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(c) + chr(c) + "a" + chr(c) + "1" + chr(c) + "!" for c in points[i : i + 4096]) for i in range(0, len(points), 4096)]
    check(library, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_long_runs(spark, library):
    texts = ["x" * 30000, " " * 5000 + "y", "!" * 7000, "ab" * 4000, "日" * 3000, "\n" * 999]
    check(library, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_encode_decode(spark):
    docs = cases.documents(spark)
    back = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH).collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert byte_bpe.round_trip(cases.empty(spark), PATH).count() == 0
