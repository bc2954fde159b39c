import hashlib
import random
import re

from tallyweb.llm import secret_scan as ss
from tests.llm import cases

KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}


def brute(text):
    spans = []
    for order, (kind, (regex, group, least)) in enumerate(KINDS.items()):
        for m in regex.finditer(text or ""):
            if len(m[group]) >= least:
                spans.append((m.start(), order, kind, m.end()))
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
    return (*(sum(k == x[2] for x in spans) for k in KINDS), hashlib.sha256(joined.encode()).hexdigest())


def check(docs):
    found = ss.digest(ss.find_secrets(docs)).collect()
    want = sorted((r["doc_id"], *brute(r["text"])) for r in docs.collect())
    assert sorted((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in found) == want
    return found


def test_whole_tables(spark):
    check(cases.documents(spark))
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert ss.digest(ss.find_secrets(cases.empty(spark))).count() == 0


def test_mixtures(spark):
    rng = random.Random(3)
    bits = ["password", "PassWD", "secret", "to", "ken", "token", "api_key", "APIKEY", "api", "_", "'", '"', " ", ":", "=", "abcdefgh", "x" * 7, "AKIA", "ABCDEF0123456789", "0123456789abcdef", "deadbeef" * 4, "é", "ſecret", "\n", "K", "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_more_kinds(spark):
    texts = ["x ghp_" + "a1B2" * 9 + " y", "-----BEGIN EC PRIVATE KEY-----", "xoxb-1234567890-abc", "AIza" + "x" * 35, "sk_live_" + "9" * 20, "eyJabcdefghij.abcdefghij.abcdefghij", "clean text"]
    found = {r["doc_id"]: r["spans"] for r in ss.digest(ss.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    assert [found[k].split(":")[0] for k in range(7)] == ["github", "private", "slack", "google", "stripe", "jwt", ""]


def test_queries():
    by_kind = {r.kind: ss.trigram_query(r) for r in ss.RULES}
    assert by_kind["hex"] is None
    assert ss._trigrams(by_kind["access"]) == {"aki", "kia"}
    assert {"pas", "tok", "sec", "pik", "pi_"} <= ss._trigrams(by_kind["assign"])
    assert all(by_kind[k] is not None for k in by_kind if k != "hex")
    assert ss.redact("a secret b", [(2, 8)]) == "a [secret] b"


def test_bytes_that_are_no_utf8(spark):
    docs = spark.range(1).selectExpr("id AS doc_id", "cast(concat(X'FF80', cast(' password=hunter2hunter2' AS binary)) AS string) AS text")
    assert ss.digest(ss.find_secrets(docs)).first()["n_assign"] == 1
