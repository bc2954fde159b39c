import re
from collections import Counter

import corpus_pipeline
from tallyweb.llm import line_dedup, quality_rules, simhash_dedup, source_mixing
from tallyweb.llm.common import store
from tests.llm import cases
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_native import measures
from tests.llm.test_simhash import brute as brute_simhash


def documents(spark):
    rows = []
    for k in range(30):
        a, b = cases.prose(90, k), cases.prose(60, 100 + k % 9)
        rows.append((k, f"{a}\n{b}", "en", f"s{k % 3}", 0))
    rows += [(40, rows[3][1], "en", "s0", 0), (41, rows[4][1].replace("1", "2", 1), "en", "s1", 0), (42, "too short", "en", None, 0), (43, None, None, None, None), (44, "## $$ " * 60, "x", "s1", 0), (45, cases.prose(80, 999), "en", None, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_against_plain_python(spark):
    docs = documents(spark)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    (_, quality), (_, lines), (_, near), (_, mixing), (_, tokens) = corpus_pipeline.STAGES

    # Each stage's rows are written and read again, as in production.
    one = store(quality(spark, docs, ""), "one")
    assert one.columns == docs.columns

    def good(t):
        n, chars, symbols, dup, again = measures(t)
        worded = [x for x in (t or "").split("\n") if re.search(cases.WORD, x)]
        return n >= 50 and 2 * again <= n and 10 * symbols <= n and 2 * (t or "").count("!") <= n and 2 * dup <= len(worded) and 2 * n <= chars <= 20 * n

    assert sorted(r["doc_id"] for r in one.collect()) == sorted(d for d, t in rows.items() if good(t))

    two = store(lines(spark, one, ""), "two")
    assert two.columns == docs.columns
    kept = {d: t for d, t in rows.items() if good(t)}
    gone = brute_lines(list(kept.items()))
    want = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in kept.items()}
    want = {d: t for d, t in want.items() if t.strip()}
    assert {r["doc_id"]: r["text"] for r in two.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) or r["n_chars"] in (0, 5) for r in two.collect())

    three = store(near(spark, two, ""), "three")
    assert three.columns == docs.columns
    first = {d for d, _, c in brute_simhash(list(want.items())) if d == c}
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(first)

    four = store(mixing(spark, three, ""), "four")
    assert four.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in source_mixing.mix(three).collect()}
    got = Counter()
    for r in four.collect():
        got[r["doc_id"]] += len(re.findall(cases.WORD, r["text"]))
    assert got == Counter({d: n for d, n in taken.items() if n})

    five = tokens(spark, four, "")
    assert five.count() == four.count()
    assert {r["decoded_sha256"] for r in five.collect()} == {__import__("hashlib").sha256(r["text"].encode()).hexdigest() for r in four.collect()}


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 50 and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_keep_rows_and_first(spark):
    docs = cases.documents(spark, null_id=True)
    kept = {r["doc_id"] for r in quality_rules.judge(quality_rules.ledger(docs)).where("kept").collect()}
    assert {r["doc_id"] for r in quality_rules.keep_rows(docs).collect()} == kept
    first = simhash_dedup.keep_first(docs)
    ids = [r["doc_id"] for r in first.collect()]
    assert len(ids) == len(set(ids)) and None in ids and 7 not in ids and first.columns == docs.columns
    for f in (quality_rules.keep_rows, simhash_dedup.keep_first, line_dedup.dedup_lines):
        assert f(cases.empty(spark)).count() == 0


def test_unlike_texts_of_one_id(spark):
    """Rows that share an id are told apart by their texts."""
    a, b, c = cases.prose(200, 71), cases.prose(200, 72), cases.prose(200, 73)
    docs = spark.createDataFrame([(1, a), (1, b), (0, b), (2, c), (2, c), (None, c)], "doc_id long, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash_dedup.keep_first(docs).collect()), key=repr)
    assert kept == sorted([(1, a), (0, b), (2, c), (None, c)], key=repr)
