"""Quality rules, URL filters and source mixing."""

import re
from fractions import Fraction

from tallyweb.llm import quality_rules as qr
from tallyweb.llm import source_mixing as sm
from tallyweb.llm import url_filters as uf
from tests.llm import cases


def measures(text):
    t = text or ""
    w = re.findall(cases.WORD, t)
    seen, hit = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit |= {i + k for i in at for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(cases.WORD, x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def test_measures(spark):
    docs = cases.documents(spark, null_id=True)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted((r["doc_id"] is None, r["doc_id"], *(r[n] for n in names)) for r in qr.measure(docs).collect())
    assert got == sorted((r["doc_id"] is None, r["doc_id"], *measures(r["text"])) for r in docs.collect())


def test_policies_and_ablation(spark):
    marks = qr.ledger(cases.documents(spark))
    rows = marks.collect()
    for version, mask in qr.POLICIES.items():
        kept = {r["doc_id"] for r in qr.judge(marks, version).where("kept").collect()}
        assert kept == {r["doc_id"] for r in rows if r["failed_bits"] & mask == 0}
    found = {(r["policy"], r["rule"]): r for r in qr.ablation(marks).collect()}
    for (version, rule), r in found.items():
        mask, bit = qr.POLICIES[version], qr.BIT[rule]
        assert r["n_failed"] == sum(bool(x["failed_bits"] & bit) for x in rows)
        assert r["n_failed_alone"] == sum(x["failed_bits"] & mask == bit for x in rows)
        assert r["n_kept_without"] == sum(x["failed_bits"] & mask & ~bit == 0 for x in rows)
    assert qr.ledger(cases.empty(spark)).count() == 0


def test_urls(spark):
    link = "<head><link href='{}' rel='canonical'></head>"
    rows = [
        (1, "http://a.net/x", link.format("https://b.net/y")),
        (2, "https://b.net/y#top", '<META http-equiv="Refresh" content="0; url=//shop.com/de/1">'),
        (3, "https://shop.com/de/1", ""),
        (4, "https://free.net/", link.format("/other")),
        (5, "https://free.net/other", link.format("https://sub.EXAMPLE.org/es/1")),
        (6, "https://allowed.net/", link.format("https://any.org/")),
        (7, "https://allowed.net/2", link.format("https://allowed.net/")),
        (8, "http://q.net/", link.format("https://allowed.net/2")),
        (9, "ftp://x.COM/de/", None),
        (10, None, None),
        (11, "no scheme", ""),
        (12, "https://example.org/en/15?x#y", ""),
        (13, "https://notexample.org/en/15", ""),
        (1, "http://a.net/x", link.format("https://b.net/y")),
        (14, "https://z.net/", link.format("https://any.com/de/") + link.format("https://any.org/")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.judge_urls(pages).collect()}
    assert got[1] == ("a.net", "/x", None, "block") and got[2][3] == "block" and got[3][2:] == ("com/de/", "block")
    assert got[4][3] == got[5][3] == "block"
    assert got[6][3] == got[7][3] == got[8][3] == "allow"
    assert got[9] == ("x.com", "/de/", "com/de/", "block")
    assert got[10] == got[11] == ("", "", None, "allow")
    assert got[12][2:] == ("example.org/en/1", "block") and got[13][2:] == ("org/", "allow")
    assert got[14][3] == "allow"
    many = uf.RULES + [("block", f"h{k}.net/") for k in range(300)]
    joined = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.judge_urls(pages, many).collect()}
    assert joined == got
    assert uf.judge_urls(pages.limit(0)).count() == 0
    more = spark.createDataFrame([("http://q.net/", "http://x.com/de/9"), (None, "x")], "src string, dst string")
    assert {r["page_id"]: r["verdict"] for r in uf.judge_urls(pages, redirects=more, html=None).collect()}[8] == "block"


def sources_of(spark, sizes):
    return spark.createDataFrame([(f"={k:05}", n) for k, n in enumerate(sizes)], "_key string, size long")


def test_targets(spark):
    def targets(sizes, **how):
        found, total = sm.targets(sources_of(spark, sizes), **how)
        assert total == sum(sizes)
        return [r["target"] for r in found.orderBy("_source").collect()]

    t = targets([100, 100, 100, 10, 0])
    assert abs(sum(t) - 465) < 1e-9 and t[3] == 20 and t[4] == 0 and all(x <= 2 * s + 1e-9 for x, s in zip(t, [100, 100, 100, 10, 0]))
    assert targets([]) == [] and targets([0, 0]) == [0, 0]
    assert targets([1000, 1000]) == [2000.0, 1000.0] and abs(sum(targets([7, 9], share=Fraction(1))) - 16) < 1e-9
    assert targets([5, 7], share=Fraction(3)) == [10.0, 14.0]


def test_source_seats(spark):
    """Seats of all sources equal those that single highest quotients give."""
    import random

    rng = random.Random(2)
    tables = [[rng.choice([0, 1, 3, 40, rng.randrange(1, 5000)]) for _ in range(n)] for n in (1, 9, 300)]
    for sizes in [*tables, [7] * 50, [100_000] + [1] * 200, [0, 0]]:
        found, total = sm.targets(sources_of(spark, sizes))
        votes = [r["target"] for r in found.orderBy("_source").collect()]
        for block in (1, 16):
            caps, seats = [2 * -(-n // block) for n in sizes], int(1.5 * total / block + 0.5)
            for some in (seats, seats // 3, min(seats, 2)):
                got = sm.source_seats(found, 1.5 * total, some, block).orderBy("_source").collect()
                assert [r["_seats"] for r in got] == sm.sainte_lague(votes, some, caps)


def test_sainte_lague():
    def brute(votes, seats, caps):
        got = [0] * len(votes)
        for _ in range(seats):
            best = [(-v / (2 * g + 1), k) for k, (v, g, c) in enumerate(zip(votes, got, caps)) if g < c and v > 0]
            if best:
                got[min(best)[1]] += 1
        return got

    import random

    rng = random.Random(1)
    for _ in range(200):
        votes = [float(rng.choice([0, 1, 2, 3, 50, rng.randrange(1, 1000)])) for _ in range(rng.randrange(1, 8))]
        caps, seats = [rng.randrange(0, 40) for _ in votes], rng.randrange(0, 120)
        assert sm.sainte_lague(votes, seats, caps) == brute(votes, seats, caps)


def test_mix(spark):
    docs = cases.documents(spark, null_id=True)
    rows = sm.mix(docs).collect()
    sizes = sorted(len(re.findall(cases.WORD, r["text"] or "")) for r in docs.collect())
    assert sorted(r["size"] for r in rows) == sizes
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(x) - target) <= 0.02 * target + 8 for (_, target), x in by.items())
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, sm.mix(docs.repartition(7)).collect()), key=repr)
    mixed = sm.mixed_rows(docs, chars="n_chars")
    assert mixed.columns == docs.columns
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(cases.WORD, r["text"]))
        assert r["n_chars"] == len(r["text"])
    want = {}
    for r in rows:
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    assert {k: v for k, v in want.items() if v} == got
    assert sm.mix(cases.empty(spark)).count() == 0 and sm.mixed_rows(cases.empty(spark)).count() == 0


def test_resolve(spark):
    cases_ = [("y", "http://h.a/x/y"), ("./y", "http://h.a/x/y"), ("../y?q=1", "http://h.a/y?q=1"), ("../../../y", "http://h.a/y"), ("/y/./z/../w", "http://h.a/y/w"), ("?id=1", "http://h.a/x/p?id=1"), ("//o.b/c", "http://o.b/c"), ("https://o.b", "https://o.b"), ("#f", None), ("", None), ("mailto:a@b.c", None), ("..", "http://h.a/")]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("http://h.a/x/p?k#f", x, w) for x, w in cases_], "base string, link string, want string")
    assert [r[0] for r in df.select(uf.resolve(F.col("base"), F.col("link"))).collect()] == [w for _, w in cases_]


def test_canonical_forms(spark):
    rows = [
        (1, "http://x.com/de/y", ""),
        (2, "http://x.com/fr/p", ""),
        (3, "http://a.net/d/p", '<link rel="alternate canonical" href="../q">'),
        (4, "http://a.net/q", "<link href='http://x.com/de/y' rel='canonical'>"),
        (5, "http://b.net/", '<!-- <link rel="canonical" href="http://x.com/de/y"> -->'),
        (6, "http://c.net/", '<link rel="not-canonical" href="http://x.com/de/y"><link rel=stylesheet href="http://x.com/de/y">'),
        (7, "http://d.net/", '<meta http-equiv="refresh" content="0; url=http://x.com/de/y">'),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in uf.judge_urls(pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block"}


def test_mix_many_lines(spark, monkeypatch):
    """Many shards, many sources, and tables too large to broadcast come to the same runs."""
    docs = spark.createDataFrame([(k, cases.prose(5 + k * 7 % 90, k), None if k % 9 == 0 else "hot" if k % 3 else f"s{k}") for k in range(400)], "doc_id long, text string, source string")
    monkeypatch.setattr(sm, "SHARD_WORDS", 300)
    rows = sorted(map(tuple, sm.mix(docs).collect()))
    by = {}
    for r in sm.mix(docs).collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(x) / target - round(sum(x) / target)) < 0.1 for (_, target), x in by.items())
    monkeypatch.setattr(sm, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, sm.mix(docs.repartition(5)).collect())) == rows


def test_mix_copies(spark):
    """Rows with one id and one text share what the mix takes of them."""
    docs = spark.createDataFrame([(1, "a b c d e f", "x")] * 50 + [(2, cases.prose(500, 1), "y"), (None, None, "x"), (None, "", "x")], "doc_id long, text string, source string")
    rows = sm.mix(docs).where("doc_id = 1").collect()
    assert len(rows) == 50 and len({r["taken"] for r in rows}) == 1
    assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) < 4 * 50
    assert sm.mixed_rows(docs).where("doc_id = 1").count() == 50 * sum(x > 0 for x in (rows[0]["passes"], rows[0]["taken"] - rows[0]["passes"] * 6)) + 50 * max(0, rows[0]["passes"] - 1)


def test_mix_without_ids(spark):
    """Rows without an id, or with one id, are mixed alike on every run."""
    rows = [(None if k % 2 else 5, cases.prose(40, k), "a") for k in range(30)] + [(k, cases.prose(400, 100 + k), "b") for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted(map(str, sm.mixed_rows(docs.repartition(n, "text")).collect())) for n in (1, 3, 8)]
    assert runs[0] == runs[1] == runs[2]
