import pytest
from pyspark.sql import functions as F

from tallyweb.functions import contacts as ct
from tallyweb.functions import urls as u

CANONICAL = [
    ("https://example.com/path", "https://example.com/path"),
    ("https://example.com", "https://example.com/"),
    ("https://example.com/p#frag", "https://example.com/p"),
    ("HTTPS://EXAMPLE.com/Path", "https://example.com/Path"),
    ("https://example.com/a///", "https://example.com/a"),
    ("https://example.com/?q=b&a=1", "https://example.com/?a=1&q=b"),
    ("https://example.com/?msockid=1&gclid=2&ved=3&utm_source=x&keep=1", "https://example.com/?keep=1"),
    ("https://example.com/?__tn__=1&__xts__[0]=2&mc_x=1&_hsenc=2&pf_rd_r=3", "https://example.com/"),
    ("https://example.com/?twclid=1&s=20&t=abc", "https://example.com/?s=20&t=abc"),
    ("https://example.com/?trackingId=1&trackingid=2", "https://example.com/?trackingid=2"),
    ("https://example.com/?b=2&a=2&a=1&blank&c=a+b%20c", "https://example.com/?a=2&a=1&b=2&blank=&c=a+b+c"),
    ("https://user:Pw@Example.com:8080/x/", "https://user:Pw@example.com:8080/x"),
    ("::not a url", "::not a url"),
    ("https://example.com/?x=~*", "https://example.com/?x=~%2A"),
    (None, None),
]


def one(spark, values, f):
    rows = [(k, v) for k, v in enumerate(values)]
    return [r["y"] for r in spark.createDataFrame(rows, "k int, x string").select("k", f(F.col("x")).alias("y")).orderBy("k").collect()]


def test_canonical(spark):
    got = one(spark, [a for a, _ in CANONICAL], u.canonical_url)
    assert got == [b for _, b in CANONICAL]
    assert one(spark, got, u.canonical_url) == got  # twice is once


def test_hashes(spark):
    same = ["https://e.com/p", "https://E.com/p/", "https://e.com/p#x", "https://e.com/p?utm_source=y"]
    assert len(set(one(spark, same, u.hash_url))) == 1
    assert len(set(one(spark, ["https://e.com/p", "https://e.com/P", "http://e.com/p", "https://e.com/p?a=1"], u.hash_url))) == 4
    assert len(set(one(spark, [" Ab ", "ab", " AB\n"], u.hash_text))) == 1


def test_domain(spark):
    cases = {"https://WWW.Example.com:80/x": "www.example.com", "http://u@h.org": "h.org", "https://[::1]:8/": "::1", "::garbage::": "", "relative/path": "", "": ""}
    assert one(spark, list(cases), u.domain) == list(cases.values())


@pytest.mark.parametrize(
    "host, skip",
    [("www.yelp.com", True), ("mit.edu", True), ("x.gov.uk", True), ("forum.a.com", True), ("a.forum.b.com", True), ("help.x.io", True), ("www.apparelsupport.com", False), ("www.formulatrade.com", False), ("", False), ("localhost", False), ("127.0.0.1", False), ("edu", False)],
)
def test_skip_domain(spark, host, skip):
    assert one(spark, [host], u.skip_domain) == [skip]


def test_emails(spark):
    text = "Mail A.B@Shop.com, noreply@x.com; hello@example.com info@site.comview x@y.co a.b@shop.com " + "f" * 41 + "@z.com " + "0123456789abcdef0123456789@q.org"
    assert one(spark, [text], ct.find_emails) == [["a.b@shop.com", "x@y.co"]]
    got = spark.createDataFrame([(["Your@x.com", "a@test.com", "b@c.de", "B@C.de ", "no at", "testemail1@x.com"],)], "e array<string>").select(ct.filter_emails(F.col("e"))).first()[0]
    assert got == ["b@c.de"]
    assert one(spark, ["someone@x.org"], ct.mask_email) == ["s***@x.org"]


def test_phones(spark):
    got = spark.createDataFrame([(["+1 (830) 555-5433", "0812 3456 789", "1234567890", "+18305555433", "123", "+1234567890123456"],)], "p array<string>").select(ct.filter_phones(F.col("p"))).first()[0]
    assert got == ["+18305555433", "08123456789"]


def test_text_forms(spark):
    df = spark.createDataFrame([(999, 1), (1500, 1000), (25000, 25000), (3_400_000, 0), (0, 5)], "n int, b int")
    rows = df.select(ct.short_count(F.col("n")).alias("s"), ct.delta_text(F.col("n"), F.col("b")).alias("d"), ct.bar(F.col("n"), F.lit(3000)).alias("c")).collect()
    assert [r["s"] for r in rows] == ["999", "1.5K", "25K", "3.4M", "0"]
    assert [r["d"] for r in rows] == ["(+99800%)", "(+50%)", "(=)", "(new)", "(-100%)"]
    assert rows[1]["c"] == "████░░░░" and rows[4]["c"] == "░" * 8
    assert one(spark, ["a", 'a,"b"', "a\nb", "a\rb"], ct.csv_escape) == ["a", '"a,""b"""', '"a\nb"', "a\rb"]
