import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyweb.operators import analytics, dedup, jobs, keywords, listing, merge
from tallyweb.sources import exports, files, html
from tallyweb.streaming import streams

JOB = "url string, url_hash string, domain string, source string, status string, completed_at timestamp, raw_emails array<string>, raw_phones array<string>, raw_social map<string,string>, " + ", ".join(f"{c} string" for c in merge.NEWEST.values())


def job(k, domain="d.com", source="serp_result", status="completed", emails=None, phones=None, social=None, **texts):
    return (f"https://{domain}/{k}", f"h{k}", domain, source, status, dt.datetime(2024, 1, 1, k), emails, phones, social, *[texts.get(c) for c in merge.NEWEST])


def test_normalize(spark):
    rows = [
        job(1, emails=["a@x.com"], phones=["1", "2", "3"], social={"facebook": "f1", "twitter": "t"}, business_name="Old", city="Ubud"),
        job(2, emails=["a@x.com", "b@x.com"], phones=["3", "4"], social={"facebook": "f2"}, business_name="New"),
        job(3, status="failed", business_name="Never"),
        job(4, "bare.com"),
        job(5, "other.com", source="contact_page"),
    ]
    listings, emails, pairs, queued = merge.normalize(spark.createDataFrame(rows, JOB))
    got = {r["domain"]: r for r in listings.collect()}
    d = got["d.com"]
    assert (d["business_name"], d["city"], d["phone"], d["phones"], d["social_links"], d["url"]) == ("New", "Ubud", "3", ["1", "2", "3", "4"], {"facebook": "f2", "twitter": "t"}, "https://d.com/1")
    assert set(got) == {"d.com", "bare.com", "other.com"}
    assert sorted(r["email"] for r in emails.collect()) == ["a@x.com", "b@x.com"] and pairs.count() == 2
    assert {r["url"] for r in queued.collect()} == {f"https://bare.com{p}" for p in ("/contact", "/contact-us", "/about", "/about-us")}
    again = merge.normalize(spark.createDataFrame(rows[::-1], JOB))[0]
    assert sorted(map(str, again.collect())) == sorted(map(str, listings.collect()))


def test_one_page_round_trip(spark):
    texts = {c: f"v {c}" for c in merge.NEWEST}
    r = merge.normalize(spark.createDataFrame([job(1, phones=["+1", "+2", "+3"], emails=["e@x.com"], social={"instagram": "i"}, **texts)], JOB))[0].first()
    assert all(r[c] == f"v {c}" for c in merge.NEWEST) and r["phone"] == "+1" and r["phones"] == ["+1", "+2", "+3"]


def test_dedup(spark):
    t, n = spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("a", 2), ("b", 4), ("b", 3)], "k string, v int")
    assert [tuple(r) for r in dedup.insert_ignore(t, n, "k", "v").collect()] == [("b", 3)]
    assert tuple(dedup.insert_counts(t, n, "k", "v").first()) == (3, 1, 2)
    up = dedup.conditional_upsert(t, n.where("v <> 4"), "k", F.col("v") > 5)
    assert sorted(map(tuple, up.collect())) == [("a", 1), ("b", 3)]
    assert [r["k"] for r in dedup.claim(n, 1, "v").collect()] == ["a"]


def test_transitions(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    j = spark.createDataFrame([("timeout", 0), ("HTTP 404", 0), (None, 4)], "error_msg string, attempts int")
    rows = jobs.fail(j, now, 5).collect()
    assert [r["status"] for r in rows] == ["failed", "dead", "dead"] and rows[0]["next_attempt_at"] == dt.datetime(2024, 1, 2, 0, 0, 30)


def test_rates(spark):
    s = spark.createDataFrame([("a", 0, 60), ("a", 59, 1), ("a", 60, 1)], "k string, s long, n long")
    assert [r["per_hour"] for r in analytics.sliding_rate(s, "k", "s", "n").orderBy("s").collect()] == [3600, 3660, 120]


def test_requests():
    assert listing.page_number("x", 7) == 7 and listing.page_number("0", 7) == 7 and listing.page_number("3", 7) == 3
    assert listing.envelope(101, 1, 50)["total_pages"] == 3 and not listing.envelope(-1, 1, 50)["total_known"]
    for bad in ({}, {"ids": [1], "domain": "x"}, {"ids": list(range(1001))}, {"queries": []}):
        with pytest.raises(ValueError):
            listing.check_request(**bad)
    assert exports.provider_filter("gmail.com") == "gmail.com" and exports.provider_filter("my-mail.com") is None


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,Keyword,x\n1, Spa Bali \n2,spa bali,extra,more\n3,"yoga, ubud"\n4,\n')
    (tmp_path / "b.csv").write_text("plain one\nplain two,z\n")
    (tmp_path / "c.txt").write_text("# note\n\nA b\na B\nc\n")
    (tmp_path / "t.yaml").write_text("name: n\npattern: '{a} in {b}'\nvariables: {a: [x, y], b: [z]}\n")
    names = lambda f: sorted(r["keyword"] for r in files.read_keywords(spark, str(tmp_path / f)).collect())
    assert names("a.csv") == ["Spa Bali", "yoga, ubud"] and names("b.csv") == ["plain one", "plain two"] and names("c.txt") == ["A b", "c"]
    t = files.read_template(str(tmp_path / "t.yaml"))
    assert sorted(r["keyword"] for r in keywords.expand_template(spark, t["pattern"], t["variables"]).collect()) == ["x in z", "y in z"]
    assert files.expand_env("${A:-d} ${B:-e} ${C}", {"A": "", "B": "b"}) == "d b "
    df = spark.createDataFrame([('say "hi", you', 1)], "a string, b int")
    exports.write_csv(df, str(tmp_path / "out"))
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "out"), header=True, quote='"', escape='"').collect()] == [('say "hi", you', "1")]


def test_bodies(spark):
    rows = [(b"", None), ("héllo".encode(), "text/html; charset=utf-8"), (b"\xf9\xec\xe5\xed", "text/html; charset=windows-1255"), ("§ 2 Geschäft".encode("latin-1"), "text/html; charset=iso-8859-1"), (b'<meta charset="windows-1252">caf\xe9', None), ("ok é".encode(), "text/html; charset=bogus"), ("abc é".encode()[:-1], "text/html; charset=utf-8")]
    got = [r[0] for r in spark.createDataFrame(rows, "b binary, t string").coalesce(1).select(html.decode_column(F.col("b"), F.col("t"))).collect()]
    assert got == ["", "héllo", "שלום", "§ 2 Geschäft", '<meta charset="windows-1252">café', "ok é", "abc "]


def test_cards(spark):
    page = '<div class="result"><a class="business-name" href="/biz/1">One</a><div class="phones">1</div></div><div class="result"><a class="business-name" href="https://x.com/2">One</a></div>'
    rows = html.explode_cards(spark.createDataFrame([("https://www.yellowpages.com/s", page), ("https://other.com", page)], "url string, html string")).collect()
    assert [(r["card_name"], r["card_url"], r["card_phone"]) for r in rows] == [("One", "https://www.yellowpages.com/biz/1", "1"), ("One", "https://x.com/2", "")]
    meta = html.page_metadata('<meta property="og:title" content="T"><meta name="author" content="A"><div class="adr">12 Long Road, Town</div>')
    assert meta["name"] == "T" and meta["contact"] == "A" and meta["address"] == "12 Long Road, Town"


def test_streams(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = streams.read_events(spark, str(tmp_path / "in"), "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    got = streams.drain(streams.window_counts(stream, "1 day"), "daily", str(tmp_path / "c1"), "complete")
    want = streams.window_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "1 day")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 50
    assert streams.drain(streams.once(stream, "event_id"), "once", str(tmp_path / "c2")).count() == events.count()
    seen = []
    streams.each_batch(stream, lambda b, _: seen.append([r["event_id"] for r in b.limit(3).collect()]), str(tmp_path / "c3"), ("event_id",))
    assert seen[0] == sorted(seen[0])


def test_enrich_to_listings(spark):
    from tallyweb.operators import enrich

    html = '<title>Calm</title><meta property="og:description" content="A spa"><a href="https://instagram.com/calm">x</a> hello@calm.io +62 812 3456 789 <script type="application/ld+json">{"name":"Calm Spa","address":{"addressLocality":"Ubud","addressCountry":"ID"}}</script>'
    pages = spark.createDataFrame([("https://calm.io/?utm_source=x", html), ("https://bare.io/", None)], "url string, html string")
    jobs_done = enrich.enrich(pages, F.lit("2024-01-01").cast("timestamp"))
    listings, emails, _, queued = merge.normalize(jobs_done)
    r = listings.where("domain = 'calm.io'").first()
    assert (r["business_name"], r["city"], r["description"], r["phones"], r["social_links"]) == ("Calm Spa", "Ubud", "A spa", ["+628123456789"], {"instagram": "https://instagram.com/calm"})
    assert [e["email"] for e in emails.collect()] == ["hello@calm.io"] and {q["domain"] for q in queued.collect()} == {"bare.io"}
    checks = spark.createDataFrame([("hello@calm.io", "safe", True, True, True, False, False, False, False, False)], "email string, reachable string, syntax boolean, mx boolean, deliverable boolean, disposable boolean, role boolean, catch_all boolean, honeypot boolean, disabled boolean")
    v = enrich.verdicts(emails.select("email"), checks).first()
    assert (v["validation_status"], v["reason"], v["score"]) == ("valid", None, 1.0)
    found = enrich.discovered(spark.createDataFrame([("https://a.io/x",), ("https://A.io/x/",), ("https://www.yelp.com/x",), ("https://b.io/",)], "url string"), spark.createDataFrame([(1,)], "k int").select(F.lit("none").alias("url_hash")))
    assert sorted(r["domain"] for r in found.collect()) == ["a.io", "b.io"]


def test_more_transitions(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    old = dt.datetime(2024, 1, 1)
    j = spark.createDataFrame([(1, "dead", 3, old, "timeout"), (2, "dead", 3, old, "HTTP 404"), (3, "dead", 20, old, "timeout"), (4, "failed", 1, old, None)], "id int, status string, attempts int, updated_at timestamp, error_msg string")
    assert [(r["id"], r["status"], r["attempts"]) for r in jobs.resurrect(j, now, 15, 10, "id").orderBy("id").collect()] == [(1, "pending", 4), (2, "dead", 3), (3, "dead", 20), (4, "failed", 1)]
    p = spark.createDataFrame([(1, "processing", 0), (2, "processing", 0), (3, "completed", 9)], "q int, status string, result_count long")
    c = spark.createDataFrame([(1, "completed", 4), (1, "completed", 2), (2, "new", 0)], "pq int, s string, n int")
    assert sorted(map(tuple, jobs.complete(p, c, "q", "pq", F.col("s") == "new", F.col("n")).collect())) == [(1, "completed", 6), (2, "processing", 0), (3, "completed", 9)]
    assert jobs.guarded(j, lambda d: jobs.requeue(d, "failed"), F.col("status") == "failed", 2).where("status = 'failed'").count() == 1


def test_limits(spark):
    now, old = F.lit("2024-01-02 00:00:00").cast("timestamp"), dt.datetime(2024, 1, 1)
    rows = [(k, "processing", old + dt.timedelta(minutes=k), k) for k in range(4)] + [(9, "processing", dt.datetime(2024, 1, 2), 0)]
    j = spark.createDataFrame(rows, "id int, status string, locked_at timestamp, attempts int")
    assert sorted(r["id"] for r in jobs.reset_stuck(j, now, "id", 2).where("status = 'pending'").collect()) == [0, 1]
    c = spark.createDataFrame([(1, "new")], "q int, s string")
    p = j.withColumnRenamed("locked_at", "updated_at")
    assert sorted(r["id"] for r in jobs.heal_zombies(p, c, now, "id", "q", F.col("s") == "new", 2).where("status = 'pending'").collect()) == [0, 2]
    f = p.withColumn("status", F.lit("failed")).withColumn("attempts", F.col("attempts") * 4)
    healed = {r["id"]: (r["status"], r["attempts"]) for r in jobs.heal_failed(f, now, "id", 10, 2).collect()}
    assert healed == {0: ("new", 1), 1: ("new", 5), 2: ("failed", 8), 3: ("dead", 12), 9: ("failed", 0)}
    d = spark.createDataFrame([("dead", 15, "timeout"), ("dead", 14, "timeout"), ("dead", 20, None), ("dead", 20, "permanently dead: x")], "status string, attempts int, error_msg string")
    assert sorted(map(str, [r["error_msg"] for r in jobs.label_permanent(d).collect()])) == sorted([jobs.PERMANENT, "timeout", "None", "permanently dead: x"])
    s = jobs.fail_search(spark.createDataFrame([(0,), (3,), (4,)], "attempts int"), now).orderBy("attempts").collect()
    assert [(r["status"], r["attempts"]) for r in s] == [("new", 1), ("new", 4), ("failed", 5)] and s[0]["next_attempt_at"] == dt.datetime(2024, 1, 2, 0, 0, 30) and s[2]["next_attempt_at"] is None
    claimed, rest = jobs.claim_jobs(j, now, 2, "id", F.desc("locked_at"), status="processing")
    assert sorted(r["id"] for r in claimed.collect()) == [3, 9] and rest.count() == 3
    assert jobs.push_back(c, j, now, 4).first()["status"] == "pending" and jobs.push_back(c, j, now, 5).columns == c.columns


def test_dimensions(spark):
    from tallyweb import dims

    assert (len(dims.NICHES), len(dims.PERSONAL_NICHES), len(dims.SITE_TEMPLATES)) == (84, 60, 17)
    cities = spark.createDataFrame([("Ubud", "Indonesia"), ("Paris", "France")], "city string, country string")
    assert keywords.business_keywords(spark, cities, "France", "day spa").count() == len(keywords.OPERATORS)
    assert keywords.all_keywords(spark, cities).count() == 2 * (84 + 60) * (len(keywords.OPERATORS) + 17)
    with pytest.raises(ValueError):
        keywords.business_keywords(spark, cities, "Nowhere")


def test_mended_pages(spark):
    from pyspark.sql import Row

    from tallyweb.functions import contacts as ct
    from tallyweb.functions import urls as u
    from tallyweb.sources import results

    page = '<div class="g"><a href="https://a.io/">a</a><a href="/url?q=https%3A%2F%2Fb.io%2F">b</a></div><div class="yuRUbf"><div><span><a href="https://c.io/">c</a></span></div></div><div class="yuRUbf"><a href="https://no.io/">n</a></div>'
    found = results.search_results(spark.createDataFrame([("google", page), ("bing", None), ("other", page)], "engine string, html string")).collect()
    assert [(r["position"], r["url"]) for r in found] == [(1, "https://c.io/"), (2, "https://a.io/"), (3, "https://b.io/")]
    df = spark.createDataFrame([Row(url="https://x.io:8080/a?b")])
    assert [len(r[0]) for r in df.select(u.site_contact_pages(F.col("url"))).collect()] == [9] and df.select(u.plain_search_url(F.lit("a b"), F.lit(2), 10)).first()[0] == "https://www.google.com/search?q=a+b&num=10&start=20&hl=en"
    html = spark.createDataFrame([("<a href='/cdn-cgi/l/email-protection#543d3a323b142c7a3d3b'>x</a> <a href=tel:+1-202-555-0143>c</a>",)], "h string")
    assert html.select(ct.page_emails(F.col("h"))).first()[0] == ["info@x.io"] and html.select(ct.page_phones(F.col("h"))).first()[0][0] == "+12025550143"


def test_compose(spark):
    d = lambda c, *v: spark.createDataFrame([(x,) for x in v], f"{c} string")
    cities = spark.createDataFrame([("Ubud", "Indonesia"), ("Paris", "France")], "city string, country string")
    out = keywords.compose(d("n", "spa"), d("n", "coach"), cities, ("site:x.com %s %s",), "france")
    assert out.count() == 2 * len(keywords.OPERATORS) + 2 and out.where("keyword = 'site:x.com spa paris'").count() == 1
    with pytest.raises(ValueError):
        keywords.compose(d("n", "spa"), d("n", "coach"), cities, (), "nowhere")
    assert list(keywords.enabled_engines("bing, x")) == ["bing"] and len(keywords.enabled_engines("all")) == 3


def test_fleet(spark):
    w = spark.createDataFrame([("serp", "working", 2), ("serp", "dead", 9), ("enrich", "idle", 0)], "kind string, status string, delta int")
    assert sorted(map(tuple, analytics.fleet(w, "kind", "status", "delta").collect())) == [("enrich", 1, 0, 0, 0), ("serp", 1, 1, 1, 240)]
    df, seen = analytics.observed(w, "counters", n=F.count("*"))
    df.collect()
    assert seen.get["n"] == 3
    links = spark.createDataFrame([(1, "a@gmail.com"), (2, "b@x.org")], "id int, email string")
    listed = spark.createDataFrame([(1, "Bali", "", "", 5), (2, "", "Bali road", "", 6)], "id int, location string, address string, category string, created_at int")
    assert [r["emails"] for r in exports.chat_export(listed, links, "id", "email", "gmail").collect()] == ["a@gmail.com"]
    assert [r["emails"] for r in exports.chat_export(listed, links, "id", "email", "bali").collect()] == ["b@x.org", "a@gmail.com"]
