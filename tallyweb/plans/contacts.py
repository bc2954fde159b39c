"""Queries over contact data and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweb import dims
from tallyweb.functions import contacts as ct
from tallyweb.operators.jobs import resurrectable
from tallyweb.plans.registry import query, rows, sql_values, table

_IN = lambda values: ", ".join(f"'{v}'" for v in values)
_EMAILS = rf"""SELECT doc_id, i, e FROM (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS e FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '{ct.EMAIL}'), lambda x: lower(x)) AS l FROM documents))
 WHERE NOT (contains(e, 'noreply@') OR contains(e, 'no-reply@') OR contains(e, 'error-tracking')) AND regexp_extract(e, '@([^@]*)$', 1) NOT IN ({_IN(dims.BLOCKED_EMAIL_DOMAINS)}) AND length(split_part(e, '@', 1)) <= 40 AND regexp_extract(e, '\.([^.]*)$', 1) IN ({_IN(dims.TLDS)})"""


@query(f"WITH f AS ({_EMAILS}) SELECT doc_id, e AS email, split_part(e, '@', 1) AS local_part, split_part(e, '@', 2) AS domain FROM f GROUP BY doc_id, e")
def email_extract_clean(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(ct.filter_emails(ct.find_emails(F.col("text")))).alias("email"))
    return found.select("doc_id", "email", F.split_part("email", F.lit("@"), F.lit(1)).alias("local_part"), F.split_part("email", F.lit("@"), F.lit(2)).alias("domain"))


@query(rf"""WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '\+?[0-9][0-9 ().-]{{7,18}}[0-9]')) AS raw FROM documents), n AS (SELECT doc_id, CASE WHEN starts_with(raw, '+') THEN '+' ELSE '' END || regexp_replace(raw, '[^0-9]', '', 'g') AS phone FROM f)
SELECT DISTINCT doc_id, phone FROM n WHERE length(phone) BETWEEN 10 AND 15 AND length(replace(phone, '+', '')) BETWEEN 10 AND 15 AND regexp_matches(phone, '^[+0]')""")
def phone_extract_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(ct.filter_phones(ct.find_phones(F.col("text")))).alias("phone"))


_SITES = (
    (1, '<a href="https://www.instagram.com/some.shop/">i</a> https://twitter.com/shop_x https://wa.me/+6281234567890', "https://instagram.com/some.shop", "", "https://twitter.com/shop_x", "", "", "", "", "+6281234567890"),
    (2, "https://facebook.com/sharer https://facebook.com/real https://youtube.com/channel/UC12 https://t.me/chan", "", "", "", "", "", "https://youtube.com/channel/UC12", "chan", ""),
    (3, "https://linkedin.com/in/jo-do https://www.tiktok.com/@tok https://youtube.com/@me https://api.whatsapp.com/send?phone=441234567890", "", "", "", "https://linkedin.com/company/jo-do", "https://tiktok.com/@tok", "https://youtube.com/@me", "", "441234567890"),
    (4, "nothing here", "", "", "", "", "", "", "", ""),
)
_NETWORKS = ("instagram", "facebook", "twitter", "linkedin", "tiktok", "youtube", "telegram")


@query(f"SELECT id, {', '.join(_NETWORKS)}, whatsapp, (instagram <> '')::INT + (facebook <> '')::INT + (twitter <> '')::INT + (linkedin <> '')::INT + (whatsapp <> '')::INT AS n_links FROM ({sql_values(*_SITES)}) v(id, html, {', '.join(_NETWORKS)}, whatsapp)")
def social_handles(spark, sf_dir):
    df = rows(spark, "id int, html string", *[r[:2] for r in _SITES])
    html = F.col("html")
    return df.select("id", *[ct.social_url(html, n).alias(n) for n in _NETWORKS], ct.whatsapp(html).alias("whatsapp"), F.size(ct.social_links(html)).alias("n_links"))


_LD = (
    (1, '<script type="application/ld+json">{"@type":"DaySpa","name":"Calm Spa","telephone":"+62 812-3456","email":"Hi@Calm.example","address":{"streetAddress":"Jl. 1","addressLocality":"Ubud","addressRegion":"Bali","postalCode":"80571","addressCountry":"ID"},"openingHours":["Mo 9-5","Tu 9-5"],"aggregateRating":{"ratingValue":"4.5","reviewCount":"12"},"geo":{"latitude":"-8.5","longitude":"115.2"},"founder":{"name":"Ana"}}</script>'),
    (2, '<script type=\'application/ld+json\'>{"@type":"WebPage","name":""}</script><script type="application/ld+json">{"name":"Second","description":"text","openingHours":"daily","address":"12 Long Street, Town","author":"Bo"}</script>'),
    (3, "<p>no data</p>"),
)
_LD_WANT = (
    (1, "Calm Spa", "Ana", "DaySpa", "", "Mo 9-5, Tu 9-5", "4.5 (12 reviews)", "hi@calm.example", "+628123456", "Jl. 1, Ubud, Bali, 80571, ID", "Ubud", "ID", "-8.5, 115.2"),
    (2, "Second", "Bo", "", "text", "daily", "", "", "", "12 Long Street, Town", "", "", ""),
    (3, "", "", "", "", "", "", "", "", "", "", "", ""),
)
_LD_FIELDS = ("name", "contact", "category", "description", "hours", "rating", "email", "phone", "address", "city", "country", "location")


@query(f"SELECT * FROM ({sql_values(*_LD_WANT)}) v(id, {', '.join(_LD_FIELDS)})")
def jsonld_business(spark, sf_dir):
    df = rows(spark, "id int, html string", *_LD).withColumn("o", ct.json_ld(F.col("html")))
    return df.select("id", *[c.alias(k) for k, c in ct.ld_business(F.col("o")).items()])


_COUNTRIES = (("United States", "US"), (" indonesia ", "ID"), ("DE", ""), ("fr", "FR"), ("CA", ""), ("USA", "US"), ("XX", ""), ("Österreich", ""), ("", ""), ("türkiye", "TR"), ("GBR", "GB"))


@query(f"SELECT * FROM ({sql_values(*_COUNTRIES)}) v(raw, iso) UNION ALL SELECT n_name, CASE lower(n_name) {' '.join(f'WHEN {chr(39)}{k.replace(chr(39), chr(39) * 2)}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in dims.COUNTRY_NAMES.items())} ELSE '' END FROM nation")
def country_normalize(spark, sf_dir):
    raw = rows(spark, "raw string, _ string", *_COUNTRIES).select("raw").unionAll(table(spark, sf_dir, "nation").select("n_name"))
    return raw.select("raw", ct.normal_country(F.col("raw"), ct.country_codes(spark)).alias("iso"))


_ADDRESSES = (("1 Road, Ubud, Indonesia", "INDONESIA", "Ubud"), ("2 Street, Austin, TX", "", "Austin"), ("Paris FR", "FR", ""), ("a, b , c , SG", "SG", "c"), ("", "", ""))


@query(f"SELECT * FROM ({sql_values(*_ADDRESSES)}) v(address, country, city)")
def address_recover(spark, sf_dir):
    df = rows(spark, "address string, _c string, _d string", *_ADDRESSES)
    return df.select("address", ct.country_tail(F.col("address")).alias("country"), ct.city_part(F.col("address")).alias("city"))


@query("SELECT * FROM (VALUES (1, 'a,b'), (2, 'a'), (3, '')) v(id, left_keys)")
def map_key_drop(spark, sf_dir):
    df = spark.createDataFrame([(1, {"a": "1", "tiktok": "2", "b": "3"}), (2, {"youtube": "1", "a": "2"}), (3, {})], "id int, links map<string,string>")
    return df.select("id", F.array_join(F.array_sort(F.map_keys(ct.drop_keys(F.col("links"), ("tiktok", "youtube", "telegram")))), ",").alias("left_keys"))


_ERRORS = (("HTTP 404 not found", True, False), ("http 410", True, True), ("HTTP 403 forbidden", False, False), ("timeout", False, True), ("x509: unknown authority", True, False), ("dial: no such host", True, False), (None, None, None), ("permanently dead: x", False, False))


@query(f"SELECT message, permanent, may_retry FROM (VALUES {', '.join('(' + ', '.join('NULL' if v is None else chr(39) + v + chr(39) if isinstance(v, str) else str(v) for v in r) + ')' for r in _ERRORS)}) v(message, permanent, may_retry)")
def permanent_error_class(spark, sf_dir):
    df = rows(spark, "message string, _a boolean, _b boolean", *_ERRORS)
    return df.select("message", ct.permanent_error(F.col("message")).alias("permanent"), resurrectable(F.col("message")).alias("may_retry"))


@query("SELECT count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text ILIKE '%license%' AND lang = 'en'")
def ilike_search(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("text").ilike("%license%") & (F.col("lang") == "en")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query(f"WITH f AS ({_EMAILS}) SELECT split_part(e, '@', 2) AS provider, count(*) AS n FROM (SELECT DISTINCT doc_id, e FROM f) GROUP BY provider ORDER BY n DESC, provider LIMIT 10")
def top_providers(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select(F.explode(ct.filter_emails(ct.find_emails(F.col("text")))).alias("email"))
    return found.groupBy(F.split_part("email", F.lit("@"), F.lit(2)).alias("provider")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "provider").limit(10)


def _flags(df):
    """Validation flags that stand in for recorded verdicts."""
    q, t, k = F.col("quality"), F.col("toxic"), F.col("doc_id")
    flags = {"reachable": F.when(t == 1, "invalid").otherwise("safe"), "syntax": k % 11 != 0, "mx": q == 1, "deliverable": k % 2 == 0, "disposable": k % 7 == 0, "role": k % 5 == 0, "catch_all": k % 3 == 0, "honeypot": k % 13 == 0, "disabled": k % 17 == 0}
    return df.select("doc_id", *[F.coalesce(c, F.lit(False) if n != "reachable" else F.lit("safe")).alias(n) for n, c in flags.items()], q.isNotNull().alias("checked"))


_FLAGS = """WITH f AS (SELECT d.doc_id, coalesce(toxic = 1, false) AS invalid, d.doc_id % 11 <> 0 AS syntax, coalesce(quality = 1, false) AS mx, d.doc_id % 2 = 0 AS deliverable, d.doc_id % 7 = 0 AS disposable, d.doc_id % 5 = 0 AS role, d.doc_id % 3 = 0 AS catch_all, d.doc_id % 13 = 0 AS honeypot, d.doc_id % 17 = 0 AS disabled, quality IS NOT NULL AS checked FROM documents d LEFT JOIN labels l USING (doc_id)),
g AS (SELECT *, NOT invalid AND syntax AND mx AND NOT disposable AND NOT honeypot AND NOT disabled AS good, CASE WHEN invalid OR NOT syntax OR honeypot OR disabled THEN 0.0::DOUBLE ELSE round(0.05::DOUBLE + mx::INT * 0.25 + deliverable::INT * 0.35 + (NOT disposable)::INT * 0.15 + (NOT role)::INT * 0.1 + (NOT catch_all)::INT * 0.1, 2) END::DOUBLE AS score FROM f)"""


@query(_FLAGS + " SELECT doc_id, good, score FROM g")
def email_score(spark, sf_dir):
    f = _flags(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"))
    cols = {c: F.col(c) for c in f.columns}
    return f.select("doc_id", ct.good_email(cols).alias("good"), ct.score(cols).alias("score"))


@query(_FLAGS + " SELECT CASE WHEN NOT checked THEN 'unknown' WHEN good THEN 'valid' ELSE 'invalid' END AS status, count(*) AS n FROM g GROUP BY status")
def verdict_join(spark, sf_dir):
    f = _flags(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"))
    good = ct.good_email({c: F.col(c) for c in f.columns})
    return f.groupBy(F.when(~F.col("checked"), "unknown").when(good, "valid").otherwise("invalid").alias("status")).agg(F.count("*").alias("n"))
