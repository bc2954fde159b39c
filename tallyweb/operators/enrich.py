"""Fetched pages into completed page jobs, and search results into pending ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb.functions import contacts as ct
from tallyweb.functions import urls as u
from tallyweb.operators.dedup import first_wins
from tallyweb.sources.html import metadata_column


def discovered(results: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """Pending jobs for result urls that are new: each canonical url once, no domain that is skipped."""
    own = results.select(F.col(url).alias("url")).withColumn("url_hash", u.hash_url(F.col("url"))).withColumn("domain", u.domain(F.col("url")))
    fresh = first_wins(own.where((F.col("domain") != "") & ~u.skip_domain(F.col("domain"))), "url_hash", "url")
    return fresh.join(known.select("url_hash"), "url_hash", "left_anti").select("url", "url_hash", "domain", F.lit("serp_result").alias("source"), F.lit("pending").alias("status"))


def enrich(pages: DataFrame, completed_at: Column, source: str = "serp_result", metadata: bool = True) -> DataFrame:
    """Completed jobs with what the pages (url, html) say: structured data first, then meta tags and microformats, then the title.

    metadata: read meta tags and microformats too (an Arrow UDF; the rest is built-in expressions).
    """
    html = F.col("html")
    df = pages.select("url", F.coalesce("html", F.lit("")).alias("html"))
    df = df.withColumn("_m", metadata_column(html) if metadata else F.lit(None).cast("struct<name:string,description:string,category:string,contact:string,address:string>"))
    df = df.withColumn("_o", ct.json_ld(html))
    ld = ct.ld_business(F.col("_o"))
    first = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c])
    emails = ct.filter_emails(F.array_distinct(F.concat(ct.page_emails(html), F.filter(F.array(ld["email"]), lambda e: e != ""))))
    phones = ct.filter_phones(F.array_distinct(F.concat(ct.page_phones(html), F.filter(F.array(ld["phone"]), lambda p: p != ""))))
    return df.select(
        "url",
        u.hash_url(F.col("url")).alias("url_hash"),
        u.domain(F.col("url")).alias("domain"),
        F.lit(source).alias("source"),
        F.lit("completed").alias("status"),
        completed_at.alias("completed_at"),
        emails.alias("raw_emails"),
        phones.alias("raw_phones"),
        ct.social_links(html).alias("raw_social"),
        first(ld["name"], F.col("_m.name"), ct.page_title(html)).alias("raw_business_name"),
        first(ld["category"], F.col("_m.category")).alias("raw_category"),
        first(ld["description"], F.col("_m.description")).alias("raw_description"),
        first(ld["address"], F.col("_m.address")).alias("raw_address"),
        first(ld["location"]).alias("raw_location"),
        first(ld["country"]).alias("raw_country"),
        first(ld["city"]).alias("raw_city"),
        first(ld["contact"], F.col("_m.contact")).alias("raw_contact_name"),
        first(ct.page_title(html)).alias("raw_page_title"),
        first(ld["hours"]).alias("raw_opening_hours"),
        first(ld["rating"]).alias("raw_rating"),
        *[first(ct.social_url(html, n)).alias(f"raw_{n}") for n in ("tiktok", "youtube", "telegram")],
    )


def verdicts(emails: DataFrame, checks: DataFrame, key: str = "email") -> DataFrame:
    """Emails with their verdicts: valid, invalid with the reason, unknown where there is none. checks: flags by email."""
    flags = checks.select(key, F.struct(*[c for c in checks.columns if c != key]).alias("_f"))
    out = emails.join(flags, key, "left")
    f = {c: F.col(f"_f.{c}") for c in checks.columns if c != key}
    good = ct.good_email(f)
    status = F.when(F.col("_f").isNull(), F.lit("unknown")).when(good, F.lit("valid")).otherwise(F.lit("invalid"))
    return out.select(*emails.columns, status.alias("validation_status"), F.when(F.col("_f").isNotNull() & ~good, f["reachable"]).alias("reason"), F.when(F.col("_f").isNotNull(), ct.score(f)).alias("score"))


def acceptable(emails: DataFrame, good: str) -> DataFrame:
    """Emails that aren't known to be bad: without a verdict they stay."""
    return emails.where(F.coalesce(F.col(good), F.lit(True)))
