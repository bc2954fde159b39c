"""Completed page jobs into listings, emails, their links, and further pages to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb.functions.urls import contact_pages, sha256
from tallyweb.operators.dedup import first_wins

#: Text columns of a listing, and the job's columns they come from: the newest value that isn't null wins.
NEWEST = {
    "business_name": "raw_business_name",
    "category": "raw_category",
    "description": "raw_description",
    "address": "raw_address",
    "location": "raw_location",
    "country": "raw_country",
    "city": "raw_city",
    "contact_name": "raw_contact_name",
    "page_title": "raw_page_title",
    "opening_hours": "raw_opening_hours",
    "rating": "raw_rating",
    "tiktok": "raw_tiktok",
    "youtube": "raw_youtube",
    "telegram": "raw_telegram",
}


def newest(value: Column, *order: Column | str) -> Column:
    """Aggregate: the last value by order that isn't null."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def oldest(value: Column, *order: Column | str) -> Column:
    return F.min_by(value, F.struct(*order))


def distinct_union(df: DataFrame, key: str, arrays: str, name: str) -> DataFrame:
    """(key, name): all elements of a key's arrays, each once, sorted. Elements are made distinct before they are gathered."""
    return df.select(key, F.explode(arrays).alias("_x")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("_x")).alias(name))


def ordered_union(df: DataFrame, key: str, arrays: str, name: str, *order: str) -> DataFrame:
    """(key, name): all elements of a key's arrays, each once, in order of first appearance."""
    each = df.select(key, F.struct(*order).alias("_at"), F.posexplode(arrays).alias("_i", "_x"))
    first = each.groupBy(key, "_x").agg(F.min(F.struct("_at", "_i")).alias("_first"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_first", "_x"))), lambda r: r["_x"]).alias(name))


def merged_map(df: DataFrame, key: str, maps: str, name: str, *order: str) -> DataFrame:
    """(key, name): a key's maps joined in order, the later value of an entry wins. Only the winners are gathered."""
    each = df.select(key, F.struct(*order).alias("_at"), F.explode(maps).alias("_k", "_v"))
    last = each.groupBy(key, "_k").agg(F.max_by("_v", "_at").alias("_v"))
    return last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias(name))


def normalize(jobs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(listings, emails, listing_emails, contact_jobs) of completed jobs.

    A url_hash counts once, by its last job. Listings are one row per domain; url, website and
    query are the first job's. Pages of a domain whose search result had no email are queued.
    """
    at = ("completed_at", "url_hash", "url")
    done = first_wins(jobs.where("status = 'completed'"), "url_hash", (-F.unix_micros("completed_at")).alias("_late"), "url")
    texts = [newest(F.col(raw), *at).alias(name) for name, raw in NEWEST.items()]
    listings = done.groupBy("domain").agg(
        oldest(F.col("url"), *at).alias("url"),
        oldest(F.col("url"), *at).alias("website"),
        *texts,
        newest(F.get("raw_phones", F.lit(0)), *at).alias("phone"),
    )
    phones, links = ordered_union(done, "domain", "raw_phones", "phones", *at), merged_map(done, "domain", "raw_social", "social_links", *at)
    none, nothing = F.array().cast("array<string>"), F.create_map().cast("map<string,string>")
    listings = listings.join(phones, "domain", "left").join(links, "domain", "left").withColumns({"phones": F.coalesce("phones", none), "social_links": F.coalesce("social_links", nothing)})
    pairs = done.select("domain", F.explode("raw_emails").alias("email")).distinct()
    emails = pairs.select("email").distinct().select("email", F.split_part("email", F.lit("@"), F.lit(2)).alias("email_domain"), F.split_part("email", F.lit("@"), F.lit(1)).alias("local_part"))
    bare = done.where("source = 'serp_result' AND coalesce(size(raw_emails), 0) = 0").select("domain").distinct()
    pages = bare.select("domain", F.explode(contact_pages(F.col("domain"))).alias("url")).withColumn("url_hash", sha256(F.col("url")))
    queued = pages.join(jobs.select("url_hash"), "url_hash", "left_anti").select("url", "url_hash", "domain", F.lit("contact_page").alias("source"), F.lit("pending").alias("status"))
    return listings, emails, pairs, queued
