"""Listings mended from completed jobs, and the batches and merges of another enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb.functions import contacts as ct
from tallyweb.operators.dedup import seeded_order
from tallyweb.operators.jobs import ago

#: Keys of social links that have columns of their own.
OWN_COLUMNS = ("tiktok", "youtube", "telegram")


def _empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def latest(jobs: DataFrame, value: Column, name: str) -> DataFrame:
    """(domain, name): of each domain's completed jobs the value of the newest that has one; ties by url_hash."""
    own = jobs.where("status = 'completed'").select("domain", value.alias("_v"), F.struct("completed_at", "url_hash").alias("_at")).where(F.col("_v").isNotNull())
    return own.groupBy("domain").agg(F.max_by("_v", "_at").alias(name))


def backfill(listings: DataFrame, jobs: DataFrame) -> DataFrame:
    """Listings with phones, country and city from their domains' jobs where they have none, and without the social

    links that have columns of their own.
    """
    phones = latest(jobs, F.when(F.size("raw_phones") > 0, F.col("raw_phones")), "_phones")
    country = latest(jobs, F.nullif(ct.country_tail(F.col("raw_address")), F.lit("")), "_country")
    city = latest(jobs, F.nullif(ct.city_part(F.col("raw_address")), F.lit("")), "_city")
    df = listings.join(phones, "domain", "left").join(country, "domain", "left").join(city, "domain", "left")
    return df.withColumns(
        {
            "phones": F.when(F.coalesce(F.size("phones"), F.lit(0)) <= 0, F.coalesce("_phones", "phones")).otherwise(F.col("phones")),
            "country": F.when(_empty("country"), F.coalesce("_country", "country")).otherwise(F.col("country")),
            "city": F.when(_empty("city"), F.coalesce("_city", "city")).otherwise(F.col("city")),
            "social_links": ct.drop_keys(F.col("social_links"), OWN_COLUMNS),
        }
    ).select(*listings.columns)


def normal_countries(listings: DataFrame) -> DataFrame:
    """Names of countries as codes; what is not known, and codes, stay as they are."""
    return listings.withColumn("country", ct.folded_country(F.col("country")))


def completeness(listings: DataFrame, links: DataFrame, key: str, good: Column) -> DataFrame:
    """listings with score, 0 to 100. links: emails by listing; good: those that count."""
    mailed = links.where(good).select(F.col(key).alias("_k")).distinct()
    df = listings.join(mailed, listings[key] == F.col("_k"), "left")
    phone = ~_empty("phone") | (F.coalesce(F.size("phones"), F.lit(0)) > 0)
    placed = ~_empty("address") | (~_empty("city") & ~_empty("country"))
    social = F.coalesce(F.size("social_links"), F.lit(0)) > 0
    return df.withColumn("score", ct.completeness(F.col("_k").isNotNull(), phone, ~_empty("business_name") & ~_empty("category"), placed, social)).drop("_k")


def eligible(scored: DataFrame, as_of: Column, threshold: int = 90, n: int = 100, key: str = "id", seed: str = "0") -> DataFrame:
    """Up to n listings to enrich again, in a seeded order: never done, not held for the last 15 minutes, of a low score; locked as of now, with the url to fetch."""
    free = F.col("re_enriched_at").isNull() & (F.col("re_enrich_locked_at").isNull() | (F.col("re_enrich_locked_at") < ago(as_of, "15 MINUTES")))
    chosen = scored.where(free & (F.col("score") < threshold)).orderBy(seeded_order(key, seed)).limit(n)
    return chosen.withColumn("re_enrich_locked_at", as_of).withColumn("url", F.coalesce("website", F.concat(F.lit("https://"), "domain")))


#: Columns that another enrichment replaces whole; of the others a value replaces an older one, a null does not.
REPLACED = ("status", "raw_emails", "raw_phones", "raw_social", "completed_at", "updated_at")


def merge_enriched(jobs: DataFrame, fresh: DataFrame, key: str = "url_hash") -> DataFrame:
    """jobs with the fresh ones (one a key, in the columns of jobs): a full outer merge by key."""
    others = [c for c in jobs.columns if c != key]
    old = jobs.select(key, F.struct(*others).alias("_old"))
    new = fresh.select(key, F.struct(*[F.col(c) if c in fresh.columns else F.lit(None).cast(jobs.schema[c].dataType).alias(c) for c in others]).alias("_new"))
    both = old.join(new, key, "full")
    pick = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")) if c in REPLACED else F.coalesce(f"_new.{c}", f"_old.{c}")
    return both.select(*[F.col(key) if c == key else pick(c).alias(c) for c in jobs.columns])


def mark_enriched(listings: DataFrame, done: DataFrame, as_of: Column, key: str = "id") -> DataFrame:
    """listings with the done ones marked and no longer held."""
    hit = done.select(F.col(key).alias("_k")).distinct()
    df = listings.join(hit, listings[key] == F.col("_k"), "left")
    found = F.col("_k").isNotNull()
    return df.withColumns({"re_enriched_at": F.when(found, as_of).otherwise(F.col("re_enriched_at")), "re_enrich_locked_at": F.when(~found, F.col("re_enrich_locked_at"))}).select(*listings.columns)
